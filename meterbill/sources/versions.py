"""Published versions of a target: a chain of numbered manifests, readers pinned to one, retention that spares those.

Manifest n + 1 names what follows version n.  It is made only if it does not exist yet (see ``claims.create_exclusive``), so
of two publishers that start from the same version one wins and the other is told (``PublishConflict``); nothing
depends on renames.  The current version is the manifest with the greatest number.  A reader that must see one
version for long pins it; ``expire`` removes versions that are neither among the newest, nor young, nor pinned.
"""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import SparkSession

from meterbill.sources.claims import create_exclusive, file_system, read_text

MANIFESTS, PINS = "_manifests", "_pins"      # names that Spark's readers skip
PIN_LASTS = 24 * 60 * 60.0                   # seconds after which a pin belongs to a dead reader


class Unpublished(RuntimeError):
    """A target was read before its first version was published."""


class PublishConflict(RuntimeError):
    """Another version was published since the one this one was meant to follow."""


def _numbers(spark: SparkSession, path: str, folder: str) -> list[str]:
    """File names in one of the target's own folders; their number is bounded by retention."""
    fs, at = file_system(spark, f"{path}/{folder}")
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at) if not s.getPath().getName().startswith("."))


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that are kept, oldest first."""
    return [int(n.removesuffix(".json")) for n in _numbers(spark, path, MANIFESTS)]


def manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    """What version ``number`` consists of, None if it was never published or is gone."""
    text = read_text(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    return json.loads(text) if text else None


def current(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    """Number and manifest of the current version; (0, None) if nothing was published."""
    kept = numbers(spark, path)
    return (kept[-1], manifest(spark, path, kept[-1])) if kept else (0, None)


def publish(spark: SparkSession, path: str, content: dict, after: int) -> int:
    """Make ``content`` the version that follows version ``after``; its number."""
    text = json.dumps(content | {"made": time.time()})
    if not create_exclusive(spark, f"{path}/{MANIFESTS}/{after + 1:012d}.json", text):
        raise PublishConflict(f"version {after + 1} of {path} was published by another run")
    return after + 1


@contextmanager
def pinned(spark: SparkSession, path: str) -> Iterator[dict]:
    """The manifest of the current version, which ``expire`` leaves alone until the block ends."""
    while True:
        number, content = current(spark, path)
        if content is None:
            raise Unpublished(f"nothing was published at {path}")
        pin = f"{path}/{PINS}/{number:012d}-{uuid.uuid4().hex}.json"
        create_exclusive(spark, pin, json.dumps({"made": time.time()}))
        fs, at = file_system(spark, pin)
        if manifest(spark, path, number) is not None:     # not removed before the pin was there
            break
        fs.delete(at, False)
    try:
        yield content
    finally:
        fs.delete(at, False)


def expire(spark: SparkSession, path: str, *, keep: int = 2, older_than: float = 24 * 60 * 60.0, pin_lasts: float = PIN_LASTS) -> list[int]:
    """Remove versions older than ``older_than`` seconds that are not pinned, but never the newest ``keep``; the numbers
    removed.  A version's manifest goes first, and its files only if it was not pinned in that moment.

    Readers without a pin are safe for ``older_than`` seconds.  Folders that a kept manifest names stay, whichever version wrote them.
    """
    kept, now, gone = numbers(spark, path), time.time(), []
    for number in kept[:-max(keep, 1)]:
        content = manifest(spark, path, number)
        if content is None or now - content["made"] <= older_than or _is_pinned(spark, path, number, now, pin_lasts):
            continue
        fs, at = file_system(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
        fs.delete(at, False)
        if _is_pinned(spark, path, number, now, pin_lasts):
            create_exclusive(spark, f"{path}/{MANIFESTS}/{number:012d}.json", json.dumps(content))
            continue
        gone.append((number, content))
    in_use = {f for n in numbers(spark, path) for f in (manifest(spark, path, n) or {}).get("folders", [])}
    for _, content in gone:
        for folder in set(content.get("folders", [])) - in_use:
            fs, at = file_system(spark, f"{path}/{folder}")
            fs.delete(at, True)
    return [n for n, _ in gone]


def _is_pinned(spark: SparkSession, path: str, number: int, now: float, lasts: float) -> bool:
    for name in _numbers(spark, path, PINS):
        if name.startswith(f"{number:012d}-"):
            text = read_text(spark, f"{path}/{PINS}/{name}")
            if text and now - json.loads(text)["made"] <= lasts:
                return True
    return False
