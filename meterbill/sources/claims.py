"""Files made by exactly one run, and claims built on them.

A file is made only if it is not there: HDFS does that in one step, on a local disk the operating system does
(``CREATE_NEW``).  A store whose create is not exclusive needs a database table for this instead.

A claim is such a file whose text names the holder and when it was made: one holder at a time.  A claim older than
``stale_after`` seconds belongs to a dead run; who renames it away (one step, one winner) may claim again.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ClaimLost(RuntimeError):
    """The claim was taken over while its holder was still at work, or another run holds it."""


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with this text; False if it exists."""
    fs, at = file_system(spark, path)
    fs.mkdirs(at.getParent())
    data = bytearray(text.encode())
    try:
        if fs.getUri().getScheme() == "file":
            nio, array = spark._jvm.java.nio.file, spark.sparkContext._gateway.new_array
            options = array(nio.OpenOption, 2)
            options[0], options[1] = nio.StandardOpenOption.CREATE_NEW, nio.StandardOpenOption.WRITE
            nio.Files.write(nio.Paths.get(at.toUri().getPath(), array(spark._jvm.java.lang.String, 0)), data, options)
        else:
            out = fs.create(at, False)
            out.write(data)
            out.close()
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, '' while it is being written, None if there is no file."""
    fs, at = file_system(spark, path)
    try:
        stream = fs.open(at)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
    except Py4JJavaError as e:
        if "NotFound" in e.java_exception.getClass().getName() or "NoSuchFile" in e.java_exception.getClass().getName():
            return None
        raise
    return text


class Claim:
    """A claim on ``path``; ``take`` says whether this run now holds it."""

    def __init__(self, spark: SparkSession, path: str, stale_after: float):
        self.spark, self.path, self.stale_after = spark, path, stale_after
        self.holder = uuid.uuid4().hex

    def take(self) -> bool:
        """Create the claim, or take over a stale one; False if another run holds it."""
        if self._create():
            return True
        found = self._read(self.path)
        if found is not None:
            if time.time() - found["made"] <= self.stale_after:
                return False
            fs, at = file_system(self.spark, self.path)
            aside = f"{self.path}-stale-{self.holder}"
            gone = file_system(self.spark, aside)[1]
            try:
                if not fs.rename(at, gone):
                    return False
            except Py4JJavaError:       # another run was first
                return False
            # what was renamed away may be a newer claim, made after this run looked; then it goes back
            moved = self._read(aside)
            if moved is not None and moved["holder"] != found["holder"]:
                fs.rename(gone, at)
                return False
            fs.delete(gone, False)
        return self._create()

    def held(self) -> bool:
        """Whether the claim is still this run's."""
        found = self._read(self.path)
        return found is not None and found["holder"] == self.holder

    def release(self) -> None:
        """Give the claim up, if it is still this run's."""
        if self.held():
            fs, at = file_system(self.spark, self.path)
            fs.delete(at, False)

    def _create(self) -> bool:
        return create_exclusive(self.spark, self.path, json.dumps({"holder": self.holder, "made": time.time()}))

    def _read(self, path: str) -> dict | None:
        text = read_text(self.spark, path)
        if text is None:
            return None
        return json.loads(text) if text else {"holder": "", "made": time.time()}     # being written just now
