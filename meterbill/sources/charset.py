"""Text stored in a legacy single-byte charset (the shard databases use WIN1251)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEGACY_CHARSETS_FLAG = "spark.sql.legacy.javaCharsets"


@contextmanager
def legacy_charsets(spark: SparkSession):
    """Allow Java charsets beyond the ANSI list (``windows-1251``) for a block,
    then restore the previous setting."""
    old = spark.conf.get(LEGACY_CHARSETS_FLAG, None)
    spark.conf.set(LEGACY_CHARSETS_FLAG, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(LEGACY_CHARSETS_FLAG)
        else:
            spark.conf.set(LEGACY_CHARSETS_FLAG, old)


def _upper_half(charset: str) -> tuple[str, str]:
    """Characters 0x80-0xFF of Latin-1 and of a single-byte charset, without the places that agree or are not assigned."""
    latin, other = [], []
    for b in range(128, 256):
        c = bytes([b]).decode(charset, "replace")
        if c != chr(b) and c != "\ufffd":
            latin.append(chr(b))
            other.append(c)
    return "".join(latin), "".join(other)


def decode_text(c: Column | str, charset: str = "windows-1251") -> Column:
    """Bytes in a single-byte ``charset`` to text: Latin-1, then its upper half mapped.  A plain
    expression; no session flag is needed."""
    latin, other = _upper_half(charset)
    return F.translate(F.decode(F.col(c) if isinstance(c, str) else c, "ISO-8859-1"), latin, other)


def encode_text(c: Column | str, charset: str = "windows-1251") -> Column:
    """Text to bytes in a single-byte ``charset``; the inverse of ``decode_text`` for text the charset has."""
    latin, other = _upper_half(charset)
    return F.encode(F.translate(F.col(c) if isinstance(c, str) else c, other, latin), "ISO-8859-1")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, charset: str = "windows-1251",
             header: bool = True) -> DataFrame:
    """CSV files written in a legacy charset."""
    return (spark.read.option("header", header).option("encoding", charset)
            .schema(schema).csv(path))


def write_csv(df: DataFrame, path: str, *, charset: str = "windows-1251", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("encoding", charset).csv(path)
