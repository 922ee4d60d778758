"""Table providers: anything that hands out the billing tables by name."""

from __future__ import annotations

from typing import Mapping, Protocol, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class BillingTables(Protocol):
    def __getitem__(self, name: str) -> DataFrame: ...


class FrameMap:
    """Billing tables from an explicit mapping (JDBC reads, Parquet tables, test rows)."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self._frames[name]
        except KeyError as e:
            raise AttributeError(name) from e


# Flag columns of the billing tables; one source holds them as numbers, another as text.
FLAG_COLUMNS = ("is_active", "close_ls")


def integer_flag(flag: Column, declared: T.DataType, name: str) -> Column:
    """A flag of any declared type as an integer.

    Booleans become 0 and 1, numbers (a database NUMBER without a scale arrives as decimal) are
    taken if they are whole, text is trimmed and read as a whole number.  Anything else fails the query, NULL stays NULL.
    """
    if isinstance(declared, T.BooleanType):
        return flag.cast("int")
    if isinstance(declared, T.NumericType):
        number = flag.try_cast("int")
        whole = number.isNotNull() & (number.cast(declared) == flag)
    else:
        number = F.trim(flag.cast("string")).try_cast("int")
        whole = number.isNotNull()
    bad = F.raise_error(F.concat(F.lit(f"{name} is no flag: "), flag.cast("string"))).cast("int")
    return F.when(flag.isNull() | whole, number).otherwise(bad)


class TypedTables:
    """A provider whose flag columns are integers, whatever the source declares.

    They are cast once, where a table is handed out, so that every flag
    comparison is one between integers.  Text that is no number fails the query
    (it is never read as "not active"); NULL stays NULL.
    """

    def __init__(self, tables: BillingTables, flags: Sequence[str] = FLAG_COLUMNS):
        self._tables = tables
        self._flags = tuple(flags)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        for c in self._flags:
            if c in df.columns and df.schema[c].dataType != T.IntegerType():
                df = df.withColumn(c, integer_flag(F.col(c), df.schema[c].dataType, f"{name}.{c}"))
        return df

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]
