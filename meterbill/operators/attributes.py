"""Entity-attribute-value characteristics looked up as of a point in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterbill.functions.predicates import AsOf, valid_at
from meterbill.plans.tables import BillingTables


def characteristic_id(tables: BillingTables, type_name: str, code: str, name: str | None = None) -> Column:
    """Catalogue lookup (type name, code[, name]) -> characteristic id, as a scalar:
    characteristic -> its group -> the group's type, three small tables.

    A code may occur under several names, so callers that know the name give it;
    ``max`` keeps the scalar a single value where the catalogue repeats all three.
    """
    types = tables["cn_char_type"].filter(F.col("name") == F.lit(type_name)).select("char_type_id")
    groups = tables["cn_chrctrstc_group"].join(types, "char_type_id", "left_semi").select("cn_chrctrstc_group_id")
    named = F.lit(True) if name is None else F.col("name") == F.lit(name)
    found = tables["cn_characteristic_ref"].filter((F.col("code") == F.lit(code)) & named)
    return found.join(groups, "cn_chrctrstc_group_id", "left_semi").agg(F.max("cn_chrct_id")).scalar()


def attribute_as_of(attrs: DataFrame, characteristic: Column | str, as_of: AsOf, *,
                    object_col: str = "object_id", char_col: str = "cn_chrct_id",
                    value_col: str = "value", out: str = "value") -> DataFrame:
    """Per object, the value of ``characteristic`` valid at ``as_of``.

    Several valid versions: the newest ``date_begin`` wins (ties: the larger
    value).  Objects with no valid version are absent; left-join to keep them.
    Aggregated with ``max(struct)``: partial aggregation, no window, no
    collect of a group.
    """
    ch = characteristic if isinstance(characteristic, Column) else F.lit(characteristic)
    best = F.max(F.struct(F.col("date_begin"), F.col(value_col))).alias("_best")
    return (attrs.filter((F.col(char_col) == ch) & valid_at(as_of))
            .groupBy(object_col).agg(best)
            .select(object_col, F.col(f"_best.{value_col}").alias(out)))


def attributes_as_of(attrs: DataFrame, characteristics: dict[str, Column | str], as_of: AsOf, *,
                     object_col: str = "object_id", char_col: str = "cn_chrct_id",
                     value_col: str = "value") -> DataFrame:
    """Several characteristics as of ``as_of`` in one pass over ``attrs``:
    one column per entry of ``characteristics`` (output name -> id).  Same
    rule as ``attribute_as_of``; objects with none of them are absent."""
    ids = {out: (c if isinstance(c, Column) else F.lit(c)) for out, c in characteristics.items()}
    wanted = None
    for c in ids.values():
        wanted = (F.col(char_col) == c) if wanted is None else wanted | (F.col(char_col) == c)
    aggs = [F.max(F.when(F.col(char_col) == c, F.struct(F.col("date_begin"), F.col(value_col))))
            .alias(f"_{out}") for out, c in ids.items()]
    grouped = attrs.filter(wanted & valid_at(as_of)).groupBy(object_col).agg(*aggs)
    return grouped.select(object_col, *[F.col(f"_{out}.{value_col}").alias(out) for out in ids])


def to_number(c: Column | str, *, lenient: bool = False, number: str = "double") -> Column:
    """Text to number.  Strict (ANSI cast, raises on bad text like the source
    database) by default; ``lenient`` yields NULL instead.  ``number`` is the type it gives,
    e.g. ``decimal(18,4)`` where the source's numbers are decimals."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(number) if lenient else col.cast(number)
