"""Relational sources over JDBC.

The billing jobs read from Oracle and Firebird; on Spark that is the built-in
JDBC source (driver jars come from the cluster configuration).  Reads should
be split across executors - by a numeric column range or by explicit
predicates - so one table is never pulled through one connection.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, url: str, query: str, *, properties: dict | None = None,
               fetchsize: int = 10_000) -> DataFrame:
    """A SQL query pushed to the database as a subquery (one partition).

    Only for queries whose result is small (catalogue lookups, one period);
    fact tables use ``read_table``.
    """
    return (spark.read.format("jdbc").option("url", url).option("query", query)
            .option("fetchsize", fetchsize).options(**(properties or {})).load())


def read_table(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None, predicates: Sequence[str] | None = None,
               properties: dict | None = None, fetchsize: int = 10_000) -> DataFrame:
    """A table read in parallel: by column range or by one predicate per partition.

    Filters and the column list of later operators are pushed into the
    generated ``SELECT`` by the JDBC source.
    """
    props = {"fetchsize": str(fetchsize), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def read_sql_file(spark: SparkSession, path: str, **frames: DataFrame) -> DataFrame:
    """Run a query kept in a file (comments allowed, one trailing ``;``) over
    DataFrames bound to ``{name}`` placeholders."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read().strip()
    if text.endswith(";"):
        text = text[:-1]
    return spark.sql(text, **frames)
