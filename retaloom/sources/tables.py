"""Stored Parquet tables: full refresh, month layout, partition replacement."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom.functions.dates import period_key
from retaloom.sources import commits

MONTH = "periodo_particion"


def write_table(df: DataFrame, path: str, by_date: str | None = None) -> None:
    """Replace a table. ``by_date`` lays it out in one folder per month of that date.

    Months instead of days keep files large, and the date's own statistics still
    skip row groups. The rebalance hint sizes the output files at run time: a hot
    month is split over tasks, small months share one.
    """
    if by_date:
        df = df.withColumn(MONTH, period_key(F.col(by_date)))
    commits.replace(df, path, MONTH if by_date else None)


def write_table_by(df: DataFrame, path: str, by: str) -> None:
    """Replace a table, one folder per value of a column it has already."""
    commits.replace(df, path, by)


def replace_partitions(
    df: DataFrame, path: str, by: str,
    gone: Callable[[set[str]], Iterable[str]] | None = None, token: str | None = None,
) -> None:
    """Overwrite exactly the partitions that occur in ``df``, all at once, and drop those that
    ``gone`` names when given the values written."""
    commits.replace_parts(df, path, by, gone, token)


def read_table(spark: SparkSession, path: str, tag: bool = False) -> DataFrame:
    """A stored table; ``tag`` adds a deterministic value per stored row."""
    df = commits.read(spark, path)
    if tag:
        row = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        df = df.select("*", row.alias("_tag"))
    return df.drop(MONTH)


def read_days(spark: SparkSession, path: str, date: str, first: str, last: str) -> DataFrame:
    """Rows of a date range; months outside it are pruned by folder."""
    low, high = (int(d[:4]) * 100 + int(d[5:7]) for d in (first, last))
    day = F.col(date)
    return (
        commits.read(spark, path)
        .where(F.col(MONTH).between(low, high))
        .where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        .drop(MONTH)
    )


def exists(spark: SparkSession, path: str) -> bool:
    return commits.latest(spark, path) is not None


def create_empty(spark: SparkSession, path: str, schema: str, by: str | None = None) -> None:
    """A table with the right columns and no rows, unless it is there already."""
    if not exists(spark, path):
        commits.replace(spark.createDataFrame([], schema), path, by)
