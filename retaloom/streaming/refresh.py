"""Incremental refresh of stored cubes."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from retaloom.plans import cells
from retaloom.session import as_table
from retaloom.sources import commits, tables

PARTITION = "periodo"


def store_cube(cube: DataFrame, path: str) -> None:
    """Full refresh of a cube, one folder per month."""
    tables.write_table_by(cube, path, PARTITION)


def refresh(spark: SparkSession, path: str, build: Callable[[list[int]], DataFrame],
            periods: list[int]) -> None:
    """Recompute the given months of a cube and overwrite only those.

    ``build`` gives the cube rows of a list of periods, so that its filter reaches
    the fact scan. A month that has no rows any more is removed.
    """
    if not periods:
        return
    tables.replace_partitions(
        build(sorted(periods)), path, PARTITION, gone=lambda there: {str(p) for p in periods} - there)


def refresh_cells(spark: SparkSession, path: str, change: DataFrame, shape: cells.Shape, token: str) -> list[int]:
    """Adds a change to the stored cells, once per token; gives the months it touches.

    Only these months are read and written, in one commit that also records the token, so a job
    that is run again after a crash changes nothing a second time.
    """
    change = as_table(change, "change")
    months = [r[0] for r in change.select(PARTITION).distinct().collect()]  # at most one per calendar month
    if months and not commits.applied(spark, path, token):
        before = tables.read_table(spark, path).where(F.col(PARTITION).isin(months))
        tables.replace_partitions(
            cells.merged(before, change, shape), path, PARTITION,
            gone=lambda there: {str(p) for p in months} - there, token=token)
    return months


def publish(spark: SparkSession, cells_path: str, cube_path: str, shape: cells.Shape,
            build: Callable[[DataFrame], DataFrame], months: Iterable[int] | None = None) -> None:
    """Cube rows out of the cells: of all months, or anew for those given.

    ``build`` makes cube rows of cells in the columns of their fact.
    """
    stored = tables.read_table(spark, cells_path)
    if months is None:
        store_cube(build(cells.as_fact(stored, shape)), cube_path)
        return
    refresh(spark, cube_path, lambda wanted: build(
        cells.as_fact(stored.where(F.col(PARTITION).isin(wanted)), shape)), sorted(months))


def changed_periods(changes: DataFrame, day: str) -> list[int]:
    """Months touched by the changed rows: at most one per calendar month."""
    month = (F.year(day) * 100 + F.month(day)).alias("p")
    return [row["p"] for row in changes.select(month).distinct().collect() if row["p"]]


def follow(spark: SparkSession, changes: DataFrame, day: str, path: str,
           build: Callable[[list[int]], DataFrame], checkpoint: str,
           interval: str | None = None) -> StreamingQuery:
    """Keep a cube fresh from a stream of changed rows, at an interval or until caught up."""
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: refresh(spark, path, build, changed_periods(batch, day)))
    return writer.trigger(
        **({"processingTime": interval} if interval else {"availableNow": True})).start()
