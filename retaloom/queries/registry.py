"""Named queries, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retaloom.medallion import Medallion, from_standins
from retaloom.queries.sqlbase import sql as with_tables


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


WIDE = T.DecimalType(38, 0)  # whole numbers that a long cannot hold


def plain(df: DataFrame, wide: Collection[str] = ()) -> DataFrame:
    """Money as double and integers as long: the types results are handed over in. Columns
    named ``wide`` stay whole decimals if they are ``WIDE``."""
    made = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in wide and f.dataType == WIDE:
            pass
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double" if f.dataType.scale else "bigint").alias(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint").alias(f.name)
        made.append(c)
    return df.select(*made)


def query(name: str, sql: str | None = None, wide: Collection[str] = ()):
    """Register ``fn(medallion) -> DataFrame`` under ``name``; ``wide`` as in ``plain``."""

    def register(fn: Callable[[Medallion], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(
            lambda spark, folder: plain(fn(from_standins(spark, folder)), wide),
            with_tables(sql) if sql else None,
        )
        return fn

    return register
