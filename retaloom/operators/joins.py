"""Join idioms: pre-aggregation, foreign-key audit, one-row comparisons, filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from retaloom.session import as_table


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def side_by_side(measures: Mapping[str, DataFrame]) -> DataFrame:
    """One row holding one number per single-row, single-column frame.

    A tagged union and one small aggregate; no cross join.
    """
    tagged = [
        df.select(F.lit(name).alias("_name"), F.col(df.columns[0]).alias("_value"))
        for name, df in measures.items()
    ]
    return (
        reduce(DataFrame.union, tagged)
        .groupBy()
        .agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in measures])
    )


def combined(frames: Iterable[DataFrame]) -> DataFrame:
    """One row with the counts of several one-row frames, each frame computed once."""
    frames = list(frames)
    tagged = [
        df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("_name"), F.col(c).cast("bigint").alias("_value"))
            for c in df.columns])))
        for df in frames
    ]
    names = [c for df in frames for c in df.columns]
    return (
        reduce(DataFrame.union, tagged)
        .groupBy()
        .agg(*[F.max(F.when(F.col("_name") == n, F.col("_value"))).alias(n) for n in names])
    )


def orphan_counts(
    fact: DataFrame, dims: Mapping[str, tuple[str, DataFrame, str]], out: str = "huerfanos"
) -> DataFrame:
    """Rows of ``fact`` without a partner, per named check.

    ``dims`` maps check name to (fact column, dimension, dimension key). The foreign keys are
    written once, by themselves; each check counts its keys before any shuffle, so a hot
    or NULL key costs one row per task, and compares them in their own type. A NULL key has
    no partner. A check on an empty fact gives 0.
    """
    columns = list(dict.fromkeys(col for col, _, _ in dims.values()))
    keys = as_table(fact.select(*columns), "keys")
    counted = [
        keys.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
        .join(d.select(F.col(key).alias(col)).distinct(), col, "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(out))
        .select(F.lit(name).alias("check_nombre"), out)
        for name, (col, d, key) in dims.items()
    ]
    return stack(counted)


def keep_selected(df: DataFrame, selection: Mapping[str, Iterable] | None) -> DataFrame:
    """AND of ``isin`` filters; an empty choice means no filter on that column."""
    wanted = {c: list(v) for c, v in (selection or {}).items() if v}
    tests: list[Column] = [F.col(c).isin(v) for c, v in wanted.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


def picker_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a column, sorted."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def duplicate_keys(df: DataFrame, keys: list[str], out: str = "veces") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys of ``left`` that ``right`` lacks."""
    return (
        left.select(key).where(F.col(key).isNotNull()).distinct()
        .join(right.select(key).distinct(), key, "left_anti")
    )
