"""Least squares of many series from sufficient sums.

One aggregate per series gives the sums of all products of its columns, exactly, as the columns
are decimals; what is left is a small system of equations per series, which is solved where
the row is, by elimination over an array of arrays. No rows of a series are brought together,
so a series may be of any length and any number of partitions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

TOLERANCE = 1e-9  # a column is left out if less of it is new than this share
MATRIX = "array<array<double>>"


def gram(rows: DataFrame, key: str, columns: Mapping[str, Column], target: Column) -> DataFrame:
    """Per series the number of rows, and the products of its columns with the target's last.

    Rows in which a column or the target is NULL do not take part.
    """
    names = [*columns, "_y"]
    given = rows.select(key, *[c.alias(n) for n, c in {**columns, "_y": target}.items()]).dropna(subset=names)
    upper = {(i, j): f"_s{i}_{j}" for i in range(len(names)) for j in range(i, len(names))}
    sums = given.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.col(names[i]) * F.col(names[j])).cast("double").alias(s) for (i, j), s in upper.items()])
    cell = lambda i, j: F.col(upper[min(i, j), max(i, j)])
    lines = [F.array(*[cell(i, j) for j in range(len(names))]) for i in range(len(names) - 1)]
    return sums.select(key, "n", F.array(*lines).cast(MATRIX).alias("matrix"), cell(len(names) - 1, len(names) - 1).alias("yy"))


def solved(matrix: Column, k: int) -> Column:
    """Coefficients of k columns. One that the columns before it already say gets 0."""
    diagonal = F.transform(matrix, lambda line, i: F.get(line, i))

    def step(m: Column, i: Column) -> Column:
        line = F.get(m, i)
        pivot = F.get(line, i)
        unit = F.transform(line, lambda a: a / F.nullif(pivot, F.lit(0.0)))
        cleared = F.transform(m, lambda row, r: F.when(r == i, unit).otherwise(
            F.zip_with(row, unit, lambda a, b: a - F.get(row, i) * b)))
        dropped = F.transform(m, lambda row, r: F.transform(
            row, lambda a, c: F.when((r == i) | (c == i), F.lit(0.0)).otherwise(a)))
        return F.when(pivot > F.get(diagonal, i) * TOLERANCE, cleared).otherwise(dropped)

    done = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), matrix, step)
    return F.transform(done, lambda line: F.get(line, F.lit(k)))


def fit(rows: DataFrame, key: str, columns: Mapping[str, Column], target: Column) -> DataFrame:
    """key, n and ``coef``: the coefficients in the order of the columns."""
    sums = gram(rows, key, columns, target)
    return sums.select(key, "n", solved(F.col("matrix"), len(columns)).alias("coef"))


# -- the design of a daily series ---------------------------------------------------------

YEAR = 365.25
EPOCH = "2000-01-01"
WAVE = "decimal(8,6)"
AMOUNT = "decimal(16,2)"


def weekday_columns(day: str) -> dict[str, Column]:
    """One column per day of the week, Monday first."""
    return {f"dia_{i}": (F.weekday(day) == i).cast("int").cast("decimal(1,0)") for i in range(7)}


def wave_columns(day: str, harmonics: int, used: Column | None = None) -> dict[str, Column]:
    """Sine and cosine of the year's first harmonics, all 0 where they are not ``used``."""
    out = {}
    for k in range(1, harmonics + 1):
        turn = F.datediff(F.col(day), F.lit(EPOCH).cast("date")) * (k * 2 * 3.141592653589793 / YEAR)
        for name, f in (("sen", F.sin), ("cos", F.cos)):
            wave = F.round(f(turn), 6).cast(WAVE)
            out[f"{name}_{k}"] = wave if used is None else F.when(used, wave).otherwise(F.lit(0).cast(WAVE))
    return out


def daily_design(day: str, harmonics: int, regressors: tuple[str, ...], used: Column | None = None) -> dict[str, Column]:
    return {**weekday_columns(day), **wave_columns(day, harmonics, used),
            **{r: F.col(r).cast(AMOUNT) for r in regressors}}
