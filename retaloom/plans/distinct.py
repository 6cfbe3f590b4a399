"""Distinct counts that add up: a cube of bitmaps over dense numbers.

A cell of the invoice cube holds a count, and counts of invoices or customers cannot be added:
who bought in two months would count twice. A cell of this cube holds bitmaps instead, one per
32,768 numbers, in which invoice or customer n has bit n. The bitmaps of any selection are
or-ed and their bits counted, so every roll-up is exact without going back to the fact, and
cells of new data are or-ed onto stored ones.

Numbers are dense and given in an order that keeps the members of a cell together: invoices
by date, customers by place. A cell then has bits in few bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from retaloom.functions.numbers import ratio, rounded, total
from retaloom.operators.numbering import number_rows
from retaloom.operators.star import star_cube
from retaloom.plans import cubes

LEVELS = ["anio_mes", "tipo_canal", "nombre_canal", "Departamento"]
BUCKET, MAP, NUMBER = "cubeta", "mapa", "numero"
INVOICE, CUSTOMER = ("num_factura", "id_fecha"), ("id_cliente", "id_geografia")
LEVEL_ID = "nivel"
MAP_BYTES = 4096  # of a bitmap
TASK_BYTES = 32 << 20  # of bitmaps for a task


def numbers(fact: DataFrame, column: str, near: str, known: DataFrame | None = None) -> DataFrame:
    """A dense number per value of a column, ordered by the smallest ``near`` it occurs with.

    ``known`` numbers stay as they are, and new values are numbered behind them.
    """
    values = fact.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(near).alias("_near"))
    if known is None:
        return number_rows(values, ["_near", column], NUMBER).drop("_near")
    last = known.agg(F.coalesce(F.max(NUMBER), F.lit(0)).alias("_last"))  # one row
    new = number_rows(values.join(known, column, "left_anti"), ["_near", column], NUMBER).drop("_near")
    return known.select(column, NUMBER).unionByName(
        new.join(F.broadcast(last)).select(column, (F.col(NUMBER) + F.col("_last")).alias(NUMBER)))


def bitmaps(star, column: str, numbered: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(levels, bucket, bitmap) of the numbers that occur in each cell of the invoice cube."""
    def gathered(rows: DataFrame, groups: list[str]) -> DataFrame:
        # A number once per cell, then all of a cell's bucket in one task: tasks sort and shuffle
        # narrow rows, at most one per bit, and no two make bitmaps of 4 kB for the same bucket.
        once = rows.select(column, *groups).distinct().join(numbered, column)
        return once.withColumn(BUCKET, F.bitmap_bucket_number(NUMBER)).repartition(*groups, BUCKET)

    rows = star.fact("ventas").where(F.col(column).isNotNull())
    made = F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(MAP)
    return star_cube(rows, cubes.invoice_dims(star), [made], levels, also=[BUCKET], gathered=gathered)


def merged(cells: Sequence[DataFrame], levels: Sequence[str] = LEVELS) -> DataFrame:
    """Bitmap cells of several loads as one: bits are or-ed, so a load may come twice."""
    return reduce(DataFrame.unionByName, cells).groupBy(*levels, BUCKET).agg(F.bitmap_or_agg(MAP).alias(MAP))


def count_at(cells: DataFrame, sets: Sequence[Sequence[str]], out: str, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Exact distinct counts at each of the grouping sets."""
    # Bitmaps compress to a fraction in shuffles and files, so tasks are sized by what they unpack to.
    # No cell is in two buckets: each set is or-ed where the buckets are, and only counts are moved on.
    n = max(1, -(-cells.count() * MAP_BYTES // TASK_BYTES))
    dealt = cells.select(*levels, BUCKET, MAP).repartition(n, BUCKET)
    types = {f.name: f.dataType for f in cells.schema.fields}

    def one(s: Sequence[str]) -> DataFrame:
        level = sum(1 << i for i, c in enumerate(reversed(levels)) if c not in s)  # as grouping_id
        counted = dealt.groupBy(*s, BUCKET).agg(F.bitmap_count(F.bitmap_or_agg(MAP)).alias("_n"))
        return counted.select(*[
            F.col(c) if c in s else F.lit(None).cast(types[c]).alias(c) for c in levels],
            F.lit(level).cast("bigint").alias(LEVEL_ID), "_n")

    return reduce(DataFrame.unionByName, map(one, sets)).groupBy(*levels, LEVEL_ID).agg(F.sum("_n").alias(out))


def sum_at(cube: DataFrame, sets: Sequence[Sequence[str]], column: str, levels: Sequence[str] = LEVELS) -> DataFrame:
    return cube.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in levels]).agg(
        F.grouping_id().alias(LEVEL_ID), total(column).alias(column))


def _beside(frames: dict[str, DataFrame], levels: Sequence[str]) -> DataFrame:
    """Frames of one row per level and cell as columns; a tagged union, as cells may be NULL."""
    wide = [df.select(*levels, LEVEL_ID, *[
        F.col(c).cast("double").alias(c) if c == name else F.lit(None).cast("double").alias(c)
        for c in frames]) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, wide).groupBy(*levels, LEVEL_ID).agg(
        *[F.max(c).alias(c) for c in frames])


def ticket_at(cube: DataFrame, invoices: DataFrame, sets: Sequence[Sequence[str]],
              levels: Sequence[str] = LEVELS) -> DataFrame:
    """Net sales, exact invoices and the ticket at every grouping set, from cubes alone."""
    both = _beside({
        "ventas_netas": sum_at(cube, sets, "ventas_netas", levels),
        "num_facturas": count_at(invoices, sets, "num_facturas", levels)}, levels)
    return both.withColumn("ticket_promedio", rounded(ratio("ventas_netas", "num_facturas"), 4)).withColumn(
        "num_facturas", F.col("num_facturas").cast("bigint"))


def frequency_at(invoices: DataFrame, customers: DataFrame, sets: Sequence[Sequence[str]],
                 levels: Sequence[str] = LEVELS) -> DataFrame:
    """Exact invoices per exact customer at every grouping set, from cubes alone."""
    both = _beside({
        "facturas": count_at(invoices, sets, "facturas", levels),
        "clientes": count_at(customers, sets, "clientes", levels)}, levels)
    return both.select(
        *levels, LEVEL_ID, F.col("facturas").cast("bigint").alias("facturas"),
        F.col("clientes").cast("bigint").alias("clientes"),
        rounded(ratio("facturas", "clientes"), 6).alias("frecuencia_compra"))
