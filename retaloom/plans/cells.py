"""Cells: facts added up by their keys, kept up to date by signed changes.

A cell holds the sums of a fact for one combination of keys, the number of its rows, and per
measure the number of rows that have a value. All of these are additive, so a change of the fact is a few signed
rows: added rows count once, removed rows minus once, and a late return only adds to the
returned units of the lines it belongs to. A cell whose rows are all gone goes too.

Neither attributes nor targets are in a cell. A cube is its cells joined with the dimensions and
targets of the day, so a changed target or attribute changes no cell, only the months whose
cube rows must be published anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

PERIOD, ROWS, SIGN = "periodo", "filas", "signo"


@dataclass(frozen=True)
class Shape:
    """What the cells of a fact are kept by and what they add up."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]

    @property
    def counts(self) -> list[str]:
        return [f"con_{m}" for m in self.sums]


SALES = Shape(
    ("id_fecha", "id_canal", "id_geografia", "id_producto", "id_vendedor"),
    ("ventas_netas_soles", "monto_bruto_soles", "costo_ventas_soles", "inversion_promocional_soles",
     "cantidad_vendida", "unidades_devueltas", "monto_devuelto_soles"))
STOCK = Shape(
    ("id_fecha", "id_almacen", "id_producto"),
    ("stock_disponible", "stock_reservado", "demanda_diaria_prom", "sin_stock"))


def period() -> Column:
    return F.expr("id_fecha div 100").cast("int").alias(PERIOD)


def stock_rows(fact: DataFrame) -> DataFrame:
    """Inventory rows with a measure for being out of stock."""
    return fact.withColumn("sin_stock", F.when(F.col("stock_disponible") <= 0, 1).otherwise(0))


def cells(rows: DataFrame, shape: Shape) -> DataFrame:
    """Cells of fact rows; those with a column ``signo`` count by it, and not as rows where it is 0."""
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
    value = lambda m: F.when(sign < 0, -F.col(m)).otherwise(F.col(m))
    has = lambda m: F.when(F.col(m).isNotNull(), sign).otherwise(0)
    return rows.groupBy(period(), *shape.keys).agg(
        F.sum(sign).alias(ROWS),
        *[F.sum(value(m)).alias(m) for m in shape.sums],
        *[F.sum(has(m)).alias(c) for m, c in zip(shape.sums, shape.counts)])


def merged(before: DataFrame, change: DataFrame, shape: Shape) -> DataFrame:
    """The cells after a change, in the types they had."""
    types = {f.name: f.dataType for f in before.schema.fields}
    added = [ROWS, *shape.sums, *shape.counts]
    both = before.select(PERIOD, *shape.keys, *added).unionByName(change.select(PERIOD, *shape.keys, *added))
    return both.groupBy(PERIOD, *shape.keys).agg(*[F.sum(c).alias(c) for c in added]).where(
        F.col(ROWS) != 0).select(PERIOD, *shape.keys, *[F.col(c).cast(types[c]).alias(c) for c in added])


def as_fact(of: DataFrame, shape: Shape) -> DataFrame:
    """Cells in the columns of the fact they came from; a measure without a value is NULL again."""
    return of.select(
        *shape.keys, ROWS,
        *[F.when(F.col(c) > 0, F.col(m)).alias(m) for m, c in zip(shape.sums, shape.counts)])


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign))


def returns_change(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """What changed returns add to the sale lines that were there before and still are.

    ``returns`` may have a sign. They are added up per invoice and product first, and
    find their lines by these keys; the lines' own months follow from them.
    """
    sign = F.col(SIGN) if SIGN in returns.columns else F.lit(1)
    per_key = returns.groupBy(F.col("num_factura_origen").alias("num_factura"), "id_producto").agg(
        F.sum(F.col("cantidad_devuelta") * sign).alias("unidades_devueltas"),
        F.sum(F.when(sign < 0, -F.col("monto_devolucion_soles")).otherwise(F.col("monto_devolucion_soles")))
        .alias("monto_devuelto_soles"))
    kept = [c for c in (*SALES.keys, "num_factura") if c != "id_producto"]
    found = lines.select(*kept, "id_producto").join(per_key, ["num_factura", "id_producto"])
    # Returned units show on the lines as they are; all else stays as it was.
    zero = [F.lit(None).cast("decimal(18,2)").alias(m) for m in SALES.sums if m not in per_key.columns]
    of = found.select(
        *SALES.keys, *zero, F.coalesce("unidades_devueltas", F.lit(0)).alias("unidades_devueltas"),
        F.coalesce("monto_devuelto_soles", F.lit(0)).alias("monto_devuelto_soles"))
    return signed(of, 0)


def sales_change(added: DataFrame, removed: DataFrame | None = None, late: DataFrame | None = None) -> DataFrame:
    """Cells of a change of sales: fact rows added and removed, and what late returns add."""
    change = cells(signed(added, 1), SALES)
    for rows in ([signed(removed, -1)] if removed is not None else []) + ([late] if late is not None else []):
        change = change.unionByName(cells(rows, SALES))
    return change.groupBy(PERIOD, *SALES.keys).agg(
        *[F.sum(c).alias(c) for c in (ROWS, *SALES.sums, *SALES.counts)])


def months_of_keys(of: DataFrame, key: str, changed: DataFrame) -> DataFrame:
    """Months with cells of dimension keys whose attributes changed; two columns are read."""
    return of.select(PERIOD, key).join(changed.select(key).distinct(), key, "left_semi").select(PERIOD).distinct()


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys of a dimension or target table whose rows differ."""
    return before.exceptAll(after).select(key).unionByName(after.exceptAll(before).select(key)).distinct()
