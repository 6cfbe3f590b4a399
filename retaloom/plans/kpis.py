"""KPIs over the cubes. Every function maps frames to a frame; nothing is collected."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.functions.numbers import mean, or_zero, percent, ratio, rounded, total
from retaloom.operators.joins import keep_selected, side_by_side
from retaloom.operators.pivot import pivot_table
from retaloom.sources.places import coordinates

Selection = Mapping[str, Iterable] | None


# -- commercial -------------------------------------------------------------------


def commercial_totals(cube: DataFrame, selection: Selection = None) -> DataFrame:
    sums = keep_selected(cube, selection).agg(
        F.sum("ventas_netas").alias("ventas_netas"),
        F.sum("margen_bruto").alias("margen_bruto"),
        F.sum("inversion_promo").alias("inversion_promo"),
        F.sum("cantidad_vendida").alias("cantidad_vendida"),
        F.sum("unidades_devueltas").alias("unidades_devueltas"),
    )
    profit = F.col("margen_bruto") - F.col("inversion_promo")
    return sums.select(
        *[or_zero(F.col(c).cast("double")).alias(c) for c in
          ("ventas_netas", "margen_bruto", "inversion_promo")],
        F.coalesce("cantidad_vendida", F.lit(0)).alias("cantidad_vendida"),
        F.coalesce("unidades_devueltas", F.lit(0)).alias("unidades_devueltas"),
        or_zero(percent("margen_bruto", "ventas_netas", 4)).alias("margen_pct"),
        or_zero(percent("unidades_devueltas", "cantidad_vendida", 4)).alias("tasa_devolucion"),
        or_zero(percent(profit, F.col("inversion_promo"), 4)).alias("roi_pct"),
    )


# Columns the invoice cube can be filtered by: it has no product dimension, so a
# brand choice narrows the sales of a ticket but not its invoices.
INVOICE_FILTERS = ("anio_mes", "nombre_canal", "Departamento", "tipo_canal")


def _for_invoices(selection: Selection) -> dict:
    return {k: v for k, v in (selection or {}).items() if k in INVOICE_FILTERS}


def average_ticket(cube: DataFrame, invoices: DataFrame, selection: Selection = None) -> DataFrame:
    """Net sales of the commercial cube over the invoices of the invoice cube."""
    both = side_by_side({
        "ventas_netas": keep_selected(cube, selection).agg(total("ventas_netas").alias("v")),
        "num_facturas": keep_selected(invoices, _for_invoices(selection)).agg(
            F.sum("num_facturas").cast("double").alias("v")),
    })
    return both.select(
        or_zero(F.col("ventas_netas")).alias("ventas_netas"),
        F.coalesce(F.col("num_facturas"), F.lit(0)).cast("bigint").alias("num_facturas"),
        or_zero(rounded(ratio("ventas_netas", "num_facturas"), 4)).alias("ticket_promedio"),
    )


def exact_ticket(fact: DataFrame) -> DataFrame:
    """The same ticket with invoices counted once over the whole selection."""
    return fact.agg(
        total("ventas_netas_soles").alias("ventas_netas"),
        F.count_distinct("num_factura").alias("num_facturas"),
        F.count_distinct("id_cliente").alias("num_clientes"),
    ).withColumn("ticket_promedio", rounded(ratio("ventas_netas", "num_facturas"), 4))


def purchase_frequency(
    fact: DataFrame,
    days: DataFrame,
    channels: DataFrame,
    periods: Iterable[str] = (),
    names: Iterable[str] = (),
) -> DataFrame:
    """Distinct invoices per distinct customer, narrowed by period and channel."""
    if periods:
        wanted = days.where(F.col("anio_mes").isin(list(periods))).select("id_fecha")
        fact = fact.join(wanted, "id_fecha", "left_semi")
    if names:
        wanted = channels.where(F.col("nombre_canal").isin(list(names))).select("id_canal")
        fact = fact.join(wanted, "id_canal", "left_semi")
    counts = fact.agg(
        F.count_distinct("num_factura").alias("facturas"),
        F.count_distinct("id_cliente").alias("clientes"),
    )
    return counts.select(
        "facturas", "clientes", rounded(ratio("facturas", "clientes"), 6).alias("frecuencia_compra"))


TARGET_SUMS = ("meta_ventas_netas", "meta_margen_bruto", "meta_cantidad_vendida")
TARGET_MEANS = (
    "meta_margen_pct", "meta_ticket_promedio", "meta_frecuencia_compra", "meta_roi_pct",
    "meta_tasa_devolucion",
)


def target_rollup(cube: DataFrame, selection: Selection = None) -> DataFrame:
    """Targets of the selection; each (channel, period) target counts once."""
    once = (
        keep_selected(cube, selection).groupBy("nombre_canal", "periodo")
        .agg(*[F.max(c).alias(c) for c in TARGET_SUMS + TARGET_MEANS])
    )
    return once.agg(
        *[or_zero(total(c)).alias(c) for c in TARGET_SUMS],
        *[rounded(mean(c), 4).alias(c) for c in TARGET_MEANS],
    )


def status(value: Column, target: Column, lower_is_better: bool = False) -> Column:
    """Met, missed, or NULL when there is no target (NULL or zero)."""
    met = value <= target if lower_is_better else value >= target
    return F.when(target.isNotNull() & (target != 0), met)


# (name, value column, target column, whether a lower value is better)
COMMERCIAL_KPIS = (
    ("ventas_netas", "ventas_netas", "meta_ventas_netas", False),
    ("utilidad_bruta", "margen_bruto", "meta_margen_bruto", False),
    ("margen_pct", "margen_pct", "meta_margen_pct", False),
    ("cantidad_vendida", "cantidad_vendida", "meta_cantidad_vendida", False),
    ("ticket_promedio", "ticket_promedio", "meta_ticket_promedio", False),
    ("frecuencia_compra", "frecuencia_compra", "meta_frecuencia_compra", False),
    ("roi_promocional", "roi_pct", "meta_roi_pct", False),
    ("tasa_devolucion", "tasa_devolucion", "meta_tasa_devolucion", True),
)


def _named_values(df: DataFrame, kind: str) -> DataFrame:
    listed = F.array(*[
        F.struct(F.lit(c).alias("nombre"), F.col(c).cast("double").alias(kind)) for c in df.columns
    ])
    return df.select(F.inline(listed))


def target_status(values: list[DataFrame], targets: DataFrame) -> DataFrame:
    """(kpi, valor, meta, cumple) from one-row frames of values and of targets."""
    spark = targets.sparkSession
    plan = spark.createDataFrame(
        list(COMMERCIAL_KPIS), "kpi string, valor_de string, meta_de string, menor boolean")
    found = _named_values(values[0], "valor")
    for more in values[1:]:
        found = found.unionByName(_named_values(more, "valor"))
    found = found.groupBy("nombre").agg(F.max("valor").alias("valor"))
    goals = _named_values(targets, "meta")
    joined = (
        plan.join(found, plan.valor_de == found.nombre, "left").drop("nombre")
        .join(goals, F.col("meta_de") == goals.nombre, "left")
    )
    met = F.when(F.col("menor"), status(F.col("valor"), F.col("meta"), True)).otherwise(
        status(F.col("valor"), F.col("meta")))
    return joined.select("kpi", "valor", "meta", met.alias("cumple"))


def attainment(cube: DataFrame, selection: Selection = None) -> DataFrame:
    """Sales against target per channel; targets first folded to one per period."""
    once = (
        keep_selected(cube, selection).groupBy("nombre_canal", "periodo")
        .agg(F.sum("ventas_netas").alias("ventas"), F.max("meta_ventas_netas").alias("meta"))
    )
    return (
        once.groupBy("nombre_canal")
        .agg(total("ventas").alias("ventas_reales"), total("meta").alias("meta_ventas"))
        .withColumn("cumplimiento_pct", percent("ventas_reales", "meta_ventas", 1))
        .orderBy(F.desc("cumplimiento_pct"), "nombre_canal")
    )


def by(cube: DataFrame, keys: list[str], column: str = "ventas_netas") -> DataFrame:
    return cube.groupBy(*keys).agg(total(column).alias(column))


def region_map(cube: DataFrame) -> DataFrame:
    """Sales per department with its position; unknown departments drop out."""
    return by(cube, ["Departamento"]).join(
        F.broadcast(coordinates(cube.sparkSession)), "Departamento")


def product_ranking(cube: DataFrame, top: int | None = None) -> DataFrame:
    """Products by sales. ``top`` makes it a top-k report instead of a full sort."""
    ranked = (
        cube.groupBy("marca", "nombre_sku")
        .agg(
            total("ventas_netas").alias("ventas_netas"),
            F.sum("cantidad_vendida").alias("cantidad_vendida"),
            F.sum("margen_bruto").alias("_m"),
        )
        .withColumn("margen_pct", percent("_m", "ventas_netas", 1))
        .drop("_m")
        .orderBy(F.desc("ventas_netas"), "marca", "nombre_sku")
    )
    return ranked.limit(top) if top else ranked


def line_share(cube: DataFrame) -> DataFrame:
    """Sales per business line and its share of the whole; one row per line enters the window."""
    lines = cube.groupBy("linea_negocio").agg(F.sum("ventas_netas").alias("_v"))
    whole = F.sum("_v").over(Window.partitionBy(F.lit(1)))
    return lines.select(
        "linea_negocio", F.col("_v").cast("double").alias("ventas_netas"),
        percent(F.col("_v"), whole, 2).alias("participacion_pct"),
    )


def margin_by_channel(cube: DataFrame, year: int) -> DataFrame:
    return (
        cube.where(F.col("anio") == year).groupBy("nombre_canal")
        .agg(
            total("ventas_netas").alias("ventas_netas_total"),
            total("margen_bruto").alias("margen_bruto_total"),
        )
        .withColumn("margen_pct", percent("margen_bruto_total", "ventas_netas_total", 2))
        .orderBy(F.desc("ventas_netas_total"))
    )


def drill_month(cube: DataFrame, category: str) -> DataFrame:
    chosen = cube.where(F.col("categoria") == category)
    return by(chosen, ["anio_mes", "categoria"]).orderBy("anio_mes")


def ticket_by(invoices: DataFrame, keys: list[str], year: int | None = None) -> DataFrame:
    chosen = invoices if year is None else invoices.where(F.col("anio") == year)
    return (
        chosen.groupBy(*keys)
        .agg(total("ventas_netas").alias("ventas_netas"), F.sum("num_facturas").alias("facturas"))
        .withColumn("ticket_promedio", rounded(ratio("ventas_netas", "facturas"), 2))
        .orderBy(*keys)
    )


# -- inventory ----------------------------------------------------------------------


def _demand() -> Column:
    """Demand behind a cell, recovered from its stock and its days of cover.

    Cells without cover days carry no demand. The exact sum keeps the result
    independent of the order in which tasks finish.
    """
    return F.sum(
        ratio("stock_disponible", F.nullif("dias_cobertura", F.lit(0.0))).cast("decimal(28,10)"))


def inventory_totals(cube: DataFrame, selection: Selection = None) -> DataFrame:
    sums = keep_selected(cube, selection).agg(
        F.sum("stock_disponible").alias("stock"),
        F.sum("skus_en_quiebre").alias("skus_en_quiebre"),
        F.sum("total_skus").alias("total_skus"),
        _demand().alias("_dem"),
    )
    return sums.select(
        F.coalesce("stock", F.lit(0)).alias("stock_total"),
        F.coalesce("skus_en_quiebre", F.lit(0)).alias("skus_en_quiebre"),
        or_zero(percent("skus_en_quiebre", "total_skus", 4)).alias("tasa_quiebre"),
        or_zero(rounded(ratio("stock", "_dem"), 4)).alias("dias_cobertura"),
    )


def exact_coverage(additive: DataFrame, keys: list[str]) -> DataFrame:
    """Coverage from the additive cube, which keeps the demand of empty cells too."""
    return additive.groupBy(*keys).agg(
        rounded(ratio(F.sum("stock_disponible"), F.sum("demanda_diaria_total")), 4)
        .alias("dias_cobertura"))


def operational_targets(cube: DataFrame, selection: Selection = None) -> DataFrame:
    once = keep_selected(cube, selection).groupBy("nombre_almacen", "periodo").agg(
        F.max("meta_quiebre_pct").alias("q"), F.max("meta_dias_cobertura").alias("c"))
    return once.agg(
        rounded(mean("q"), 4).alias("meta_quiebre"), rounded(mean("c"), 4).alias("meta_dias"))


def stockout_by(cube: DataFrame, keys: list[str]) -> DataFrame:
    return cube.groupBy(*keys).agg(
        F.sum("skus_en_quiebre").alias("skus_en_quiebre"),
        F.sum("total_skus").alias("total_skus"),
        rounded(mean("meta_quiebre_pct"), 4).alias("meta_quiebre_pct"),
    ).withColumn("tasa", percent("skus_en_quiebre", "total_skus", 4))


def month_label() -> Column:
    return F.concat_ws(" ", "mes_nombre", F.col("anio").cast("string"))


def coverage_by(cube: DataFrame, keys: list[str]) -> DataFrame:
    return cube.groupBy(*keys).agg(
        F.sum("stock_disponible").alias("stock"),
        rounded(mean("meta_dias_cobertura"), 4).alias("meta_dias"),
        rounded(ratio(F.sum("stock_disponible"), _demand()), 4).alias("dias"),
    )


def stock_tree(cube: DataFrame) -> DataFrame:
    return cube.groupBy("nombre_almacen", "categoria").agg(
        F.sum("stock_disponible").alias("stock_disponible"))


def stockout_pivot(cube: DataFrame, stores: list[str]) -> DataFrame:
    """Out-of-stock rate, categories down and warehouses across."""
    cells = cube.groupBy("categoria", "nombre_almacen").agg(
        F.sum("skus_en_quiebre").alias("q"), F.sum("total_skus").alias("n"))
    rates = cells.withColumn("tasa", percent("q", "n", 1))
    return pivot_table(rates, "categoria", "nombre_almacen", stores, rounded(F.avg("tasa"), 1))


def stockout_latest_month(cube: DataFrame) -> DataFrame:
    latest = cube.agg(F.max("anio_mes").alias("anio_mes"))  # one row
    return (
        cube.join(F.broadcast(latest), "anio_mes", "left_semi").groupBy("nombre_almacen")
        .agg(
            F.sum("skus_en_quiebre").alias("skus_quiebre"),
            F.sum("total_skus").alias("total_skus"),
            F.max("meta_quiebre_pct").cast("double").alias("meta"),
        )
        .withColumn("tasa_quiebre_pct", percent("skus_quiebre", "total_skus", 2))
        .orderBy(F.desc("tasa_quiebre_pct"), "nombre_almacen")
    )


def target_ratios(cube: DataFrame) -> DataFrame:
    """Out-of-stock rate and coverage as a share of their targets, per warehouse."""
    rows = cube.groupBy("nombre_almacen").agg(
        percent(F.sum("skus_en_quiebre"), F.sum("total_skus"), 4).alias("tasa"),
        rounded(ratio(F.sum("stock_disponible"), _demand()), 4).alias("dias"),
        rounded(mean("meta_quiebre_pct"), 4).alias("mq"),
        rounded(mean("meta_dias_cobertura"), 4).alias("md"),
    )
    return rows.select(
        "nombre_almacen",
        percent("tasa", "mq", 2).alias("quiebre_vs_meta_pct"),
        percent("dias", "md", 2).alias("cobertura_vs_meta_pct"),
    )
