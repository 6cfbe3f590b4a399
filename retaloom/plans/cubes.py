"""Pre-aggregated cubes over the star."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, functions as F

from retaloom.functions.numbers import percent, ratio, rounded
from retaloom.operators.star import Dim, star_cube

TIME = [
    "anio", "semestre", "trimestre", "mes", "mes_nombre", "anio_mes", "semana_anio",
    "semana_label", "fecha", "periodo",
]
INVENTORY_TIME = [
    "anio", "mes", "mes_nombre", "anio_mes", "semana_anio", "semana_label", "fecha", "periodo",
]
CHANNEL = ["nombre_canal", "tipo_canal"]
PLACE = ["macroregion", "Departamento", "provincia", "ciudad", "tipo_zona"]
PRODUCT = ["linea_negocio", "categoria", "subcategoria", "marca", "cod_sku", "nombre_sku"]
STORE = ["nombre_almacen", "tipo_almacen", "macroregion", "region", "ciudad"]

# cube column -> target column it is the maximum of
COMMERCIAL_TARGETS = {
    "meta_ventas_netas": "meta_ventas_netas_soles",
    "meta_margen_bruto": "meta_margen_bruto_soles",
    "meta_margen_pct": "meta_margen_bruto_pct",
    "meta_cantidad_vendida": "meta_cantidad_vendida",
    "meta_ticket_promedio": "meta_ticket_promedio_soles",
    "meta_frecuencia_compra": "meta_frecuencia_compra",
    "meta_roi_pct": "meta_roi_promocional_pct",
    "meta_tasa_devolucion": "meta_tasa_devolucion_pct",
}
OPERATIONAL_TARGETS = (
    "meta_quiebre_pct", "meta_dias_cobertura", "meta_otif_pct", "meta_fill_rate_pct",
)


def _seller() -> list[str | Column]:
    return [F.col("nombre_completo").alias("nombre_vendedor"), F.col("zona_asignada")]


def _time(star, attrs: list[str]) -> Dim:
    return Dim(star.dim("tiempo"), "id_fecha", attrs, unique=True, small=True)


def _product(star) -> Dim:
    return Dim(star.dim("producto"), "id_producto", PRODUCT, large=True)


def with_targets(fact: DataFrame, targets: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Put the targets of (period, ``key``) on each fact row.

    An inner join drops rows whose period has no target, as the commercial and
    inventory cubes do by definition; ``how="left"`` keeps them. The period is
    the date key without its day, so no calendar join is needed here.
    """
    wanted = [c for c in targets.columns if c.startswith("meta_")]
    return fact.withColumn("periodo", F.expr("id_fecha div 100")).join(
        targets.select("periodo", key, *wanted), ["periodo", key], how
    ).drop("periodo")


def _targets(
    fact: DataFrame, targets: DataFrame, dim: Dim, how: str, names: dict[str, str],
) -> tuple[DataFrame, list[Column], Callable[[DataFrame], DataFrame] | None]:
    """The fact with what a cube needs of its targets, the measures, and what is joined later.

    Where the keys of ``dim`` are told apart, a cell is of one day and one key, so all its rows have
    the same targets: rows are matched by period and key alone, and the targets put on the
    cells. Otherwise every row carries them, and a cell has their maximum.
    """
    if not dim.unique:
        return with_targets(fact, targets, dim.key, how), [F.max(c).alias(n) for n, c in names.items()], None
    per_key = targets.groupBy("periodo", dim.key).agg(*[F.max(c).alias(n) for n, c in names.items()])

    def later(cells: DataFrame) -> DataFrame:
        on = per_key.withColumnsRenamed({"periodo": "_p", dim.key: "_k"})
        same = (F.expr("id_fecha div 100") == F.col("_p")) & (F.col(dim.key) == F.col("_k"))
        return cells.join(on, same, "left").drop("_p", "_k")

    return with_targets(fact, targets.select("periodo", dim.key), dim.key, how), [], later


def commercial(star, how: str = "inner", levels: Collection[str] | None = None) -> DataFrame:
    """Sales measures and targets by all attributes, or by those named in ``levels``."""
    channel = Dim(star.small("canal"), "id_canal", CHANNEL)
    if levels is None:
        channel = channel.told_apart()
    fact, targets, later = _targets(
        star.fact("ventas"), star.small("metas_comercial"), channel, how, COMMERCIAL_TARGETS)
    net, cost = F.col("ventas_netas_soles"), F.col("costo_ventas_soles")
    measures = [
        F.sum(net).alias("ventas_netas"),
        F.sum("monto_bruto_soles").alias("venta_bruta"),
        F.sum(cost).alias("costo_ventas"),
        F.sum(net - cost).alias("margen_bruto"),
        F.sum("inversion_promocional_soles").alias("inversion_promo"),
        F.sum("cantidad_vendida").alias("cantidad_vendida"),
        F.sum("unidades_devueltas").alias("unidades_devueltas"),
        F.sum("monto_devuelto_soles").alias("monto_devuelto"),
    ]
    dims = [
        _time(star, TIME),
        channel,
        Dim(star.small("geografia"), "id_geografia", PLACE),
        _product(star),
        Dim(star.dim("vendedor"), "id_vendedor", _seller()),
    ]
    return star_cube(fact, dims, [*measures, *targets], levels, later=later)


def invoice_dims(star) -> list[Dim]:
    return [
        _time(star, TIME),
        Dim(star.small("canal"), "id_canal", CHANNEL),
        Dim(star.small("geografia"), "id_geografia", PLACE),
        Dim(star.dim("vendedor"), "id_vendedor", _seller()),
    ]


def invoices(star) -> DataFrame:
    """Net sales with distinct invoices and distinct active customers."""
    measures = [
        F.sum("ventas_netas_soles").alias("ventas_netas"),
        F.count_distinct("num_factura").alias("num_facturas"),
        F.count_distinct("id_cliente").alias("num_clientes_activos"),
    ]
    return star_cube(star.fact("ventas"), invoice_dims(star), measures)


def invoices_net(star, levels: Collection[str]) -> DataFrame:
    """Net sales by levels of the invoice cube."""
    net = F.sum("ventas_netas_soles").alias("ventas_netas")
    return star_cube(star.fact("ventas"), invoice_dims(star), [net], levels)


def invoices_deduplicated(star) -> DataFrame:
    """Invoice counts without DISTINCT: one row per invoice and surrogate keys first."""
    keys = ["num_factura", "id_fecha", "id_canal", "id_geografia", "id_vendedor"]
    once = star.fact("ventas").groupBy(*keys).agg(F.sum("ventas_netas_soles").alias("_net"))
    measures = [F.sum("_net").alias("ventas_netas"), F.count(F.lit(1)).alias("num_facturas")]
    return star_cube(once, invoice_dims(star), measures)


def _inventory(star, measures: list[Column], how: str) -> DataFrame:
    store = Dim(star.small("almacen"), "id_almacen", STORE).told_apart()
    fact, targets, later = _targets(
        star.fact("inventario"), star.small("metas_operativo"), store, how, {t: t for t in OPERATIONAL_TARGETS})
    dims = [
        _time(star, INVENTORY_TIME),
        store,
        _product(star),
    ]
    return star_cube(fact, dims, [*measures, *targets], later=later)


def _inventory_measures(of_cells: bool = False) -> list[Column]:
    """Measures of snapshot rows, or of cells, which carry their number of rows."""
    out = F.col("sin_stock") if of_cells else F.when(F.col("stock_disponible") <= 0, 1).otherwise(0)
    return [
        F.sum("stock_disponible").alias("stock_disponible"),
        F.sum("stock_reservado").alias("stock_reservado"),
        F.sum(out).alias("skus_en_quiebre"),
        (F.sum("filas") if of_cells else F.count(F.lit(1))).alias("total_skus"),
        F.sum("demanda_diaria_prom").alias("demanda_diaria_total"),
    ]


def inventory(star, how: str = "inner") -> DataFrame:
    """Stock with its out-of-stock rate and days of cover, rounded per cell."""
    cube = _inventory(star, _inventory_measures(), how)
    rate = percent("skus_en_quiebre", "total_skus", 2)
    cover = rounded(ratio("stock_disponible", "demanda_diaria_total"), 1)
    columns = []
    for c in cube.columns:
        if c == "demanda_diaria_total":
            columns += [rate.alias("tasa_quiebre_pct"), cover.alias("dias_cobertura")]
        else:
            columns.append(F.col(c))
    return cube.select(*columns)


def inventory_additive(star, how: str = "inner", of_cells: bool = False) -> DataFrame:
    """Additive measures only; rates are derived when read. ``of_cells``: the fact is cells."""
    return _inventory(star, _inventory_measures(of_cells), how)
