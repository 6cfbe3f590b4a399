"""Checks that the layers agree with each other."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.functions.numbers import mean, percent, ratio, rounded, total
from retaloom.functions.text import is_missing
from retaloom.operators.joins import combined, duplicate_keys, orphan_counts, side_by_side, stack

EVERY = "filas"


def count_rows(tables: Mapping[str, DataFrame], label: str = "tabla") -> DataFrame:
    """One row per table with its row count."""
    return stack(
        df.agg(F.count(F.lit(1)).alias(EVERY)).select(F.lit(name).alias(label), EVERY)
        for name, df in tables.items()
    ).orderBy(label)


def date_ranges(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return stack(
        df.agg(F.min(c).alias("fecha_min"), F.max(c).alias("fecha_max"))
        .select(F.lit(name).alias("tabla"), "fecha_min", "fecha_max")
        for name, (df, c) in columns.items()
    ).orderBy("tabla")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("registros")).orderBy(column)


def removed_rows(raw: DataFrame, trusted: DataFrame, removed: Column) -> DataFrame:
    """Rows before and after cleaning, next to the rows the rule should remove."""
    both = combined([
        raw.agg(F.count(F.lit(1)).alias("raw_total"), F.count_if(removed).alias("raw_a_eliminar")),
        trusted.agg(F.count(F.lit(1)).alias("trusted_total")),
    ])
    return both.withColumn("diferencia", F.col("raw_total") - F.col("trusted_total"))


def zero_left(rules: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows still breaking each cleaning rule; every count should be zero."""
    return stack(
        df.agg(F.count_if(broken).alias("registros"))
        .select(F.lit(name).alias("regla"), "registros")
        for name, (df, broken) in rules.items()
    ).orderBy("regla")


def imputed_counts(fill_rate: DataFrame, value: str) -> DataFrame:
    made = []
    for c in ("transportista", "motivo_rechazo"):
        made += [F.count_if(F.col(c).isNull()).alias(f"nulos_{c}"),
                 F.count_if(F.col(c) == value).alias(f"imputados_{c}")]
    return fill_rate.agg(*made)


def pending_sap(promociones: DataFrame) -> DataFrame:
    return promociones.groupBy("flag_sap_id_pendiente").agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(is_missing(F.col("id_promocion_sap"))).alias("sin_id_sap"),
    ).orderBy("flag_sap_id_pendiente")


def calendar_coverage(days: DataFrame) -> DataFrame:
    return days.agg(
        F.count(F.lit(1)).alias("total_dias"),
        F.min("fecha").alias("fecha_minima"),
        F.max("fecha").alias("fecha_maxima"),
        F.count_if(F.col("es_feriado") == 1).alias("dias_feriado"),
        F.count_if(F.col("es_dia_habil") == 1).alias("dias_habiles"),
        F.count_if(F.col("es_fin_semana") == 1).alias("dias_fin_semana"),
        F.count_distinct("anio").alias("anios_distintos"),
        F.count_distinct("trimestre").alias("trimestres_distintos"),
    )


def gaps(days: DataFrame, day: str) -> DataFrame:
    """Runs of days missing between the first and the last: desde, hasta, dias.

    Days are made distinct first, so the window sees one row per day that there is.
    """
    once = days.where(F.col(day).isNotNull()).select(F.col(day).alias("_d")).distinct()
    following = F.lead("_d").over(Window.orderBy("_d"))
    return once.withColumn("_next", following).where(F.datediff("_next", "_d") > 1).select(
        F.date_add("_d", 1).alias("desde"), F.date_sub("_next", 1).alias("hasta"),
        (F.datediff("_next", "_d") - 1).alias("dias"))


def calendar_gaps(days: DataFrame, fact: DataFrame) -> DataFrame:
    """Holes in the calendar, and runs of calendar days without a sale, at its ends too."""
    key = "id_fecha"
    sold = fact.select(key).distinct().withColumn("_sold", F.lit(True))
    known = days.select("fecha", key).distinct().join(sold, key, "left")
    in_order = Window.orderBy("fecha")  # one row per calendar day
    # Days without a sale belong together while their number among all days keeps pace with
    # their number among themselves.
    run = F.row_number().over(in_order) - F.sum(F.when(F.col("_sold").isNull(), 1).otherwise(0)).over(in_order)
    idle = known.withColumn("_run", run).where(F.col("_sold").isNull()).groupBy("_run").agg(
        F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"), F.count(F.lit(1)).alias("dias"))
    named = lambda df, name: df.select(
        F.lit(name).alias("tabla"), "desde", "hasta", F.col("dias").cast("bigint").alias("dias"))
    return stack([named(gaps(days, "fecha"), "calendario"), named(idle, "ventas")]).orderBy("tabla", "desde")


def sales_integrity(star) -> DataFrame:
    dims = {
        "sin_dim_tiempo": ("id_fecha", star.dim("tiempo"), "id_fecha"),
        "sin_dim_canal": ("id_canal", star.dim("canal"), "id_canal"),
        "sin_dim_producto": ("id_producto", star.dim("producto"), "id_producto"),
        "sin_dim_cliente": ("id_cliente", star.dim("cliente"), "id_cliente"),
        "sin_dim_vendedor": ("id_vendedor", star.dim("vendedor"), "id_vendedor"),
        "sin_dim_almacen": ("id_almacen", star.dim("almacen"), "id_almacen"),
        "sin_dim_geografia": ("id_geografia", star.dim("geografia"), "id_geografia"),
    }
    return orphan_counts(star.fact("ventas"), dims)


def inventory_integrity(star) -> DataFrame:
    dims = {
        "sin_dim_tiempo": ("id_fecha", star.dim("tiempo"), "id_fecha"),
        "sin_dim_producto": ("id_producto", star.dim("producto"), "id_producto"),
        "sin_dim_almacen": ("id_almacen", star.dim("almacen"), "id_almacen"),
    }
    return orphan_counts(star.fact("inventario"), dims)


def trusted_orphans(star) -> DataFrame:
    dims = {
        "clientes_huerfanos": ("id_cliente", star.dim("cliente"), "id_cliente"),
        "productos_huerfanos": ("id_producto", star.dim("producto"), "id_producto"),
    }
    return orphan_counts(star.trusted("ventas"), dims, out="registros")


def key_uniqueness(days: DataFrame) -> DataFrame:
    """Calendar keys that appear more than once; none should."""
    return duplicate_keys(days, ["id_fecha"])


def sales_measures(fact: DataFrame) -> DataFrame:
    net = F.col("ventas_netas_soles")
    return fact.agg(
        F.count_if(net <= 0).alias("ventas_netas_no_positivas"),
        F.count_if(F.col("cantidad_vendida") <= 0).alias("cantidad_no_positiva"),
        F.count_if(F.col("costo_ventas_soles") < 0).alias("costo_negativo"),
        F.min(net).alias("min_ventas_netas"),
        F.max(net).alias("max_ventas_netas"),
        rounded(mean(net), 2).alias("avg_ventas_netas"),
    )


def stock_measures(fact: DataFrame) -> DataFrame:
    stock = F.col("stock_disponible")
    return fact.agg(F.count_if(stock < 0).alias("registros_stock_negativo"),
                    F.min(stock).alias("stock_minimo"))


def returns_conserved(fact: DataFrame, devoluciones: DataFrame) -> DataFrame:
    return side_by_side({
        "curated_devueltas": fact.agg(F.sum("unidades_devueltas").alias("v")),
        "trusted_devueltas": devoluciones.agg(F.sum("cantidad_devuelta").alias("v")),
    })


def sales_sample(fact: DataFrame, n: int = 5) -> DataFrame:
    """A few fact rows, lowest invoice and product first."""
    columns = ["num_factura", "id_producto", "id_fecha", "id_cliente", "id_canal", "id_vendedor",
               "id_almacen", "cantidad_vendida", "ventas_netas_soles", "costo_ventas_soles",
               "unidades_devueltas", "monto_devuelto_soles"]
    return fact.select(*columns).orderBy(*columns).limit(n)


def target_coverage(targets: DataFrame) -> DataFrame:
    return targets.groupBy("id_canal").agg(
        F.count_distinct("periodo").alias("periodos_con_meta"),
        F.min("periodo").alias("periodo_min"),
        F.max("periodo").alias("periodo_max"),
    ).orderBy("id_canal")


def first_purchases(clientes: DataFrame, start: str, today: Column | None = None) -> DataFrame:
    first = F.col("fecha_primer_compra")
    return clientes.agg(
        F.count_if(first.isNull()).alias("sin_compra"),
        F.count_if(first < F.lit(start).cast("date")).alias("anterior_al_inicio"),
        F.count_if(first > (F.current_date() if today is None else today)).alias("fecha_futura"),
        F.min(first).alias("primer_compra_min"),
        F.max(first).alias("primer_compra_max"),
    )


def compare_totals(left: DataFrame, lcol: str, right: DataFrame, rcol: str,
                   names: tuple[str, str]) -> DataFrame:
    """Two totals and their absolute difference, each table read once."""
    both = side_by_side({
        names[0]: left.agg(F.sum(lcol).alias("v")),
        names[1]: right.agg(F.sum(rcol).alias("v")),
    })
    gap = F.abs(F.col(names[0]) - F.col(names[1]))
    return both.select(
        F.round(names[0], 2).cast("double").alias(names[0]),
        F.round(names[1], 2).cast("double").alias(names[1]),
        F.round(gap, 2).cast("double").alias("diferencia_absoluta"),
    )


def margin_identity(cube: DataFrame) -> DataFrame:
    margin, net, cost = (F.col(c) for c in ("margen_bruto", "ventas_netas", "costo_ventas"))
    return cube.agg(
        F.count_if(margin < 0).alias("filas_margen_negativo"),
        F.count_if(F.abs(margin - (net - cost)) > 0.01).alias("filas_margen_inconsistente"),
        total(net).alias("total_ventas_netas"),
        total(cost).alias("total_costo_ventas"),
        total(margin).alias("total_margen_bruto"),
        percent(F.sum(margin), F.sum(net), 2).alias("margen_pct_global"),
    )


def channel_totals(cube: DataFrame) -> DataFrame:
    """Sales and targets summed over cube rows: a target counts once per row here."""
    return cube.groupBy("nombre_canal", "tipo_canal").agg(
        total("ventas_netas").alias("ventas_netas"),
        total("meta_ventas_netas").alias("meta_ventas_netas"),
        percent(F.sum("ventas_netas"), F.sum("meta_ventas_netas"), 1).alias("cumplimiento_pct"),
    ).orderBy(F.desc("ventas_netas"))


def channel_tickets(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("nombre_canal", "tipo_canal").agg(
        F.sum("num_facturas").alias("total_facturas"),
        F.count_distinct("nombre_canal").alias("canales"),
        rounded(ratio(F.sum("ventas_netas"), F.sum("num_facturas")), 2).alias("ticket_promedio"),
        F.sum("num_clientes_activos").alias("clientes_activos"),
    ).orderBy(F.desc("total_facturas"))


def _cell_mean(c: str, digits: int) -> Column:
    # cell values carry few decimals, so their exact sum fits a decimal
    return rounded(mean(F.col(c).cast("decimal(28,4)")), digits)


def rate_range(cube: DataFrame) -> DataFrame:
    rate = F.col("tasa_quiebre_pct")
    return cube.agg(
        F.count_if((rate < 0) | (rate > 100)).alias("filas_fuera_de_rango"),
        rounded(F.min(rate), 2).alias("quiebre_minimo"),
        rounded(F.max(rate), 2).alias("quiebre_maximo"),
        _cell_mean("tasa_quiebre_pct", 2).alias("quiebre_promedio"),
        _cell_mean("dias_cobertura", 1).alias("cobertura_promedio_dias"),
    )


def warehouse_means(cube: DataFrame) -> DataFrame:
    return cube.groupBy("nombre_almacen", "macroregion").agg(
        _cell_mean("tasa_quiebre_pct", 2).alias("quiebre_pct_promedio"),
        F.max("meta_quiebre_pct").cast("double").alias("meta_quiebre_pct"),
        _cell_mean("dias_cobertura", 1).alias("dias_cobertura_promedio"),
        F.max("meta_dias_cobertura").cast("double").alias("meta_dias_cobertura"),
    ).orderBy(F.desc("quiebre_pct_promedio"), "nombre_almacen")


def operational_targets_present(cube: DataFrame) -> DataFrame:
    fill, otif = F.col("meta_fill_rate_pct"), F.col("meta_otif_pct")
    return cube.agg(
        F.count_if(fill.isNull()).alias("sin_meta_fill_rate"),
        F.count_if(otif.isNull()).alias("sin_meta_otif"),
        F.min(fill).cast("double").alias("fill_rate_meta_min"),
        F.max(fill).cast("double").alias("fill_rate_meta_max"),
        F.min(otif).cast("double").alias("otif_meta_min"),
        F.max(otif).cast("double").alias("otif_meta_max"),
    )
