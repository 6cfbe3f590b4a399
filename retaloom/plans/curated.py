"""Dimensions and facts, trusted layer to curated layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.functions.dates import date_key
from retaloom.functions.text import trailing_number
from retaloom.operators.numbering import number_rows

DIM_COLUMNS = {
    "canal": ["id_canal", "cod_canal", "nombre_canal", "tipo_canal", "margen_objetivo_pct"],
    "geografia": [
        "id_geografia", "pais", "macroregion", "Departamento", "provincia", "ciudad",
        "distrito", "tipo_zona", "codigo_ubigeo",
    ],
    "almacen": [
        "id_almacen", "cod_almacen", "nombre_almacen", "tipo_almacen", "macroregion", "region",
        "provincia", "ciudad", "distrito", "tipo_zona", "estado",
    ],
    "vendedor": [
        "id_vendedor", "cod_vendedor", "nombre_completo", "cargo", "zona_asignada",
        "fecha_ingreso", "estado",
    ],
}


def dim_projection(table: str, trusted: DataFrame) -> DataFrame:
    return trusted.select(*DIM_COLUMNS[table])


def dim_cliente(clientes: DataFrame, ventas: DataFrame) -> DataFrame:
    """Customers with the date of their first purchase.

    Sales are reduced to one row per customer before the join, so a customer with
    a third of all sales costs no more than any other.
    """
    customers = clientes.select(
        trailing_number(F.col("id_cliente_raw")).alias("id_cliente"),
        F.col("id_cliente_raw").alias("cod_cliente"),
        "razon_social",
        "ruc",
        F.col("tipo_persona").alias("tipo_cliente"),
        F.col("segmento_comercial").alias("segmento"),
        F.col("limite_credito_soles").alias("credito_limite_soles"),
        "dias_credito",
    ).distinct()
    first = ventas.groupBy("id_cliente").agg(F.min("fecha_emision").alias("fecha_primer_compra"))
    return customers.join(first, "id_cliente", "left")


def dim_producto(productos: DataFrame) -> DataFrame:
    return productos.select(
        trailing_number(F.col("id_producto_raw")).alias("id_producto"),
        "cod_sku", "nombre_sku", "marca", "categoria", "subcategoria", "linea_negocio",
        "unidad_medida", "contenido_neto", "precio_lista_soles", "costo_estandar_soles",
        F.col("estado_producto").alias("estado"),
    )


FACT_SALES_COLUMNS = [
    "num_factura", "id_fecha", "id_cliente", "id_producto", "id_canal", "id_geografia",
    "id_vendedor", "id_almacen", "cantidad_vendida", "precio_unitario_soles",
    "monto_bruto_soles", "descuento_pct", "ventas_netas_soles", "costo_ventas_soles",
    "unidades_devueltas", "monto_devuelto_soles", "inversion_promocional_soles",
]


def fact_ventas(ventas: DataFrame, devoluciones: DataFrame, once: bool = False) -> DataFrame:
    """Sale lines with the returned units and amount of their (invoice, product).

    Returns are summed per key before the join, so a line matches at most one row.
    By default every line of a key shows the whole returned amount; ``once``
    puts it on the first line only, which keeps the returned units additive. The
    surrogate key is added by ``numbered_sales``: cubes and checks do not need
    it and should not pay for it.
    """
    returned = devoluciones.groupBy(
        F.col("num_factura_origen").alias("num_factura"), "id_producto"
    ).agg(
        F.sum("cantidad_devuelta").alias("_ud"),
        F.sum("monto_devolucion_soles").alias("_md"),
    )
    lines = ventas
    if once:
        # the line a return is booked on: lowest date, then lowest line id
        firsts = ventas.groupBy("num_factura", "id_producto").agg(
            F.min(F.struct("fecha_emision", "id_linea_venta", "_tag")).alias("_first"))
        returned = returned.join(firsts, ["num_factura", "id_producto"])
    joined = lines.join(returned, ["num_factura", "id_producto"], "left")
    here = F.lit(True)
    if once:
        here = F.col("_first") == F.struct("fecha_emision", "id_linea_venta", "_tag")
    extra = [c for c in ("fecha_emision", "id_linea_venta", "_tag") if c in ventas.columns]
    return (
        joined.withColumn("id_fecha", date_key(F.col("fecha_emision")))
        .withColumn("unidades_devueltas", F.coalesce(F.when(here, F.col("_ud")), F.lit(0)))
        .withColumn(
            "monto_devuelto_soles",
            F.coalesce(F.when(here, F.col("_md")), F.lit(0).cast("decimal(28,2)")),
        )
        .select(*FACT_SALES_COLUMNS, *extra)
    )


def numbered_sales(fact: DataFrame) -> DataFrame:
    """Surrogate key by issue date and line id; remaining columns make the order total."""
    rest = [c for c in FACT_SALES_COLUMNS if c != "id_fecha"]
    tie = "_tag" if "_tag" in fact.columns else None
    numbered = number_rows(fact, ["fecha_emision", "id_linea_venta", *rest], "id_venta", tie)
    return numbered.select("id_venta", *FACT_SALES_COLUMNS)


def fact_inventario(inventario: DataFrame) -> DataFrame:
    return inventario.select(
        date_key(F.col("fecha_snapshot")).alias("id_fecha"),
        "id_producto", "id_almacen", "stock_disponible", "stock_reservado", "demanda_diaria_prom",
        F.col("flag_quiebre_stock").alias("flag_quiebre"),
        F.col("dias_cobertura_calc").alias("dias_cobertura"),
    )


def numbered_inventory(fact: DataFrame) -> DataFrame:
    order = ["id_fecha", "id_producto", "id_almacen"]
    rest = [c for c in fact.columns if c not in order]
    return number_rows(fact, [*order, *rest], "id_inventario").select(
        "id_inventario", *fact.columns)


def _month_start_key() -> Column:
    return date_key(F.make_date(F.col("anio"), F.col("mes"), F.lit(1))).alias("id_fecha")


TARGET_COLUMNS = [
    "meta_ventas_netas_soles", "meta_margen_bruto_soles", "meta_margen_bruto_pct",
    "meta_cantidad_vendida", "meta_ticket_promedio_soles", "meta_frecuencia_compra",
    "meta_roi_promocional_pct", "meta_tasa_devolucion_pct",
]
OPERATIONAL_TARGETS = [
    "meta_quiebre_pct", "meta_dias_cobertura", "meta_otif_pct", "meta_fill_rate_pct",
]


def fact_metas_comercial(metas: DataFrame) -> DataFrame:
    return metas.select(
        trailing_number(F.col("id_meta_raw")).alias("id_meta"),
        "periodo", _month_start_key(), "id_canal", *TARGET_COLUMNS,
    )


def fact_metas_operativo(metas_operativas: DataFrame) -> DataFrame:
    """One row per warehouse and month: bounded by the masters, a plain window will do.

    The window is computed per period after counting the rows of earlier periods,
    so no task sees more than one period.
    """
    rows = metas_operativas.select(
        "periodo", _month_start_key(), "id_almacen", *OPERATIONAL_TARGETS)
    sizes = rows.groupBy("periodo").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("periodo").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("periodo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    inside = Window.partitionBy("periodo").orderBy("id_almacen", *OPERATIONAL_TARGETS)
    return rows.join(starts, "periodo").select(
        (F.col("_s") + F.row_number().over(inside)).cast("bigint").alias("id_meta_op"),
        "periodo", "id_fecha", "id_almacen", *OPERATIONAL_TARGETS,
    )
