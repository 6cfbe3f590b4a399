"""Dimensions, facts and surrogate keys."""

from pyspark.sql import functions as F

from retaloom.plans import calendar, curated
from retaloom.queries.registry import query
from retaloom.queries.sqlbase import d

_ORDER = ", ".join(["fecha_emision", "id_linea_venta"]
                   + [c for c in curated.FACT_SALES_COLUMNS if c != "id_fecha"])
_SALES_MONEY = (
    "precio_unitario_soles", "monto_bruto_soles", "descuento_pct", "ventas_netas_soles",
    "costo_ventas_soles", "monto_devuelto_soles", "inversion_promocional_soles",
)
_SALES = ", ".join(
    f"{d(c)} AS {c}" if c in _SALES_MONEY else c for c in curated.FACT_SALES_COLUMNS)


@query("dim_calendar", """
SELECT * REPLACE (CAST(es_fin_semana AS BIGINT) AS es_fin_semana,
                  CAST(es_feriado AS BIGINT) AS es_feriado,
                  CAST(es_dia_habil AS BIGINT) AS es_dia_habil)
FROM dim_tiempo
WHERE anio BETWEEN (SELECT year(MIN(dia)) FROM lines) AND (SELECT year(MAX(dia)) FROM lines)""")
def dim_calendar(m):
    days = calendar.days_covering(m.raw("fill_rate"), "fecha_despacho")
    return calendar.calendar(days)


@query("dim_customer_first_purchase", """
SELECT * REPLACE (CAST(credito_limite_soles AS DOUBLE) AS credito_limite_soles)
FROM dim_cliente""")
def dim_customer(m):
    return m.dim("cliente")


@query("dim_product_derived_key", """
SELECT * REPLACE (CAST(precio_lista_soles AS DOUBLE) AS precio_lista_soles,
                  CAST(costo_estandar_soles AS DOUBLE) AS costo_estandar_soles)
FROM dim_producto""")
def dim_product(m):
    return m.dim("producto")


@query("dim_channel", """
SELECT * REPLACE (CAST(margen_objetivo_pct AS DOUBLE) AS margen_objetivo_pct) FROM dim_canal""")
def dim_channel(m):
    return m.dim("canal")


@query("dim_geography", "SELECT * FROM dim_geografia")
def dim_geography(m):
    return m.dim("geografia")


@query("dim_warehouse", "SELECT * FROM dim_almacen")
def dim_warehouse(m):
    return m.dim("almacen")


@query("dim_seller", "SELECT * FROM dim_vendedor")
def dim_seller(m):
    return m.dim("vendedor")


@query("fact_sales_returns", f"SELECT {_SALES} FROM fact_ventas")
def fact_sales(m):
    return m.fact("ventas").select(*curated.FACT_SALES_COLUMNS)


@query("fact_sales_returns_once", f"""
SELECT num_factura, id_producto, fecha_emision, id_linea_venta, cantidad_vendida,
       {d('ventas_netas_soles')} AS ventas_netas_soles,
       CASE WHEN n = 1 THEN unidades_devueltas ELSE 0 END AS unidades_devueltas,
       CAST(CASE WHEN n = 1 THEN monto_devuelto_soles ELSE 0 END AS DOUBLE) AS monto_devuelto_soles
FROM (SELECT *, row_number() OVER (PARTITION BY num_factura, id_producto
                                   ORDER BY fecha_emision, id_linea_venta) AS n
      FROM fact_ventas) AS x""")
def fact_sales_once(m):
    return m.tagged_sales(once=True).select(
        "num_factura", "id_producto", "fecha_emision", "id_linea_venta", "cantidad_vendida",
        "ventas_netas_soles", "unidades_devueltas", "monto_devuelto_soles")


@query("surrogate_key_numbering",
       f"SELECT row_number() OVER (ORDER BY {_ORDER}) AS id_venta, {_SALES} FROM fact_ventas")
def surrogate_keys(m):
    return curated.numbered_sales(m.tagged_sales())


@query("fact_inventory_snapshot", f"""
SELECT row_number() OVER (ORDER BY id_fecha, id_producto, id_almacen) AS id_inventario, id_fecha,
       id_producto, id_almacen, stock_disponible, stock_reservado,
       {d('demanda_diaria_prom')} AS demanda_diaria_prom,
       CAST(flag_quiebre AS BIGINT) AS flag_quiebre, {d('dias_cobertura')} AS dias_cobertura
FROM fact_inventario""")
def fact_inventory(m):
    return curated.numbered_inventory(m.fact("inventario"))


@query("fact_targets", "SELECT id_meta, periodo, id_fecha, id_canal, "
       + ", ".join(f"{d(c)} AS {c}" if c != "meta_cantidad_vendida" else c
                   for c in curated.TARGET_COLUMNS)
       + " FROM fact_metas_comercial")
def fact_targets(m):
    return m.fact("metas_comercial")


@query("fact_operational_targets", "SELECT id_meta_op, periodo, id_fecha, id_almacen, "
       + ", ".join(f"{d(c)} AS {c}" for c in curated.OPERATIONAL_TARGETS)
       + " FROM fact_metas_operativo")
def fact_operational(m):
    return m.fact("metas_operativo")


@query("rename_and_filter_dates", """
SELECT id_linea_venta, id_fecha, CAST(id_fecha // 100 AS BIGINT) AS periodo,
       fecha_emision >= DATE '2000-01-01' AS es_holdout
FROM fact_ventas WHERE fecha_emision >= DATE '1999-01-01' AND fecha_emision < DATE '2001-01-01'""")
def date_filter(m):
    day = F.col("fecha_emision")
    chosen = m.fact("ventas").where(
        (day >= F.lit("1999-01-01").cast("date")) & (day < F.lit("2001-01-01").cast("date")))
    return chosen.select(
        "id_linea_venta", "id_fecha", F.expr("id_fecha div 100").alias("periodo"),
        (day >= F.lit("2000-01-01").cast("date")).alias("es_holdout"))
