"""Dashboard KPIs over the cubes."""

from pyspark.sql import functions as F

from retaloom.plans import cubes, distinct, kpis
from retaloom.queries.registry import query
from retaloom.queries.sqlbase import b, d, pct, r, ratio
from retaloom.session import as_table


def _levels(m, *names):
    """The commercial cube at the levels a KPI asks for."""
    return cubes.commercial(m, levels=names)


_TOTALS = f"""
SELECT {d('SUM(ventas_netas)')} AS ventas_netas, {d('SUM(margen_bruto)')} AS margen_bruto,
       {d('SUM(inversion_promo)')} AS inversion_promo,
       {b('SUM(cantidad_vendida)')} AS cantidad_vendida,
       {b('SUM(unidades_devueltas)')} AS unidades_devueltas,
       COALESCE({pct('SUM(margen_bruto)', 'SUM(ventas_netas)', 4)}, 0) AS margen_pct,
       COALESCE({pct('SUM(unidades_devueltas)', 'SUM(cantidad_vendida)', 4)}, 0) AS tasa_devolucion,
       COALESCE({pct('SUM(margen_bruto) - SUM(inversion_promo)', 'SUM(inversion_promo)', 4)}, 0)
         AS roi_pct
FROM cubo_comercial"""


@query("kpi_commercial_totals", _TOTALS)
def totals(m):
    return kpis.commercial_totals(_levels(m))


@query("kpi_commercial_totals_selected", _TOTALS
       + " WHERE tipo_canal IN ('moderno') AND marca IN ('Brand#1', 'Brand#2')")
def totals_selected(m):
    return kpis.commercial_totals(
        _levels(m, "tipo_canal", "marca"),
        {"tipo_canal": ["moderno"], "marca": ["Brand#1", "Brand#2"], "anio_mes": []})


_TICKET = f"""
SELECT ventas_netas, num_facturas,
       COALESCE({r(ratio('ventas_netas', 'num_facturas'), 4)}, 0) AS ticket_promedio
FROM (SELECT {d('(SELECT SUM(ventas_netas) FROM cubo_comercial)')} AS ventas_netas,
             {b('(SELECT SUM(num_facturas) FROM cubo_facturas)')} AS num_facturas) AS x"""


@query("kpi_ticket", _TICKET)
def ticket(m):
    return kpis.average_ticket(_levels(m), m.invoices)


@query("kpi_ticket_exact", f"""
SELECT {d('SUM(ventas_netas_soles)')} AS ventas_netas, COUNT(DISTINCT num_factura) AS num_facturas,
       COUNT(DISTINCT id_cliente) AS num_clientes,
       {r(ratio('SUM(ventas_netas_soles)', 'COUNT(DISTINCT num_factura)'), 4)} AS ticket_promedio
FROM fact_ventas""")
def ticket_exact(m):
    return kpis.exact_ticket(m.fact("ventas"))


_SETS = [[], ["anio_mes"], ["tipo_canal", "nombre_canal"], ["Departamento"],
         ["anio_mes", "tipo_canal", "nombre_canal"], distinct.LEVELS]
_AT_LEVELS = f"""
FROM fact_ventas JOIN dim_tiempo USING (id_fecha) JOIN dim_canal USING (id_canal)
JOIN dim_geografia USING (id_geografia) JOIN dim_vendedor USING (id_vendedor)
GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(s) + ')' for s in _SETS)})"""
_AT = f"{', '.join(distinct.LEVELS)}, CAST(GROUPING({', '.join(distinct.LEVELS)}) AS BIGINT) AS nivel"


def _bitmaps(m, kind):
    """Bitmap cells, stored as a cube would be: what is asked of them reads no fact."""
    column, near = kind
    found = distinct.bitmaps(m, column, distinct.numbers(m.fact("ventas"), column, near))
    return as_table(found, f"bitmaps-{column}")


@query("kpi_ticket_levels", f"""
SELECT {_AT}, {d('SUM(ventas_netas_soles)')} AS ventas_netas, COUNT(DISTINCT num_factura) AS num_facturas,
       {r(ratio('SUM(ventas_netas_soles)', 'COUNT(DISTINCT num_factura)'), 4)} AS ticket_promedio
{_AT_LEVELS}""")
def ticket_levels(m):
    """Exact tickets at six levels from one cube of bitmaps."""
    net = as_table(cubes.invoices_net(m, distinct.LEVELS), "net")
    return distinct.ticket_at(net, _bitmaps(m, distinct.INVOICE), _SETS)


@query("kpi_purchase_frequency_levels", f"""
SELECT {_AT}, COUNT(DISTINCT num_factura) AS facturas, COUNT(DISTINCT id_cliente) AS clientes,
       {r(ratio('COUNT(DISTINCT num_factura)', 'COUNT(DISTINCT id_cliente)'), 6)} AS frecuencia_compra
{_AT_LEVELS}""")
def frequency_levels(m):
    return distinct.frequency_at(_bitmaps(m, distinct.INVOICE), _bitmaps(m, distinct.CUSTOMER), _SETS)


_FREQUENCY = f"""
SELECT COUNT(DISTINCT num_factura) AS facturas, COUNT(DISTINCT id_cliente) AS clientes,
       {r(ratio('COUNT(DISTINCT num_factura)', 'COUNT(DISTINCT id_cliente)'), 6)}
         AS frecuencia_compra
FROM fact_ventas"""


@query("kpi_purchase_frequency", _FREQUENCY)
def frequency(m):
    return kpis.purchase_frequency(m.fact("ventas"), m.dim("tiempo"), m.dim("canal"))


@query("kpi_purchase_frequency_selected", _FREQUENCY + """
WHERE id_fecha IN (SELECT id_fecha FROM dim_tiempo WHERE anio_mes IN ('2000-03', '2000-04'))
  AND id_canal IN (SELECT id_canal FROM dim_canal WHERE nombre_canal IN ('HIGH', 'LOW'))""")
def frequency_selected(m):
    return kpis.purchase_frequency(
        m.fact("ventas"), m.dim("tiempo"), m.dim("canal"), ["2000-03", "2000-04"], ["HIGH", "LOW"])


def _mean(c):
    return r(f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})", 4)


_TARGETS = f"""
SELECT {d('SUM(meta_ventas_netas)')} AS meta_ventas_netas,
       {d('SUM(meta_margen_bruto)')} AS meta_margen_bruto,
       {d('SUM(meta_cantidad_vendida)')} AS meta_cantidad_vendida,
       {', '.join(f'{_mean(c)} AS {c}' for c in kpis.TARGET_MEANS)}
FROM (SELECT nombre_canal, periodo,
             {', '.join(f'MAX({c}) AS {c}' for c in kpis.TARGET_SUMS + kpis.TARGET_MEANS)}
      FROM cubo_comercial GROUP BY 1, 2) AS t"""


@query("kpi_target_rollup", _TARGETS)
def target_rollup(m):
    return kpis.target_rollup(_levels(m, "nombre_canal", "periodo"))


def _status_row(kpi, value, target, lower):
    op = "<=" if lower else ">="
    met = f"CASE WHEN {target} IS NOT NULL AND {target} <> 0 THEN {value} {op} {target} END"
    return f"SELECT '{kpi}' AS kpi, {d(value)} AS valor, {d(target)} AS meta, {met} AS cumple FROM v"


_VALUES = {"ticket_promedio": "k.ticket_promedio", "frecuencia_compra": "f.frecuencia_compra"}


@query("kpi_target_status", f"""
SELECT * FROM (
  WITH v AS (SELECT t.*, k.ticket_promedio, f.frecuencia_compra, g.*
             FROM ({_TOTALS}) t CROSS JOIN ({_TICKET}) k CROSS JOIN ({_FREQUENCY}) f
             CROSS JOIN ({_TARGETS}) g)
  {' UNION ALL '.join(_status_row(*row) for row in kpis.COMMERCIAL_KPIS)}) AS s""")
def target_status(m):
    cube = as_table(_levels(m, "nombre_canal", "periodo"), "cube")  # three measures read it
    values = [
        kpis.commercial_totals(cube),
        kpis.average_ticket(cube, m.invoices).select("ticket_promedio"),
        kpis.purchase_frequency(m.fact("ventas"), m.dim("tiempo"), m.dim("canal"))
        .select("frecuencia_compra"),
    ]
    return kpis.target_status(values, kpis.target_rollup(cube))


@query("kpi_attainment", f"""
SELECT nombre_canal, {d('SUM(v)')} AS ventas_reales, {d('SUM(g)')} AS meta_ventas,
       {pct('SUM(v)', 'SUM(g)', 1)} AS cumplimiento_pct
FROM (SELECT nombre_canal, periodo, SUM(ventas_netas) AS v, MAX(meta_ventas_netas) AS g
      FROM cubo_comercial GROUP BY 1, 2) AS t GROUP BY nombre_canal""")
def attainment(m):
    return kpis.attainment(_levels(m, "nombre_canal", "periodo"))


@query("kpi_channel_month", f"""
SELECT anio_mes, nombre_canal, {d('SUM(ventas_netas)')} AS ventas_netas
FROM cubo_comercial GROUP BY ALL""")
def channel_month(m):
    return kpis.by(_levels(m, "anio_mes", "nombre_canal"), ["anio_mes", "nombre_canal"])


@query("kpi_region_coords", f"""
SELECT Departamento, ventas_netas, {d('lat')} AS lat, {d('lon')} AS lon
FROM (SELECT Departamento, {d('SUM(ventas_netas)')} AS ventas_netas
      FROM cubo_comercial GROUP BY 1) AS x JOIN coords ON Departamento = dep""")
def region_coords(m):
    return kpis.region_map(_levels(m, "Departamento"))


@query("kpi_product_ranking", f"""
SELECT marca, nombre_sku, {d('SUM(ventas_netas)')} AS ventas_netas,
       {b('SUM(cantidad_vendida)')} AS cantidad_vendida,
       {pct('SUM(margen_bruto)', 'SUM(ventas_netas)', 1)} AS margen_pct
FROM cubo_comercial GROUP BY 1, 2""")
def product_ranking(m):
    return kpis.product_ranking(_levels(m, "marca", "nombre_sku"))


@query("kpi_product_top", f"""
SELECT marca, nombre_sku, {d('SUM(ventas_netas)')} AS ventas_netas,
       {b('SUM(cantidad_vendida)')} AS cantidad_vendida,
       {pct('SUM(margen_bruto)', 'SUM(ventas_netas)', 1)} AS margen_pct
FROM cubo_comercial GROUP BY 1, 2 ORDER BY SUM(ventas_netas) DESC, marca, nombre_sku LIMIT 20""")
def product_top(m):
    return kpis.product_ranking(_levels(m, "marca", "nombre_sku"), top=20)


@query("kpi_line_share", f"""
SELECT linea_negocio, {d('v')} AS ventas_netas, {pct('v', 'SUM(v) OVER ()')} AS participacion_pct
FROM (SELECT linea_negocio, SUM(ventas_netas) AS v FROM cubo_comercial GROUP BY 1) AS x""")
def line_share(m):
    return kpis.line_share(_levels(m, "linea_negocio"))


@query("kpi_month_by_year", f"""
SELECT anio, mes, mes_nombre, {d('SUM(ventas_netas)')} AS ventas_netas
FROM cubo_comercial GROUP BY ALL""")
def month_by_year(m):
    names = ["anio", "mes", "mes_nombre"]
    return kpis.by(_levels(m, *names), names).orderBy("mes", "anio")


@query("kpi_ticket_channel_month", f"""
SELECT anio_mes, nombre_canal, {d('SUM(ventas_netas)')} AS ventas_netas,
       {b('SUM(num_facturas)')} AS facturas,
       {r(ratio('SUM(ventas_netas)', 'SUM(num_facturas)'), 2)} AS ticket_promedio
FROM cubo_facturas WHERE anio = 2000 GROUP BY 1, 2""")
def ticket_channel_month(m):
    year = m.between("2000-01-01", "2000-12-31")
    return kpis.ticket_by(year.invoices, ["anio_mes", "nombre_canal"], 2000)


# -- inventory ----------------------------------------------------------------------

_DEMAND = (f"SUM(CAST({ratio('stock_disponible', 'NULLIF(dias_cobertura, 0)')}"
           " AS DECIMAL(28,10)))")
_COVER = r(ratio("SUM(stock_disponible)", _DEMAND), 4)


@query("kpi_stockout_rate", f"""
SELECT {b('SUM(stock_disponible)')} AS stock_total, {b('SUM(skus_en_quiebre)')} AS skus_en_quiebre,
       COALESCE({pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 4)}, 0) AS tasa_quiebre,
       COALESCE({_COVER}, 0) AS dias_cobertura
FROM cubo_inventario""")
def stockout_rate(m):
    return kpis.inventory_totals(m.inventory)


@query("kpi_coverage_exact", f"""
SELECT categoria, {r(ratio('SUM(stock_disponible)', 'SUM(demanda_diaria_total)'), 4)}
         AS dias_cobertura
FROM cubo_inventario_aditivo GROUP BY 1""")
def coverage_exact(m):
    return kpis.exact_coverage(cubes.inventory_additive(m), ["categoria"])


@query("kpi_operational_targets", f"""
SELECT {_mean('q')} AS meta_quiebre, {_mean('c')} AS meta_dias
FROM (SELECT nombre_almacen, periodo, MAX(meta_quiebre_pct) AS q, MAX(meta_dias_cobertura) AS c
      FROM cubo_inventario GROUP BY 1, 2) AS t""")
def operational_targets(m):
    return kpis.operational_targets(m.inventory)


@query("kpi_stockout_by_warehouse", f"""
SELECT nombre_almacen, {b('SUM(skus_en_quiebre)')} AS skus_en_quiebre,
       {b('SUM(total_skus)')} AS total_skus, {_mean('meta_quiebre_pct')} AS meta_quiebre_pct,
       {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 4)} AS tasa
FROM cubo_inventario GROUP BY 1""")
def stockout_by_warehouse(m):
    return kpis.stockout_by(m.inventory, ["nombre_almacen"])


@query("kpi_stock_tree", f"""
SELECT nombre_almacen, categoria, {b('SUM(stock_disponible)')} AS stock_disponible
FROM cubo_inventario GROUP BY 1, 2""")
def stock_tree(m):
    return kpis.stock_tree(m.inventory)


@query("kpi_coverage_by_warehouse", f"""
SELECT nombre_almacen, {b('SUM(stock_disponible)')} AS stock,
       {_mean('meta_dias_cobertura')} AS meta_dias, {_COVER} AS dias
FROM cubo_inventario GROUP BY 1""")
def coverage_by_warehouse(m):
    return kpis.coverage_by(m.inventory, ["nombre_almacen"]).orderBy("dias", "nombre_almacen")


@query("kpi_stockout_month", f"""
SELECT anio, mes, mes_nombre, {b('SUM(skus_en_quiebre)')} AS skus_en_quiebre,
       {b('SUM(total_skus)')} AS total_skus, {_mean('meta_quiebre_pct')} AS meta_quiebre_pct,
       {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 4)} AS tasa,
       mes_nombre || ' ' || anio AS etiqueta
FROM cubo_inventario GROUP BY anio, mes, mes_nombre""")
def stockout_month(m):
    rows = kpis.stockout_by(m.inventory, ["anio", "mes", "mes_nombre"])
    return rows.withColumn("etiqueta", kpis.month_label()).orderBy("anio", "mes")


@query("kpi_coverage_month", f"""
SELECT anio, mes, mes_nombre, {b('SUM(stock_disponible)')} AS stock,
       {_mean('meta_dias_cobertura')} AS meta_dias, {_COVER} AS dias,
       mes_nombre || ' ' || anio AS etiqueta
FROM cubo_inventario GROUP BY anio, mes, mes_nombre""")
def coverage_month(m):
    rows = kpis.coverage_by(m.inventory, ["anio", "mes", "mes_nombre"])
    return rows.withColumn("etiqueta", kpis.month_label()).orderBy("anio", "mes")


_STORES = [f"Almacen NATION_{k}" for k in range(25)]


@query("kpi_stockout_pivot", "SELECT categoria, " + ", ".join(
    f"MAX(CASE WHEN nombre_almacen = '{s}' THEN tasa END) AS \"{s}\"" for s in _STORES) + f"""
FROM (SELECT categoria, nombre_almacen,
             {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 1)} AS tasa
      FROM cubo_inventario GROUP BY 1, 2) AS x GROUP BY categoria""")
def stockout_pivot(m):
    return kpis.stockout_pivot(m.inventory, _STORES)


@query("kpi_stockout_latest_month", f"""
SELECT nombre_almacen, {b('SUM(skus_en_quiebre)')} AS skus_quiebre,
       {b('SUM(total_skus)')} AS total_skus,
       {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)')} AS tasa_quiebre_pct,
       {d('MAX(meta_quiebre_pct)')} AS meta
FROM cubo_inventario WHERE anio_mes = (SELECT MAX(anio_mes) FROM cubo_inventario) GROUP BY 1""")
def stockout_latest_month(m):
    return kpis.stockout_latest_month(m.inventory)


@query("kpi_inventory_vs_target", f"""
SELECT nombre_almacen, {pct('tasa', 'mq')} AS quiebre_vs_meta_pct,
       {pct('dias', 'md')} AS cobertura_vs_meta_pct
FROM (SELECT nombre_almacen, {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 4)} AS tasa,
             {_COVER} AS dias, {_mean('meta_quiebre_pct')} AS mq,
             {_mean('meta_dias_cobertura')} AS md
      FROM cubo_inventario GROUP BY 1) AS x""")
def inventory_vs_target(m):
    return kpis.target_ratios(m.inventory)


@query("kpi_inventory_status", f"""
SELECT nombre_almacen, tasa <= mq AS quiebre_cumple, dias >= md AS cobertura_cumple
FROM (SELECT nombre_almacen, {pct('SUM(skus_en_quiebre)', 'SUM(total_skus)', 4)} AS tasa,
             {_COVER} AS dias, {_mean('meta_quiebre_pct')} AS mq,
             {_mean('meta_dias_cobertura')} AS md
      FROM cubo_inventario GROUP BY 1) AS x""")
def inventory_status(m):
    rates = kpis.stockout_by(m.inventory, ["nombre_almacen"])
    cover = kpis.coverage_by(m.inventory, ["nombre_almacen"])
    return rates.join(cover, "nombre_almacen").select(
        "nombre_almacen",
        kpis.status(F.col("tasa"), F.col("meta_quiebre_pct"), True).alias("quiebre_cumple"),
        kpis.status(F.col("dias"), F.col("meta_dias")).alias("cobertura_cumple"),
    )
