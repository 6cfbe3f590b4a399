"""Cubes, roll-ups and slices."""

from retaloom import layers
from retaloom.functions.numbers import total
from retaloom.operators.joins import keep_selected, picker_values
from retaloom.operators.star import roll_up
from retaloom.plans import cubes, kpis
from retaloom.queries.registry import query
from retaloom.queries.sqlbase import b, d, pct

_COM_MONEY = (
    "ventas_netas", "venta_bruta", "costo_ventas", "margen_bruto", "inversion_promo",
    "monto_devuelto", "meta_ventas_netas", "meta_margen_bruto", "meta_margen_pct",
    "meta_ticket_promedio", "meta_frecuencia_compra", "meta_roi_pct", "meta_tasa_devolucion",
)
COMMERCIAL_TYPES = ", ".join([f"{d(c)} AS {c}" for c in _COM_MONEY]
                 + [f"{b(c)} AS {c}" for c in ("cantidad_vendida", "unidades_devueltas")])
INVENTORY_TYPES = ", ".join(f"{d(c)} AS {c}" for c in cubes.OPERATIONAL_TARGETS)


@query("cube_commercial", f"SELECT * REPLACE ({COMMERCIAL_TYPES}) FROM cubo_comercial")
def commercial(m):
    return m.commercial


@query("cube_commercial_without_target", f"SELECT * REPLACE ({COMMERCIAL_TYPES}) FROM cubo_comercial_left")
def commercial_left(m):
    return cubes.commercial(m, how="left")


@query("cube_invoices",
       "SELECT * REPLACE (CAST(ventas_netas AS DOUBLE) AS ventas_netas) FROM cubo_facturas")
def invoices(m):
    return m.invoices


@query("cube_invoices_dedup",
       "SELECT * REPLACE (CAST(ventas_netas AS DOUBLE) AS ventas_netas) FROM cubo_facturas_dedup")
def invoices_dedup(m):
    return cubes.invoices_deduplicated(m)


@query("cube_inventory", f"SELECT * REPLACE ({INVENTORY_TYPES}) FROM cubo_inventario")
def inventory(m):
    return m.inventory


@query("cube_inventory_additive", f"""
SELECT * REPLACE ({INVENTORY_TYPES}, {d('demanda_diaria_total')} AS demanda_diaria_total)
FROM cubo_inventario_aditivo""")
def inventory_additive(m):
    return cubes.inventory_additive(m)


@query("views_of_cubes", f"""
SELECT 'facturas' AS vista, nombre_canal AS nombre, {d('SUM(ventas_netas)')} AS total FROM cubo_facturas GROUP BY ALL
UNION ALL
SELECT 'comercial', marca, {d('SUM(margen_bruto)')} FROM cubo_comercial GROUP BY ALL
UNION ALL
SELECT 'inventario', nombre_almacen, {d('SUM(stock_disponible)')} FROM cubo_inventario GROUP BY ALL""")
def views(m):
    """The three cubes asked by name in SQL."""
    layers.views_over(m)
    return m.spark.sql("""
        SELECT 'facturas' AS vista, nombre_canal AS nombre, CAST(SUM(ventas_netas) AS DOUBLE) AS total
        FROM CUBO_FACTURAS GROUP BY ALL
        UNION ALL
        SELECT 'comercial', marca, CAST(SUM(margen_bruto) AS DOUBLE) FROM CUBO_COMERCIAL GROUP BY ALL
        UNION ALL
        SELECT 'inventario', nombre_almacen, CAST(SUM(stock_disponible) AS DOUBLE) FROM CUBO_INVENTARIO GROUP BY ALL""")


def _rollup_sql(levels, relation="cubo_comercial", column="ventas_netas"):
    names = ", ".join(levels)
    return (f"SELECT {names}, {d(f'SUM({column})')} AS {column}, "
            f"CAST(GROUPING({names}) AS BIGINT) AS nivel FROM {relation} GROUP BY ROLLUP ({names})")


_TIME_LEVELS = ["anio", "semestre", "trimestre", "anio_mes", "semana_label", "fecha"]
_PRODUCT_LEVELS = ["linea_negocio", "categoria", "subcategoria", "marca", "cod_sku"]
_PLACE_LEVELS = ["macroregion", "Departamento", "provincia", "ciudad"]
_STORE_LEVELS = ["macroregion", "region", "ciudad", "nombre_almacen"]
_CHANNEL_LEVELS = ["tipo_canal", "nombre_canal"]


@query("rollup_time", _rollup_sql(_TIME_LEVELS))
def rollup_time(m):
    return roll_up(cubes.commercial(m, levels=_TIME_LEVELS), _TIME_LEVELS, ["ventas_netas"])


@query("rollup_product", _rollup_sql(_PRODUCT_LEVELS))
def rollup_product(m):
    return roll_up(cubes.commercial(m, levels=_PRODUCT_LEVELS), _PRODUCT_LEVELS, ["ventas_netas"])


@query("rollup_geography", _rollup_sql(_PLACE_LEVELS))
def rollup_geography(m):
    return roll_up(cubes.commercial(m, levels=_PLACE_LEVELS), _PLACE_LEVELS, ["ventas_netas"])


@query("rollup_channel", _rollup_sql(_CHANNEL_LEVELS))
def rollup_channel(m):
    return roll_up(cubes.commercial(m, levels=_CHANNEL_LEVELS), _CHANNEL_LEVELS, ["ventas_netas"])


@query("rollup_warehouse", _rollup_sql(_STORE_LEVELS, "cubo_inventario", "stock_disponible"))
def rollup_warehouse(m):
    return roll_up(m.inventory, _STORE_LEVELS, ["stock_disponible"])


@query("drilldown_month_category", f"""
SELECT anio_mes, categoria, {d('SUM(ventas_netas)')} AS ventas_netas
FROM cubo_comercial WHERE categoria = 'PROMO' GROUP BY ALL""")
def drill(m):
    return kpis.drill_month(cubes.commercial(m, levels=["anio_mes", "categoria"]), "PROMO")


_SLICE = {"tipo_canal": ["moderno", "digital"], "macroregion": ["ASIA", "EUROPE"], "marca": []}


@query("slice_dice", f"""
SELECT trimestre, linea_negocio, Departamento, {d('SUM(ventas_netas)')} AS ventas_netas,
       {d('SUM(margen_bruto)')} AS margen_bruto
FROM cubo_comercial
WHERE tipo_canal IN ('moderno', 'digital') AND macroregion IN ('ASIA', 'EUROPE') GROUP BY ALL""")
def slice_dice(m):
    names = ["trimestre", "linea_negocio", "Departamento"]
    return keep_selected(cubes.commercial(m, levels=[*names, *_SLICE]), _SLICE).groupBy(*names).agg(total("ventas_netas").alias("ventas_netas"), total("margen_bruto").alias("margen_bruto"))


@query("filter_picker_values",
       "SELECT DISTINCT Departamento FROM cubo_comercial WHERE Departamento IS NOT NULL")
def picker(m):
    return picker_values(cubes.commercial(m, levels=["Departamento"]), "Departamento")


@query("margin_by_channel_year", f"""
SELECT nombre_canal, {d('SUM(ventas_netas)')} AS ventas_netas_total,
       {d('SUM(margen_bruto)')} AS margen_bruto_total,
       {pct('SUM(margen_bruto)', 'SUM(ventas_netas)')} AS margen_pct
FROM cubo_comercial WHERE anio = 2000 GROUP BY nombre_canal""")
def margin(m):
    year = m.between("2000-01-01", "2000-12-31")
    return kpis.margin_by_channel(cubes.commercial(year, levels=["anio", "nombre_canal"]), 2000)


@query("sales_by_channel_and_quarter", f"""
SELECT anio, trimestre, {d('SUM(ventas_netas)')} AS ventas_netas,
       {d('SUM(margen_bruto)')} AS margen_bruto, {d('SUM(inversion_promo)')} AS inversion_promo
FROM cubo_comercial GROUP BY ALL""")
def by_quarter(m):
    return cubes.commercial(m, levels=["anio", "trimestre"]).groupBy("anio", "trimestre").agg(
        *[total(c).alias(c) for c in ("ventas_netas", "margen_bruto", "inversion_promo")]
    ).orderBy("anio", "trimestre")


