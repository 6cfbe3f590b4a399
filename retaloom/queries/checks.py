"""Data-quality checks and layer reconciliation."""

from pyspark.sql import functions as F

from retaloom.operators import joins
from retaloom.plans import checkrun, cubes, quality, reconcile
from retaloom.plans.trusted import DUPLICATE_SUFFIX, UNSPECIFIED
from retaloom.queries.registry import query
from retaloom.queries.sqlbase import b, d, pct, r, ratio


def n(condition):
    return f"COUNT(*) FILTER (WHERE {condition})"


_V01 = f"""
SELECT 'V01_ventas_conteo_estado' AS validacion, COUNT(*) AS total_filas, {n("estado_linea = 'DUPLICADO'")} AS filas_duplicado,
       {n("estado_linea = 'ACTIVO'")} AS filas_activo,
       {n("estado_linea NOT IN ('ACTIVO', 'DUPLICADO')")} AS filas_estado_invalido,
       {pct(n("estado_linea = 'DUPLICADO'"), 'COUNT(*)')} AS pct_duplicado
FROM raw_ventas"""


@query("dq_state_counts", _V01)
def state_counts(m):
    return quality.checks(m.raw)["V01"]()


@query("dq_suffix_consistency", f"""
SELECT {n("estado_linea = 'DUPLICADO' AND suffix(id_linea_venta, '_DUP')")}
         AS duplicados_con_sufijo_dup,
       {n("estado_linea = 'DUPLICADO' AND NOT suffix(id_linea_venta, '_DUP')")}
         AS duplicados_sin_sufijo_dup,
       {n("estado_linea = 'ACTIVO' AND suffix(id_linea_venta, '_DUP')")} AS activos_con_sufijo_dup
FROM raw_ventas""")
def suffix(m):
    return quality.v02_suffix(m.raw("ventas"))


@query("dq_numeric_ranges", f"""
SELECT {n('cantidad_vendida <= 0')} AS cant_vendida_cero_o_neg,
       {n('precio_unitario_soles <= 0')} AS precio_unitario_cero_o_neg,
       {n('precio_lista_soles <= 0')} AS precio_lista_cero_o_neg,
       {n('ventas_netas_soles < 0')} AS ventas_netas_negativas,
       {n('descuento_pct < 0 OR descuento_pct > 100')} AS descuento_pct_fuera_rango
FROM raw_ventas WHERE estado_linea = 'ACTIVO'""")
def ranges(m):
    return quality.v03_ranges(m.raw("ventas"))


@query("dq_null_rates", f"""
SELECT COUNT(*) AS total_filas, {n('transportista IS NULL')} AS transportista_null,
       {pct(n('transportista IS NULL'), 'COUNT(*)')} AS pct_transportista_null,
       {n('flag_in_full = 0')} AS total_rechazos,
       {n('flag_in_full = 0 AND motivo_rechazo IS NULL')} AS motivo_rechazo_null_en_rechazos,
       {pct(n('flag_in_full = 0 AND motivo_rechazo IS NULL'), n('flag_in_full = 0'))}
         AS pct_motivo_null_sobre_rechazos
FROM raw_fill_rate""")
def null_rates(m):
    return quality.v04_null_rates(m.raw("fill_rate"))


@query("dq_flag_consistency", f"""
SELECT COUNT(*) AS total_filas, {n('flag_otif = 1')} AS otif_positivos,
       {n('flag_on_time = 1 AND flag_in_full = 1')} AS on_time_and_in_full,
       {n('flag_otif = 1 AND NOT (flag_on_time = 1 AND flag_in_full = 1)')} AS otif_inconsistente,
       {pct(n('flag_otif = 1'), 'COUNT(*)')} AS pct_otif
FROM raw_fill_rate""")
def otif(m):
    return quality.v05_otif(m.raw("fill_rate"))


@query("dq_sign_distribution", f"""
SELECT COUNT(*) AS total_filas, {n('stock_disponible < 0')} AS stock_negativo,
       {n('stock_disponible = 0')} AS stock_cero, {n('stock_disponible > 0')} AS stock_positivo,
       {pct(n('stock_disponible < 0'), 'COUNT(*)')} AS pct_stock_negativo
FROM raw_inventario""")
def signs(m):
    return quality.v06_signs(m.raw("inventario"))


@query("dq_flag_vs_sign", f"""
SELECT {n('stock_disponible < 0')} AS stock_negativo_total,
       {n("stock_disponible < 0 AND flag_ajuste_pendiente = 'S'")} AS neg_con_flag_ajuste_s,
       {n("stock_disponible < 0 AND flag_ajuste_pendiente = 'N'")} AS neg_con_flag_ajuste_n,
       {n('stock_disponible < 0 AND flag_ajuste_pendiente IS NULL')} AS neg_con_flag_ajuste_null
FROM raw_inventario""")
def flag_vs_sign(m):
    return quality.v07_adjustment_flag(m.raw("inventario"))


@query("dq_completeness", f"""
SELECT COUNT(*) AS total_clientes, {n('direccion_fiscal IS NULL')} AS direccion_null,
       {pct(n('direccion_fiscal IS NULL'), 'COUNT(*)')} AS pct_direccion_null,
       {n('distrito IS NULL')} AS distrito_null, {n('telefono IS NULL')} AS telefono_null,
       {n('email_contacto IS NULL')} AS email_null
FROM raw_clientes""")
def completeness(m):
    return quality.v08_customer_nulls(m.raw("clientes"))


@query("dq_cohort_nulls", f"""
SELECT CASE WHEN fecha_alta_sistema < DATE '2022-01-01' THEN 'pre_2022'
            ELSE '2022_en_adelante' END AS cohorte,
       COUNT(*) AS total, {n('direccion_fiscal IS NULL')} AS direccion_null,
       {pct(n('direccion_fiscal IS NULL'), 'COUNT(*)')} AS pct_null
FROM raw_clientes GROUP BY 1""")
def cohorts(m):
    return quality.v09_cohorts(m.raw("clientes"))


@query("dq_duplicate_codes", f"""
SELECT COUNT(*) AS total_productos, {n("suffix(cod_sap, '_DUP')")} AS cod_sap_con_dup,
       {n("NOT suffix(cod_sap, '_DUP')")} AS cod_sap_limpio
FROM raw_productos""")
def duplicate_codes(m):
    return quality.v10_duplicate_codes(m.raw("productos"))


@query("dq_duplicate_code_rows", """
SELECT id_producto_raw, cod_sku, cod_sap, nombre_sku, estado_producto
FROM raw_productos WHERE suffix(cod_sap, '_DUP')""")
def duplicate_code_rows(m):
    return quality.v11_duplicate_code_rows(m.raw("productos"))


_ODD = "id_promocion_sap IS NOT NULL AND NOT regexp_full_match(id_promocion_sap, '[0-9]{8,10}')"


@query("dq_id_format", f"""
SELECT COUNT(*) AS total_promociones, {n('id_promocion_sap IS NULL')} AS id_sap_null,
       {pct(n('id_promocion_sap IS NULL'), 'COUNT(*)')} AS pct_id_sap_null,
       {n('id_promocion_sap IS NOT NULL')} AS id_sap_presente,
       {n(_ODD)} AS id_sap_formato_no_estandar,
       {pct(n(_ODD), 'COUNT(*)')} AS pct_formato_no_estandar
FROM raw_promociones""")
def id_format(m):
    return quality.v12_promotion_ids(m.raw("promociones"))


@query("dq_versions", f"""
SELECT COUNT(*) AS total_filas, {n('es_version_aprobada = 1')} AS filas_aprobadas,
       {n('es_version_aprobada = 0')} AS filas_no_aprobadas,
       COUNT(DISTINCT version_meta) AS versiones_distintas
FROM raw_metas""")
def versions(m):
    return quality.v13_versions(m.raw("metas"))


@query("dq_versions_by_version", f"""
SELECT version_meta, COUNT(*) AS filas, {n('es_version_aprobada = 1')} AS aprobadas,
       {n('aprobado_por IS NULL')} AS sin_aprobador,
       {n('fecha_aprobacion IS NULL')} AS sin_fecha_aprobacion
FROM raw_metas GROUP BY 1""")
def by_version(m):
    return quality.v14_by_version(m.raw("metas"))


@query("dq_states_notes", f"""
SELECT estado_devolucion, COUNT(*) AS total_filas, COUNT(*) AS filas_estado,
       {n('num_nota_credito IS NULL')} AS nota_credito_null,
       {n('fecha_aprobacion_dev IS NULL')} AS fecha_aprobacion_null
FROM raw_devoluciones GROUP BY 1""")
def return_states(m):
    return quality.v15_return_states(m.raw("devoluciones"))


@query("dq_orphans", f"""
SELECT COUNT(*) AS total_inversiones, {n('i.id_promocion_tm IS NULL')} AS inv_sin_id_tm,
       {n('i.id_promocion_sap IS NULL')} AS inv_sin_id_sap,
       {n('p.id_promocion_tm IS NULL AND i.id_promocion_tm IS NOT NULL')}
         AS id_tm_sin_match_en_promociones
FROM raw_inversion i LEFT JOIN raw_promociones p ON i.id_promocion_tm = p.id_promocion_tm""")
def orphans(m):
    return quality.v16_orphan_promotions(m.raw("inversion_promocional"), m.raw("promociones"))


_PROBLEMS = (
    ("ventas", "raw_ventas", "estado_linea = 'DUPLICADO'", "estado_linea = DUPLICADO", "x = 3998"),
    ("fill_rate", "raw_fill_rate", "transportista IS NULL", "transportista IS NULL",
     "x / t BETWEEN 0.07 AND 0.09"),
    ("inventario", "raw_inventario", "stock_disponible < 0", "stock_disponible < 0", "x = 1640"),
    ("clientes", "raw_clientes", "direccion_fiscal IS NULL", "direccion_fiscal IS NULL", "x = 27"),
    ("productos", "raw_productos", "suffix(cod_sap, '_DUP')", "cod_sap con sufijo _DUP", "x = 2"),
    ("promociones", "raw_promociones", "id_promocion_sap IS NULL", "id_promocion_sap IS NULL",
     "x / t BETWEEN 0.22 AND 0.25"),
    ("metas", "raw_metas", "es_version_aprobada <> 1", "es_version_aprobada != 1 (borradores)",
     "t - x = 216 AND t = 655"),
)


@query("dq_summary", "\nUNION ALL\n".join(f"""
SELECT '{name}' AS dataset, t AS filas_raw, x AS filas_problema,
       {pct('x', 't')} AS pct_problema, '{text}' AS descripcion_problema,
       CASE WHEN {fine} THEN 'OK_ESPERADO' ELSE 'REVISAR' END AS semaforo
FROM (SELECT COUNT(*) AS t, {n(problem)} AS x FROM {table}) AS {name}_q"""
      for name, table, problem, text, fine in _PROBLEMS))
def summary(m):
    return quality.v17_summary(m.raw)


# Bands that most shares of the stand-in tables fall into, and one that none can.
_BANDS = {"ventas": (0.4, 0.6), "fill_rate": (0.0, 0.5), "inventario": (0.0, 1.0), "clientes": (0.0, 1.0),
          "productos": (0.0, 1.0), "promociones": (1.5, 2.0), "metas": (1, 1)}


@query("dq_summary_bands", "\nUNION ALL\n".join(f"""
SELECT '{name}' AS dataset, t AS filas_raw, x AS filas_problema,
       {pct('x', 't')} AS pct_problema, '{text}' AS descripcion_problema,
       CASE WHEN {'t - x = 1 AND t = 1' if name == 'metas' else f'x / t BETWEEN {_BANDS[name][0]} AND {_BANDS[name][1]}'}
            THEN 'OK_ESPERADO' ELSE 'REVISAR' END AS semaforo
FROM (SELECT COUNT(*) AS t, {n(problem)} AS x FROM {table}) AS {name}_q"""
      for name, table, problem, text, _ in _PROBLEMS))
def summary_bands(m):
    return quality.v17_summary(m.raw, _BANDS)


# Expected values that hold at every scale of the stand-in tables, with one that does not
# (V05), one on a missing field (V10) and one check without expectations (V04).
_SCORED = {
    "V02": {"duplicados_sin_sufijo_dup": 0, "activos_con_sufijo_dup": 0},
    "V03": {"cant_vendida_cero_o_neg": 0, "precio_unitario_cero_o_neg": 0},
    "V05": {"otif_inconsistente": 0},
    "V10": {"no_existe": 1},
    "V13": {"versiones_distintas": 3},
}
_INCONSISTENT = n("flag_otif = 1 AND NOT (flag_on_time = 1 AND flag_in_full = 1)")


@query("dq_score", f"""
SELECT 'V02' AS check_id,
       CASE WHEN {n("estado_linea = 'DUPLICADO' AND NOT suffix(id_linea_venta, '_DUP')")} = 0
             AND {n("estado_linea = 'ACTIVO' AND suffix(id_linea_venta, '_DUP')")} = 0
            THEN 'PASS' ELSE 'FAIL' END AS estado FROM raw_ventas
UNION ALL
SELECT 'V03', CASE WHEN {n('cantidad_vendida <= 0')} = 0 AND {n('precio_unitario_soles <= 0')} = 0
                   THEN 'PASS' ELSE 'FAIL' END FROM raw_ventas WHERE estado_linea = 'ACTIVO'
UNION ALL SELECT 'V04', 'INFO'
UNION ALL SELECT 'V05', CASE WHEN {_INCONSISTENT} = 0 THEN 'PASS' ELSE 'FAIL' END FROM raw_fill_rate
UNION ALL SELECT 'V10', 'WARN'
UNION ALL SELECT 'V13', CASE WHEN COUNT(DISTINCT version_meta) = 3 THEN 'PASS' ELSE 'FAIL' END
FROM raw_metas""")
def score(m):
    todo = quality.checks(m.raw)
    return quality.score({c: todo[c]() for c in ("V02", "V03", "V04", "V05", "V10", "V13")}, _SCORED)


@query("dq_duplicate_keys", f"""
SELECT COUNT(*) AS total, {n("estado_linea = 'DUPLICADO'")} AS marcados,
       {n('k > 1')} AS llave_repetida, {n("estado_linea = 'ACTIVO'")} AS tras_filtro
FROM (SELECT estado_linea, COUNT(*) OVER (PARTITION BY num_factura, id_linea_venta) AS k
      FROM raw_ventas) AS x""")
def duplicate_keys(m):
    return quality.profile_sales(m.raw("ventas"))


@query("dq_negative_stock_profile", f"""
SELECT COUNT(*) AS total, {n('stock_disponible < 0')} AS negativos,
       {n('stock_disponible >= 0')} AS tras_filtro FROM raw_inventario""")
def stock_profile(m):
    return quality.profile_stock(m.raw("inventario"))


@query("dq_negative_stock_sample", """
SELECT id_snapshot_inv, fecha_snapshot, id_almacen, stock_disponible, motivo_ajuste
FROM raw_inventario WHERE stock_disponible < 0
ORDER BY fecha_snapshot, id_snapshot_inv, id_almacen, stock_disponible, motivo_ajuste LIMIT 5""")
def stock_sample(m):
    return quality.stock_sample(m.raw("inventario"))


@query("dq_promotion_keys_profile", f"""
SELECT (SELECT COUNT(*) FROM raw_promociones) AS total_promociones,
       (SELECT {n("id_promocion_sap IS NULL OR id_promocion_sap = ''")} FROM raw_promociones)
         AS promociones_sin_sap,
       (SELECT COUNT(*) FROM raw_inversion) AS total_inversiones,
       (SELECT {n("id_promocion_sap IS NULL OR id_promocion_sap = ''")} FROM raw_inversion)
         AS inversiones_sin_sap,
       (SELECT {n("id_promocion_tm IS NULL OR id_promocion_tm = ''")} FROM raw_inversion)
         AS inversiones_sin_tm,
       (SELECT COUNT(*) FROM (SELECT id_promocion_tm FROM raw_promociones
                              WHERE id_promocion_tm IS NOT NULL
                              EXCEPT SELECT id_promocion_tm FROM raw_inversion) AS e)
         AS tm_solo_en_promociones""")
def promotion_profile(m):
    return quality.profile_promotions(m.raw("promociones"), m.raw("inversion_promocional"))


@query("dq_key_set_difference", """
SELECT id_promocion_tm FROM raw_promociones WHERE id_promocion_tm IS NOT NULL
EXCEPT SELECT id_promocion_tm FROM raw_inversion""")
def key_set_difference(m):
    return joins.key_difference(m.raw("promociones"), m.raw("inversion_promocional"), "id_promocion_tm")


@query("dq_missing_fields_profile", f"""
SELECT COUNT(*) AS total, {n("COALESCE(motivo_rechazo, '') = ''")} AS motivo_vacio,
       {n("COALESCE(transportista, '') = ''")} AS transportista_vacio,
       {n('cantidad_rechazada_uds > 0')} AS rechazados,
       {n("cantidad_rechazada_uds > 0 AND COALESCE(motivo_rechazo, '') = ''")}
         AS rechazados_sin_motivo,
       {n("COALESCE(motivo_rechazo, '') IN ('', 'No especificado')")} AS motivo_imputado,
       {n("COALESCE(transportista, '') IN ('', 'No especificado')")} AS transportista_imputado
FROM raw_fill_rate""")
def missing_profile(m):
    return quality.profile_dispatches(m.raw("fill_rate"))


_CLOSED = ("estado_cliente = 'INACTIVO' AND TRY_CAST(fecha_baja_sistema AS TIMESTAMP)"
           " < TIMESTAMP '2023-01-01'")


@query("dq_inactive_before", f"""
SELECT COUNT(*) AS total, {n("estado_cliente = 'INACTIVO'")} AS inactivos_total,
       {n(_CLOSED)} AS inactivos_antes
FROM raw_clientes""")
def inactive_before(m):
    return quality.profile_customers(m.raw("clientes"))


_RULES = (
    ("VQ-01", "raw_ventas", "estado_linea = 'DUPLICADO'", "FALLA"),
    ("VQ-02", "raw_inventario", "stock_disponible < 0", "FALLA"),
    ("VQ-03", "raw_promociones", "COALESCE(id_promocion_sap, '') = ''", "FALLA"),
    ("VQ-04", "raw_fill_rate", "COALESCE(transportista, '') = ''", "FALLA"),
    ("VQ-05", "raw_clientes", _CLOSED, "ADVERTENCIA"),
)


@query("dq_profile_summary", "\nUNION ALL\n".join(f"""
SELECT '{rule}' AS regla, CASE WHEN x > 0 THEN '{word}' ELSE 'OK' END AS estado, x AS afectados,
       t AS total, {pct('x', 't', 1)} AS pct
FROM (SELECT COUNT(*) AS t, {n(problem)} AS x FROM {table}) AS q{i}"""
      for i, (rule, table, problem, word) in enumerate(_RULES)))
def profile_summary(m):
    return quality.profile_summary(m.raw)


# -- reconciliation -------------------------------------------------------------------

_RAW = {
    "ventas": "raw_ventas", "pedidos": "raw_pedidos", "devoluciones": "raw_devoluciones",
    "fill_rate": "raw_fill_rate", "inventario": "raw_inventario", "metas": "raw_metas",
    "metas_operativas": "raw_metas_operativas", "promociones": "raw_promociones",
    "inversion_promocional": "raw_inversion", "clientes": "raw_clientes",
    "productos": "raw_productos", "canal": "dim_canal", "geografia": "dim_geografia",
    "almacen": "dim_almacen", "vendedor": "dim_vendedor",
}


def _counts(tables, label="tabla"):
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS {label}, COUNT(*) AS filas FROM {t}" for name, t in tables.items())


@query("rec_raw_counts", _counts(_RAW))
def raw_counts(m):
    return reconcile.count_rows({name: m.raw(name) for name in _RAW})


_STAR = {
    "DIM_TIEMPO": "dim_tiempo", "DIM_CANAL": "dim_canal", "DIM_GEOGRAFIA": "dim_geografia",
    "DIM_ALMACEN": "dim_almacen", "DIM_VENDEDOR": "dim_vendedor", "DIM_CLIENTE": "dim_cliente",
    "DIM_PRODUCTO": "dim_producto", "FACT_VENTAS": "fact_ventas",
    "FACT_INVENTARIO": "fact_inventario", "FACT_METAS_COMERCIAL": "fact_metas_comercial",
    "FACT_METAS_OPERATIVO": "fact_metas_operativo",
}


@query("rec_layer_counts", _counts(_STAR))
def layer_counts(m):
    tables = {}
    for name in _STAR:
        kind, table = name.lower().split("_", 1)
        tables[name] = m.dim(table) if kind == "dim" else m.fact(table)
    return reconcile.count_rows(tables)


@query("rec_cube_counts", _counts({
    "CUBO_COMERCIAL_TBL": "cubo_comercial", "CUBO_FACTURAS_TBL": "cubo_facturas",
    "CUBO_INVENTARIO_TBL": "cubo_inventario"}, "cubo"))
def cube_counts(m):
    return reconcile.count_rows({
        "CUBO_COMERCIAL_TBL": m.commercial, "CUBO_FACTURAS_TBL": m.invoices,
        "CUBO_INVENTARIO_TBL": m.inventory}, "cubo")


@query("rec_raw_vs_trusted", f"""
SELECT *, raw_total - trusted_total AS diferencia
FROM (SELECT (SELECT COUNT(*) FROM raw_ventas) AS raw_total,
             (SELECT COUNT(*) FROM tru_ventas) AS trusted_total,
             (SELECT {n("estado_linea = 'DUPLICADO'")} FROM raw_ventas) AS raw_a_eliminar) AS x""")
def sales_removed(m):
    return reconcile.removed_rows(
        m.raw("ventas"), m.trusted("ventas"), F.col("estado_linea") == "DUPLICADO")


@query("rec_raw_vs_trusted_stock", f"""
SELECT *, raw_total - trusted_total AS diferencia
FROM (SELECT (SELECT COUNT(*) FROM raw_inventario) AS raw_total,
             (SELECT COUNT(*) FROM tru_inventario) AS trusted_total,
             (SELECT {n('stock_disponible < 0')} FROM raw_inventario) AS raw_a_eliminar) AS x""")
def stock_removed(m):
    return reconcile.removed_rows(
        m.raw("inventario"), m.trusted("inventario"), F.col("stock_disponible") < 0)


@query("rec_zero_left", f"""
SELECT 'estado_duplicado' AS regla, {n("estado_linea = 'DUPLICADO'")} AS registros FROM tru_ventas
UNION ALL SELECT 'sufijo_dup_ventas', {n("suffix(id_linea_venta, '_DUP')")} FROM tru_ventas
UNION ALL SELECT 'stock_negativo', {n('stock_disponible < 0')} FROM tru_inventario
UNION ALL SELECT 'nulos_transportista', {n('transportista IS NULL')} FROM tru_fill_rate
UNION ALL SELECT 'meta_no_aprobada', {n('es_version_aprobada <> 1')} FROM tru_metas
UNION ALL SELECT 'sufijo_dup_productos', {n("suffix(cod_sap, '_DUP')")} FROM tru_productos""")
def zero_left(m):
    t = m.trusted
    return reconcile.zero_left({
        "estado_duplicado": (t("ventas"), F.col("estado_linea") == "DUPLICADO"),
        "sufijo_dup_ventas": (t("ventas"), F.col("id_linea_venta").endswith(DUPLICATE_SUFFIX)),
        "stock_negativo": (t("inventario"), F.col("stock_disponible") < 0),
        "nulos_transportista": (t("fill_rate"), F.col("transportista").isNull()),
        "meta_no_aprobada": (t("metas"), F.col("es_version_aprobada") != 1),
        "sufijo_dup_productos": (t("productos"), F.col("cod_sap").endswith(DUPLICATE_SUFFIX)),
    })


@query("rec_imputed_counts", f"""
SELECT {n('transportista IS NULL')} AS nulos_transportista,
       {n("transportista = 'No especificado'")} AS imputados_transportista,
       {n('motivo_rechazo IS NULL')} AS nulos_motivo_rechazo,
       {n("motivo_rechazo = 'No especificado'")} AS imputados_motivo_rechazo
FROM tru_fill_rate""")
def imputed(m):
    return reconcile.imputed_counts(m.trusted("fill_rate"), UNSPECIFIED)


@query("rec_pending_sap", f"""
SELECT CAST(flag_sap_id_pendiente AS BIGINT) AS flag_sap_id_pendiente, COUNT(*) AS registros,
       {n("id_promocion_sap IS NULL OR id_promocion_sap = ''")} AS sin_id_sap
FROM tru_promociones GROUP BY 1""")
def pending_sap(m):
    return reconcile.pending_sap(m.trusted("promociones"))


@query("rec_address_flag", """
SELECT CAST(flag_direccion_completa AS BIGINT) AS flag_direccion_completa, COUNT(*) AS registros
FROM tru_clientes GROUP BY 1""")
def address_flag(m):
    return reconcile.counts_by(m.trusted("clientes"), "flag_direccion_completa")


@query("rec_approved_distribution", """
SELECT CAST(es_version_aprobada AS BIGINT) AS es_version_aprobada, COUNT(*) AS registros
FROM raw_metas GROUP BY 1""")
def approved_distribution(m):
    return reconcile.counts_by(m.raw("metas"), "es_version_aprobada")


@query("rec_state_distribution", "SELECT estado_linea, COUNT(*) AS registros FROM raw_ventas GROUP BY 1")
def state_distribution(m):
    return reconcile.counts_by(m.raw("ventas"), "estado_linea")


@query("rec_date_ranges", """
SELECT 'ventas' AS tabla, MIN(fecha_emision) AS fecha_min, MAX(fecha_emision) AS fecha_max
FROM raw_ventas
UNION ALL SELECT 'pedidos', MIN(fecha_pedido), MAX(fecha_pedido) FROM raw_pedidos
UNION ALL SELECT 'fill_rate', MIN(fecha_despacho), MAX(fecha_despacho) FROM raw_fill_rate
UNION ALL SELECT 'inventario', MIN(fecha_snapshot), MAX(fecha_snapshot) FROM raw_inventario""")
def date_ranges(m):
    return reconcile.date_ranges({
        "ventas": (m.raw("ventas"), "fecha_emision"),
        "pedidos": (m.raw("pedidos"), "fecha_pedido"),
        "fill_rate": (m.raw("fill_rate"), "fecha_despacho"),
        "inventario": (m.raw("inventario"), "fecha_snapshot"),
    })


def _orphan(name, fact, dim, col, key=None):
    return (f"SELECT '{name}' AS check_nombre, COUNT(*) AS huerfanos FROM {fact} f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key or col} = f.{col})")


_FKS = (("tiempo", "id_fecha"), ("canal", "id_canal"), ("producto", "id_producto"),
        ("cliente", "id_cliente"), ("vendedor", "id_vendedor"), ("almacen", "id_almacen"),
        ("geografia", "id_geografia"))


@query("rec_referential_integrity", "\nUNION ALL\n".join(
    _orphan(f"sin_dim_{dim}", "fact_ventas", f"dim_{dim}", col) for dim, col in _FKS))
def sales_integrity(m):
    return reconcile.sales_integrity(m)


@query("rec_referential_integrity_stock", "\nUNION ALL\n".join(
    _orphan(f"sin_dim_{dim}", "fact_inventario", f"dim_{dim}", col)
    for dim, col in _FKS if dim in ("tiempo", "producto", "almacen")))
def inventory_integrity(m):
    return reconcile.inventory_integrity(m)


@query("rec_orphans_found", "\nUNION ALL\n".join([
    "SELECT 'sin_promocion' AS check_nombre, COUNT(*) AS huerfanos FROM raw_inversion i WHERE NOT "
    "EXISTS (SELECT 1 FROM raw_promociones p WHERE p.id_promocion_tm = i.id_promocion_tm)",
    "SELECT 'sin_pedido', COUNT(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l "
    "WHERE l.l_orderkey = o.o_orderkey)"]))
def orphans_found(m):
    # the same audit where orphans (NULL keys too) do exist
    promos = m.raw("promociones")
    spend = joins.orphan_counts(
        m.raw("inversion_promocional"),
        {"sin_promocion": ("id_promocion_tm", promos, "id_promocion_tm")})
    empty = joins.orphan_counts(
        m.raw("pedidos"), {"sin_pedido": ("id_pedido", m.raw("ventas"), "num_factura")})
    return spend.unionByName(empty)


@query("rec_trusted_orphans", f"""
{_orphan('clientes_huerfanos', 'tru_ventas', 'dim_cliente', 'id_cliente').replace('huerfanos FROM', 'registros FROM')}
UNION ALL
{_orphan('productos_huerfanos', 'tru_ventas', 'dim_producto', 'id_producto')}""")
def trusted_orphans(m):
    return reconcile.trusted_orphans(m)


@query("rec_key_uniqueness", """
SELECT num_factura, id_linea_venta, COUNT(*) AS veces FROM raw_ventas
GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def key_uniqueness(m):
    return joins.duplicate_keys(m.raw("ventas"), ["num_factura", "id_linea_venta"])


@query("rec_calendar_coverage", f"""
SELECT COUNT(*) AS total_dias, MIN(fecha) AS fecha_minima, MAX(fecha) AS fecha_maxima,
       {n('es_feriado = 1')} AS dias_feriado, {n('es_dia_habil = 1')} AS dias_habiles,
       {n('es_fin_semana = 1')} AS dias_fin_semana, COUNT(DISTINCT anio) AS anios_distintos,
       COUNT(DISTINCT trimestre) AS trimestres_distintos
FROM dim_tiempo WHERE fecha BETWEEN (SELECT MIN(fecha_emision) FROM tru_ventas)
                               AND (SELECT MAX(fecha_emision) FROM tru_ventas)""")
def calendar_coverage(m):
    """All days from the first sale to the last, with sales or without."""
    sales = m.trusted("ventas").agg(F.min("fecha_emision").alias("a"), F.max("fecha_emision").alias("b"))
    days = m.dim("tiempo").join(F.broadcast(sales), F.col("fecha").between(F.col("a"), F.col("b")))
    return reconcile.calendar_coverage(days)


@query("rec_calendar_coverage_whole", f"""
SELECT COUNT(*) AS total_dias, MIN(fecha) AS fecha_minima, MAX(fecha) AS fecha_maxima,
       {n('es_feriado = 1')} AS dias_feriado, {n('es_dia_habil = 1')} AS dias_habiles,
       {n('es_fin_semana = 1')} AS dias_fin_semana, COUNT(DISTINCT anio) AS anios_distintos,
       COUNT(DISTINCT trimestre) AS trimestres_distintos
FROM dim_tiempo""")
def calendar_coverage_whole(m):
    return reconcile.calendar_coverage(m.dim("tiempo"))


_DAMAGED = """
  dias AS (SELECT id_fecha, fecha FROM dim_tiempo WHERE fecha NOT BETWEEN '1998-03-10' AND '1998-03-14'
           UNION ALL SELECT id_fecha, fecha FROM dim_tiempo WHERE fecha = '1999-07-28')"""


def _damaged(m):
    """The calendar with a hole of five days and a day that is there twice."""
    days = m.dim("tiempo")
    hole = F.col("fecha").between(F.lit("1998-03-10").cast("date"), F.lit("1998-03-14").cast("date"))
    return days.where(~hole).unionByName(days.where(F.col("fecha") == F.lit("1999-07-28").cast("date")))


@query("rec_calendar_gaps", f"""
SELECT * FROM (WITH {_DAMAGED},
  una AS (SELECT DISTINCT id_fecha, fecha FROM dias),
  saltos AS (SELECT fecha, lead(fecha) OVER (ORDER BY fecha) AS sig FROM una),
  libres AS (SELECT fecha, fecha - CAST(row_number() OVER (ORDER BY fecha) AS INT) AS isla,
                    (SELECT COUNT(*) FROM una u WHERE u.fecha <= una.fecha) AS lugar
             FROM una WHERE id_fecha NOT IN (SELECT id_fecha FROM fact_ventas WHERE id_fecha IS NOT NULL)),
  islas AS (SELECT fecha, lugar - row_number() OVER (ORDER BY fecha) AS g FROM libres)
  SELECT 'calendario' AS tabla, CAST(fecha + 1 AS DATE) AS desde, CAST(sig - 1 AS DATE) AS hasta,
         CAST(sig - fecha - 1 AS BIGINT) AS dias FROM saltos WHERE sig - fecha > 1
  UNION ALL
  SELECT 'ventas', MIN(fecha), MAX(fecha), COUNT(*) FROM islas GROUP BY g) AS q""")
def calendar_gaps(m):
    return reconcile.calendar_gaps(_damaged(m), m.fact("ventas"))


@query("rec_calendar_keys", f"""
SELECT * FROM (WITH {_DAMAGED} SELECT id_fecha, COUNT(*) AS veces FROM dias GROUP BY 1 HAVING COUNT(*) > 1) AS q""")
def calendar_keys(m):
    return reconcile.key_uniqueness(_damaged(m))


@query("rec_trusted_vs_fact", """
SELECT *, trusted_ventas - curated_fact_ventas AS diferencia
FROM (SELECT (SELECT COUNT(*) FROM tru_ventas) AS trusted_ventas,
             (SELECT COUNT(*) FROM fact_ventas) AS curated_fact_ventas) AS x""")
def trusted_vs_fact(m):
    both = joins.side_by_side({
        "trusted_ventas": m.trusted("ventas").agg(F.count(F.lit(1)).alias("v")),
        "curated_fact_ventas": m.fact("ventas").agg(F.count(F.lit(1)).alias("v")),
    })
    return both.withColumn("diferencia", F.col("trusted_ventas") - F.col("curated_fact_ventas"))


@query("rec_sales_measures", f"""
SELECT {n('ventas_netas_soles <= 0')} AS ventas_netas_no_positivas,
       {n('cantidad_vendida <= 0')} AS cantidad_no_positiva,
       {n('costo_ventas_soles < 0')} AS costo_negativo,
       {d('MIN(ventas_netas_soles)')} AS min_ventas_netas,
       {d('MAX(ventas_netas_soles)')} AS max_ventas_netas,
       {r(ratio('SUM(ventas_netas_soles)', 'COUNT(*)'), 2)} AS avg_ventas_netas
FROM fact_ventas""")
def sales_measures(m):
    return reconcile.sales_measures(m.fact("ventas"))


@query("rec_stock_measures", f"""
SELECT {n('stock_disponible < 0')} AS registros_stock_negativo,
       MIN(stock_disponible) AS stock_minimo FROM fact_inventario""")
def stock_measures(m):
    return reconcile.stock_measures(m.fact("inventario"))


@query("rec_returns_conserved", f"""
SELECT {b('(SELECT SUM(unidades_devueltas) FROM fact_ventas)')} AS curated_devueltas,
       {b('(SELECT SUM(cantidad_devuelta) FROM raw_devoluciones)')} AS trusted_devueltas""")
def returns_conserved(m):
    return reconcile.returns_conserved(m.fact("ventas"), m.trusted("devoluciones"))


_SAMPLE = ("num_factura, id_producto, id_fecha, id_cliente, id_canal, id_vendedor, id_almacen, "
           "cantidad_vendida, ventas_netas_soles, costo_ventas_soles, unidades_devueltas, "
           "monto_devuelto_soles")


@query("rec_sales_sample", f"""
SELECT * REPLACE ({d('ventas_netas_soles')} AS ventas_netas_soles,
                  {d('costo_ventas_soles')} AS costo_ventas_soles,
                  {d('monto_devuelto_soles')} AS monto_devuelto_soles)
FROM (SELECT {_SAMPLE} FROM fact_ventas ORDER BY {_SAMPLE} LIMIT 5) AS x""")
def sales_sample(m):
    return reconcile.sales_sample(m.fact("ventas"))


@query("rec_target_coverage", """
SELECT id_canal, COUNT(DISTINCT periodo) AS periodos_con_meta, MIN(periodo) AS periodo_min,
       MAX(periodo) AS periodo_max
FROM fact_metas_comercial GROUP BY 1""")
def target_coverage(m):
    return reconcile.target_coverage(m.fact("metas_comercial"))


@query("rec_first_purchases", f"""
SELECT {n('fecha_primer_compra IS NULL')} AS sin_compra,
       {n("fecha_primer_compra < DATE '1996-01-01'")} AS anterior_al_inicio,
       {n("fecha_primer_compra > DATE '2001-06-30'")} AS fecha_futura,
       MIN(fecha_primer_compra) AS primer_compra_min, MAX(fecha_primer_compra) AS primer_compra_max
FROM dim_cliente""")
def first_purchases(m):
    return reconcile.first_purchases(
        m.dim("cliente"), "1996-01-01", F.lit("2001-06-30").cast("date"))


def _gap(left, lcol, right, rcol, names):
    return f"""
SELECT {d('a')} AS {names[0]}, {d('b')} AS {names[1]}, {d('ABS(a - b)')} AS diferencia_absoluta
FROM (SELECT (SELECT SUM({lcol}) FROM {left}) AS a, (SELECT SUM({rcol}) FROM {right}) AS b) AS x"""


_CF = ("kpi_ventas_netas", "curated_ventas_netas")


@query("rec_cube_vs_fact", _gap(
    "cubo_comercial", "ventas_netas", "fact_ventas", "ventas_netas_soles", _CF))
def cube_vs_fact(m):
    return reconcile.compare_totals(
        cubes.commercial(m, levels=["periodo"]), "ventas_netas", m.fact("ventas"), "ventas_netas_soles", _CF)


_CC = ("comercial_ventas", "facturas_ventas")


@query("rec_cube_vs_cube", _gap(
    "cubo_comercial", "ventas_netas", "cubo_facturas", "ventas_netas", _CC))
def cube_vs_cube(m):
    return reconcile.compare_totals(
        m.commercial, "ventas_netas", m.invoices, "ventas_netas", _CC)


_CS = ("kpi_stock", "curated_stock")


@query("rec_stock_vs_fact", _gap(
    "cubo_inventario", "stock_disponible", "fact_inventario", "stock_disponible", _CS))
def stock_vs_fact(m):
    return reconcile.compare_totals(
        m.inventory, "stock_disponible", m.fact("inventario"), "stock_disponible", _CS)


@query("rec_margin_identity", f"""
SELECT {n('margen_bruto < 0')} AS filas_margen_negativo,
       {n('ABS(margen_bruto - (ventas_netas - costo_ventas)) > 0.01')}
         AS filas_margen_inconsistente,
       {d('SUM(ventas_netas)')} AS total_ventas_netas,
       {d('SUM(costo_ventas)')} AS total_costo_ventas,
       {d('SUM(margen_bruto)')} AS total_margen_bruto,
       {pct('SUM(margen_bruto)', 'SUM(ventas_netas)')} AS margen_pct_global
FROM cubo_comercial""")
def margin_identity(m):
    return reconcile.margin_identity(m.commercial)


@query("rec_channel_totals", f"""
SELECT nombre_canal, tipo_canal, {d('SUM(ventas_netas)')} AS ventas_netas,
       {d('SUM(meta_ventas_netas)')} AS meta_ventas_netas,
       {pct('SUM(ventas_netas)', 'SUM(meta_ventas_netas)', 1)} AS cumplimiento_pct
FROM cubo_comercial GROUP BY 1, 2""")
def channel_totals(m):
    return reconcile.channel_totals(m.commercial)


@query("rec_channel_tickets", f"""
SELECT nombre_canal, tipo_canal, {b('SUM(num_facturas)')} AS total_facturas,
       COUNT(DISTINCT nombre_canal) AS canales,
       {r(ratio('SUM(ventas_netas)', 'SUM(num_facturas)'), 2)} AS ticket_promedio,
       {b('SUM(num_clientes_activos)')} AS clientes_activos
FROM cubo_facturas GROUP BY 1, 2""")
def channel_tickets(m):
    return reconcile.channel_tickets(m.invoices)


def _mean(c, digits):
    return r(ratio(f"SUM(CAST({c} AS DECIMAL(28,4)))", f"COUNT({c})"), digits)


@query("rec_rate_range", f"""
SELECT {n('tasa_quiebre_pct < 0 OR tasa_quiebre_pct > 100')} AS filas_fuera_de_rango,
       {r('MIN(tasa_quiebre_pct)', 2)} AS quiebre_minimo,
       {r('MAX(tasa_quiebre_pct)', 2)} AS quiebre_maximo,
       {_mean('tasa_quiebre_pct', 2)} AS quiebre_promedio,
       {_mean('dias_cobertura', 1)} AS cobertura_promedio_dias
FROM cubo_inventario""")
def rate_range(m):
    return reconcile.rate_range(m.inventory)


@query("rec_warehouse_means", f"""
SELECT nombre_almacen, macroregion, {_mean('tasa_quiebre_pct', 2)} AS quiebre_pct_promedio,
       {d('MAX(meta_quiebre_pct)')} AS meta_quiebre_pct,
       {_mean('dias_cobertura', 1)} AS dias_cobertura_promedio,
       {d('MAX(meta_dias_cobertura)')} AS meta_dias_cobertura
FROM cubo_inventario GROUP BY 1, 2""")
def warehouse_means(m):
    return reconcile.warehouse_means(m.inventory)


@query("rec_operational_targets_present", f"""
SELECT {n('meta_fill_rate_pct IS NULL')} AS sin_meta_fill_rate,
       {n('meta_otif_pct IS NULL')} AS sin_meta_otif,
       {d('MIN(meta_fill_rate_pct)')} AS fill_rate_meta_min,
       {d('MAX(meta_fill_rate_pct)')} AS fill_rate_meta_max,
       {d('MIN(meta_otif_pct)')} AS otif_meta_min, {d('MAX(meta_otif_pct)')} AS otif_meta_max
FROM cubo_inventario""")
def operational_targets_present(m):
    return reconcile.operational_targets_present(m.inventory)


# -- the run of all checks ---------------------------------------------------------------------

# What the run is held against here: a field that is as expected, one that is off, one that is
# not there; checks without an expectation inform only, and one more reads a column that is not there.
_WANTED = {"V02": {"duplicados_sin_sufijo_dup": 0}, "V01": {"total_filas": -1}, "V08": {"no_existe": 0},
           "V13": {"versiones_distintas": 3}, "V16": {"total_inversiones": -1}}


def _run(m):
    listed = checkrun.table_checks()
    listed["ventas"].append(checkrun.Check("V99", (F.count_if(F.col("no_existe") == 1).alias("n"),)))
    ids = sorted([c.id for cs in listed.values() for c in cs] + ["V12", "V16"])
    measures, errors = checkrun.run(m.spark, m.raw, {**listed, "promociones": []})
    return measures, checkrun.report(measures, errors, ids, _WANTED)


_RUN_TAGS = {**quality.TAGS, "V99": "V99"}
_RUN_STATE = {
    "V01": "'FAIL'", "V16": "'FAIL'", "V08": "'WARN'", "V99": "'ERROR'",
    "V02": f"CASE WHEN (SELECT {n('estado_linea = $$DUPLICADO$$ AND NOT ends_with(id_linea_venta, $$_DUP$$)')} FROM raw_ventas) = 0"
           " THEN 'PASS' ELSE 'FAIL' END",
    "V13": "CASE WHEN (SELECT COUNT(DISTINCT version_meta) FROM raw_metas) = 3 THEN 'PASS' ELSE 'FAIL' END",
}
_REPORT = " UNION ALL ".join(
    f"SELECT '{c}' AS check_id, '{_RUN_TAGS[c]}' AS etiqueta, {_RUN_STATE.get(c, chr(39) + 'INFO' + chr(39))} AS estado"
    for c in sorted(set(_RUN_TAGS) - {"V17"}))


@query("dq_run_report", f"SELECT * FROM ({_REPORT}) AS q")
def run_report(m):
    return _run(m)[1].drop("detalle")


@query("dq_run_tally", f"""
SELECT e.estado, COUNT(q.check_id) AS checks
FROM (VALUES ('PASS'), ('FAIL'), ('WARN'), ('INFO'), ('ERROR')) AS e(estado)
LEFT JOIN ({_REPORT}) AS q ON e.estado = q.estado GROUP BY 1""")
def run_tally(m):
    return checkrun.tally(_run(m)[1])


def _unfolded(check, relation, fields, by=None):
    group = f"CAST({by} AS VARCHAR)" if by else "CAST(NULL AS VARCHAR)"
    inner = f"SELECT {group} AS grupo, [{', '.join('{{c: $${}$$, v: CAST({} AS DOUBLE)}}'.format(f, e) for f, e in fields.items())}] AS a FROM {relation}"
    inner += f" GROUP BY {by}" if by else ""
    return f"SELECT '{check}' AS check_id, grupo, x.c AS campo, x.v AS valor FROM (SELECT grupo, unnest(a) AS x FROM ({inner}))"


_COUNT = lambda cond: f"COUNT(*) FILTER (WHERE {cond})"
_NEGATIVE = "stock_disponible < 0"
_COHORT = "CASE WHEN CAST(fecha_alta_sistema AS DATE) < DATE '2022-01-01' THEN 'pre_2022' ELSE '2022_en_adelante' END"


@query("dq_run_measures", "SELECT * FROM (" + " UNION ALL ".join([
    _unfolded("V06", "raw_inventario", {
        "total_filas": "COUNT(*)", "stock_negativo": _COUNT(_NEGATIVE), "stock_cero": _COUNT("stock_disponible = 0"),
        "stock_positivo": _COUNT("stock_disponible > 0"), "pct_stock_negativo": pct(_COUNT(_NEGATIVE), "COUNT(*)")}),
    _unfolded("V07", "raw_inventario", {
        "stock_negativo_total": _COUNT(_NEGATIVE),
        **{f"neg_con_flag_ajuste_{v.lower()}": _COUNT(f"{_NEGATIVE} AND flag_ajuste_pendiente = $${v}$$") for v in "SN"},
        "neg_con_flag_ajuste_null": _COUNT(f"{_NEGATIVE} AND flag_ajuste_pendiente IS NULL")}),
    _unfolded("V09", "raw_clientes", {
        "total": "COUNT(*)", "direccion_null": _COUNT("direccion_fiscal IS NULL"),
        "pct_null": pct(_COUNT("direccion_fiscal IS NULL"), "COUNT(*)")}, by=_COHORT),
    _unfolded("V11", "raw_productos", {"filas": _COUNT("ends_with(CAST(cod_sap AS VARCHAR), $$_DUP$$)")}),
    _unfolded("V12", "raw_promociones", {
        "total_promociones": "COUNT(*)", "id_sap_null": _COUNT("id_promocion_sap IS NULL"),
        "pct_id_sap_null": pct(_COUNT("id_promocion_sap IS NULL"), "COUNT(*)"),
        "id_sap_presente": "COUNT(id_promocion_sap)",
        "id_sap_formato_no_estandar": _COUNT("id_promocion_sap IS NOT NULL AND NOT regexp_full_match(id_promocion_sap, $$[0-9]{8,10}$$)"),
        "pct_formato_no_estandar": pct(_COUNT(
            "id_promocion_sap IS NOT NULL AND NOT regexp_full_match(id_promocion_sap, $$[0-9]{8,10}$$)"), "COUNT(*)")}),
    _unfolded("V14", "raw_metas", {
        "filas": "COUNT(*)", "aprobadas": _COUNT("es_version_aprobada = 1"),
        "sin_aprobador": _COUNT("aprobado_por IS NULL"), "sin_fecha_aprobacion": _COUNT("fecha_aprobacion IS NULL")},
        by="version_meta"),
    _unfolded("V15", "raw_devoluciones", {
        "total_filas": "COUNT(*)", "filas_estado": "COUNT(*)", "nota_credito_null": _COUNT("num_nota_credito IS NULL"),
        "fecha_aprobacion_null": _COUNT("fecha_aprobacion_dev IS NULL")}, by="estado_devolucion"),
    _unfolded("V16", """(SELECT i.*, p.id_promocion_tm AS hallada FROM raw_inversion i
                        LEFT JOIN raw_promociones p ON i.id_promocion_tm = p.id_promocion_tm)""", {
        "total_inversiones": "COUNT(*)", "inv_sin_id_tm": _COUNT("id_promocion_tm IS NULL"),
        "inv_sin_id_sap": _COUNT("id_promocion_sap IS NULL"),
        "id_tm_sin_match_en_promociones": _COUNT("hallada IS NULL AND id_promocion_tm IS NOT NULL")}),
]) + ") AS q")
def run_measures(m):
    """The measures of eight checks that have no query of their own under their tag."""
    shown = ["V06", "V07", "V09", "V11", "V12", "V14", "V15", "V16"]
    return _run(m)[0].where(F.col("check_id").isin(shown))
