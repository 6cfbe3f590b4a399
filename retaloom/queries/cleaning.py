"""Cleaning rules over whole raw tables."""

from retaloom.plans import trusted
from retaloom.queries.registry import query


@query("clean_sales_dedup", """
SELECT * REPLACE (
  CAST(precio_unitario_soles AS DOUBLE) AS precio_unitario_soles,
  CAST(precio_lista_soles AS DOUBLE) AS precio_lista_soles,
  CAST(monto_bruto_soles AS DOUBLE) AS monto_bruto_soles,
  CAST(descuento_pct AS DOUBLE) AS descuento_pct,
  CAST(ventas_netas_soles AS DOUBLE) AS ventas_netas_soles,
  CAST(costo_ventas_soles AS DOUBLE) AS costo_ventas_soles,
  CAST(inversion_promocional_soles AS DOUBLE) AS inversion_promocional_soles)
FROM tru_ventas""")
def sales(m):
    return m.trusted("ventas")


@query("clean_strip_suffix", """
SELECT * REPLACE (CAST(precio_lista_soles AS DOUBLE) AS precio_lista_soles,
                  CAST(costo_estandar_soles AS DOUBLE) AS costo_estandar_soles)
FROM tru_productos""")
def products(m):
    return m.trusted("productos")


@query("clean_impute_constant", """
SELECT * REPLACE (CAST(flag_on_time AS BIGINT) AS flag_on_time,
                  CAST(flag_in_full AS BIGINT) AS flag_in_full,
                  CAST(flag_otif AS BIGINT) AS flag_otif)
FROM tru_fill_rate""")
def dispatches(m):
    return m.trusted("fill_rate")


@query("clean_impute_empty_too", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (COALESCE(NULLIF(transportista, ''), 'No especificado') AS transportista,
                  COALESCE(NULLIF(motivo_rechazo, ''), 'No especificado') AS motivo_rechazo,
                  CAST(flag_on_time AS BIGINT) AS flag_on_time,
                  CAST(flag_in_full AS BIGINT) AS flag_in_full,
                  CAST(flag_otif AS BIGINT) AS flag_otif),
       fecha_carga AS fecha_carga_raw
FROM raw_fill_rate""")
def dispatches_empty(m):
    return trusted.fill_rate(m.raw("fill_rate"), empty_is_null=True)


@query("clean_drop_negative_stock", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (CAST(demanda_diaria_prom AS DOUBLE) AS demanda_diaria_prom,
                  CAST(flag_quiebre_stock AS BIGINT) AS flag_quiebre_stock,
                  CAST(dias_cobertura_calc AS DOUBLE) AS dias_cobertura_calc),
       fecha_carga AS fecha_carga_raw
FROM tru_inventario""")
def stock(m):
    return m.trusted("inventario")


@query("clean_approved_only", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (CAST(anio AS BIGINT) AS anio, CAST(mes AS BIGINT) AS mes,
                  CAST(meta_ventas_netas_soles AS DOUBLE) AS meta_ventas_netas_soles,
                  CAST(meta_margen_bruto_soles AS DOUBLE) AS meta_margen_bruto_soles,
                  CAST(meta_margen_bruto_pct AS DOUBLE) AS meta_margen_bruto_pct,
                  CAST(meta_ticket_promedio_soles AS DOUBLE) AS meta_ticket_promedio_soles,
                  CAST(meta_frecuencia_compra AS DOUBLE) AS meta_frecuencia_compra,
                  CAST(meta_roi_promocional_pct AS DOUBLE) AS meta_roi_promocional_pct,
                  CAST(meta_tasa_devolucion_pct AS DOUBLE) AS meta_tasa_devolucion_pct,
                  CAST(es_version_aprobada AS BIGINT) AS es_version_aprobada),
       fecha_carga AS fecha_carga_raw
FROM tru_metas""")
def targets(m):
    return m.trusted("metas")


@query("clean_approved_operational", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (CAST(anio AS BIGINT) AS anio, CAST(mes AS BIGINT) AS mes,
                  CAST(meta_quiebre_pct AS DOUBLE) AS meta_quiebre_pct,
                  CAST(meta_dias_cobertura AS DOUBLE) AS meta_dias_cobertura,
                  CAST(meta_otif_pct AS DOUBLE) AS meta_otif_pct,
                  CAST(meta_fill_rate_pct AS DOUBLE) AS meta_fill_rate_pct,
                  CAST(es_version_aprobada AS BIGINT) AS es_version_aprobada),
       fecha_carga AS fecha_carga_raw
FROM tru_metas_operativas""")
def operational(m):
    return m.trusted("metas_operativas")


@query("clean_trim_flag", """
SELECT * REPLACE (CAST(flag_sap_id_pendiente AS BIGINT) AS flag_sap_id_pendiente)
FROM tru_promociones""")
def promotions(m):
    return m.trusted("promociones")


@query("clean_completeness_flag", """
SELECT * REPLACE (CAST(limite_credito_soles AS DOUBLE) AS limite_credito_soles,
                  CAST(flag_direccion_completa AS BIGINT) AS flag_direccion_completa)
FROM tru_clientes""")
def customers(m):
    return m.trusted("clientes")


@query("clean_pass_through_orders", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (CAST(monto_pedido_soles AS DOUBLE) AS monto_pedido_soles),
       fecha_carga AS fecha_carga_raw
FROM raw_pedidos""")
def orders(m):
    return m.trusted("pedidos")


@query("clean_pass_through_returns", """
SELECT * EXCLUDE (fecha_carga)
         REPLACE (CAST(monto_devolucion_soles AS DOUBLE) AS monto_devolucion_soles),
       fecha_carga AS fecha_carga_raw
FROM raw_devoluciones""")
def returns(m):
    return m.trusted("devoluciones")


@query("clean_pass_through_promo_spend", """
SELECT id_promocion_tm, id_promocion_sap, CAST(inversion_soles AS DOUBLE) AS inversion_soles,
       fecha_carga, fecha_carga AS fecha_carga_raw
FROM raw_inversion""")
def promo_spend(m):
    return m.trusted("inversion_promocional")
