"""Column types of the delivered CSV files, as DDL. Pass another schema for files that differ."""

from __future__ import annotations

_MONEY = "decimal(18,4)"

# File columns per dated source.
TRANSACTIONAL = {
    "ventas": f"""id_linea_venta string, num_factura string, estado_linea string,
        fecha_emision date, id_cliente bigint, id_producto bigint, id_canal bigint,
        id_geografia bigint, id_vendedor bigint, id_almacen bigint, cantidad_vendida bigint,
        precio_unitario_soles {_MONEY}, precio_lista_soles {_MONEY}, monto_bruto_soles {_MONEY},
        descuento_pct {_MONEY}, ventas_netas_soles {_MONEY}, costo_ventas_soles {_MONEY},
        inversion_promocional_soles {_MONEY}""",
    "pedidos": "id_pedido string, fecha_pedido date",
    "devoluciones": f"""num_factura_origen string, id_producto bigint, cantidad_devuelta bigint,
        monto_devolucion_soles {_MONEY}, fecha_solicitud_dev date, estado_devolucion string,
        num_nota_credito string, fecha_aprobacion_dev date""",
    "fill_rate": """id_despacho string, fecha_despacho date, transportista string,
        motivo_rechazo string, flag_on_time int, flag_in_full int, flag_otif int,
        cantidad_rechazada_uds bigint""",
    "inventario": f"""id_snapshot_inv string, fecha_snapshot date, id_producto bigint,
        id_almacen bigint, stock_disponible bigint, stock_reservado bigint,
        demanda_diaria_prom {_MONEY}, flag_quiebre_stock int, dias_cobertura_calc {_MONEY},
        flag_ajuste_pendiente string, motivo_ajuste string""",
    "metas": f"""id_meta_raw string, periodo bigint, anio int, mes int, id_canal bigint,
        meta_ventas_netas_soles {_MONEY}, meta_margen_bruto_soles {_MONEY},
        meta_margen_bruto_pct {_MONEY}, meta_cantidad_vendida bigint,
        meta_ticket_promedio_soles {_MONEY}, meta_frecuencia_compra {_MONEY},
        meta_roi_promocional_pct {_MONEY}, meta_tasa_devolucion_pct {_MONEY},
        version_meta string, es_version_aprobada int, aprobado_por string,
        fecha_aprobacion string""",
    "promociones": "id_promocion_tm string, id_promocion_sap string, tipo_promocion string",
    "inversion_promocional": f"""id_promocion_tm string, id_promocion_sap string,
        inversion_soles {_MONEY}""",
    "metas_operativas": f"""periodo bigint, anio int, mes int, id_almacen bigint,
        meta_quiebre_pct {_MONEY}, meta_dias_cobertura {_MONEY}, meta_otif_pct {_MONEY},
        meta_fill_rate_pct {_MONEY}, es_version_aprobada int""",
}

# File columns per master.
MASTERS = {
    "clientes": f"""id_cliente_raw string, razon_social string, ruc string, tipo_persona string,
        segmento_comercial string, limite_credito_soles {_MONEY}, dias_credito bigint,
        direccion_fiscal string, distrito string, telefono string, email_contacto string,
        fecha_alta_sistema date, estado_cliente string, fecha_baja_sistema string""",
    "productos": f"""id_producto_raw string, cod_sku string, nombre_sku string, marca string,
        categoria string, subcategoria string, linea_negocio string, unidad_medida string,
        contenido_neto string, precio_lista_soles {_MONEY}, costo_estandar_soles {_MONEY},
        estado_producto string, cod_sap string""",
    "canal": f"""id_canal bigint, cod_canal string, nombre_canal string, tipo_canal string,
        margen_objetivo_pct {_MONEY}""",
    "geografia": """id_geografia bigint, pais string, macroregion string, Departamento string,
        provincia string, ciudad string, distrito string, tipo_zona string, codigo_ubigeo string""",
    "almacen": """id_almacen bigint, cod_almacen string, nombre_almacen string,
        tipo_almacen string, macroregion string, region string, provincia string, ciudad string,
        distrito string, tipo_zona string, estado string""",
    "vendedor": """id_vendedor bigint, cod_vendedor string, nombre_completo string, cargo string,
        zona_asignada string, fecha_ingreso date, estado string""",
}

# The audit tables: the raw layer also records the file and its delivery date.
LAYER_AUDIT = """tabla_destino string NOT NULL, tipo string NOT NULL, estado string NOT NULL,
    registros_cargados bigint, mensaje_error string, fecha_carga timestamp NOT NULL"""
RAW_AUDIT = """tabla_destino string NOT NULL, archivo_origen string NOT NULL, fecha_particion date,
    tipo string NOT NULL, estado string NOT NULL, registros_cargados bigint,
    mensaje_error string, fecha_carga timestamp NOT NULL"""
