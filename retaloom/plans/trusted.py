"""Cleaning rules, raw layer to trusted layer. Each rule is a DataFrame to DataFrame step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from retaloom.functions.text import fill_missing, is_blank, strip_suffix, trim_all

# Fixed values.
DUPLICATE_STATE = "DUPLICADO"
DUPLICATE_SUFFIX = "_DUP"
UNSPECIFIED = "No especificado"


def load_date_renamed(df: DataFrame) -> DataFrame:
    """``fecha_carga`` becomes ``fecha_carga_raw`` (last column); absent elsewhere."""
    if "fecha_carga" not in df.columns:
        return df
    return df.select(
        *[c for c in df.columns if c != "fecha_carga"], F.col("fecha_carga").alias("fecha_carga_raw")
    )


def replaced_last(df: DataFrame, **columns) -> DataFrame:
    """Drop the named columns and add their new values at the end of the schema."""
    made = [value.alias(name) for name, value in columns.items()]
    return df.select(*[c for c in df.columns if c not in columns], *made)


def ventas(raw: DataFrame) -> DataFrame:
    # A NULL state fails the comparison, so it is dropped as well.
    kept = raw.where(F.col("estado_linea") != DUPLICATE_STATE)
    return load_date_renamed(
        replaced_last(kept, id_linea_venta=strip_suffix(F.col("id_linea_venta"), DUPLICATE_SUFFIX))
    )


def passed_through(raw: DataFrame) -> DataFrame:
    return load_date_renamed(raw)


def fill_rate(raw: DataFrame, empty_is_null: bool = False) -> DataFrame:
    made = {
        c: fill_missing(F.col(c), UNSPECIFIED, empty_is_null)
        for c in ("transportista", "motivo_rechazo")
    }
    return load_date_renamed(replaced_last(raw, **made))


def inventario(raw: DataFrame) -> DataFrame:
    return load_date_renamed(raw.where(F.col("stock_disponible") >= 0))


def approved_only(raw: DataFrame) -> DataFrame:
    return load_date_renamed(raw.where(F.col("es_version_aprobada") == 1))


def promociones(raw: DataFrame) -> DataFrame:
    sap = F.col("id_promocion_sap")
    return load_date_renamed(
        replaced_last(
            raw,
            id_promocion_sap=trim_all(sap),
            flag_sap_id_pendiente=F.when(is_blank(sap), 1).otherwise(0),
        )
    )


def inversion_promocional(raw: DataFrame) -> DataFrame:
    """Kept as delivered, with the load date under both its raw and its trusted name."""
    if "fecha_carga" not in raw.columns:
        return raw
    return raw.withColumn("fecha_carga_raw", F.col("fecha_carga"))


def _snapshot_last(df: DataFrame) -> DataFrame:
    if "fecha_snapshot" not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != "fecha_snapshot"], "fecha_snapshot")


def clientes(raw: DataFrame) -> DataFrame:
    flag = F.when(F.col("direccion_fiscal").isNull(), 0).otherwise(1)
    return _snapshot_last(raw.withColumn("flag_direccion_completa", flag))


def productos(raw: DataFrame) -> DataFrame:
    return _snapshot_last(
        replaced_last(raw, cod_sap=strip_suffix(F.col("cod_sap"), DUPLICATE_SUFFIX))
    )


def same(raw: DataFrame) -> DataFrame:
    return raw


RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ventas": ventas,
    "pedidos": passed_through,
    "fill_rate": fill_rate,
    "inventario": inventario,
    "devoluciones": passed_through,
    "metas": approved_only,
    "promociones": promociones,
    "inversion_promocional": inversion_promocional,
    "clientes": clientes,
    "productos": productos,
    "metas_operativas": approved_only,
    "canal": same,
    "geografia": same,
    "almacen": same,
    "vendedor": same,
}

# Business date that a stored trusted table is laid out by.
LAYOUT_DATE = {
    "ventas": "fecha_emision",
    "pedidos": "fecha_pedido",
    "fill_rate": "fecha_despacho",
    "inventario": "fecha_snapshot",
    "devoluciones": "fecha_solicitud_dev",
}
