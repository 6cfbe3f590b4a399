"""Raw-layer checks, source profiling rules, and the scorer that grades them.

A check is a query returning measures. The scorer turns measures and expected
values into PASS, FAIL, WARN or INFO; ``run_checks`` adds ERROR for a check whose
query fails.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from retaloom.functions.numbers import percent
from retaloom.functions.text import fill_missing, is_missing
from retaloom.operators.joins import combined, key_difference, stack
from retaloom.plans.trusted import DUPLICATE_STATE, DUPLICATE_SUFFIX, UNSPECIFIED


def _n(c: Column, name: str) -> Column:
    return F.count_if(c).alias(name)


def _share(c: Column, name: str) -> Column:
    return percent(F.count_if(c), F.count(F.lit(1)), 2).alias(name)


def _over(df: DataFrame | None, measures: list[Column]) -> DataFrame | list[Column]:
    """The measures of a frame; without one the measures themselves, to be taken with others."""
    return measures if df is None else df.agg(*measures)


# -- sales --------------------------------------------------------------------------


def v01_state_counts(ventas: DataFrame | None) -> DataFrame | list[Column]:
    state = F.col("estado_linea")
    return _over(ventas, [
        F.count(F.lit(1)).alias("total_filas"),
        _n(state == DUPLICATE_STATE, "filas_duplicado"),
        _n(state == "ACTIVO", "filas_activo"),
        _n(~state.isin("ACTIVO", DUPLICATE_STATE), "filas_estado_invalido"),
        _share(state == DUPLICATE_STATE, "pct_duplicado"),
    ])


def v02_suffix(ventas: DataFrame | None) -> DataFrame | list[Column]:
    state = F.col("estado_linea")
    marked = F.col("id_linea_venta").cast("string").endswith(DUPLICATE_SUFFIX)
    return _over(ventas, [
        _n((state == DUPLICATE_STATE) & marked, "duplicados_con_sufijo_dup"),
        _n((state == DUPLICATE_STATE) & ~marked, "duplicados_sin_sufijo_dup"),
        _n((state == "ACTIVO") & marked, "activos_con_sufijo_dup"),
    ])


def v03_ranges(ventas: DataFrame | None) -> DataFrame | list[Column]:
    off, active = F.col("descuento_pct").cast("double"), F.col("estado_linea") == "ACTIVO"
    return _over(ventas, [
        _n(active & (F.col("cantidad_vendida").cast("bigint") <= 0), "cant_vendida_cero_o_neg"),
        _n(active & (F.col("precio_unitario_soles").cast("double") <= 0), "precio_unitario_cero_o_neg"),
        _n(active & (F.col("precio_lista_soles").cast("double") <= 0), "precio_lista_cero_o_neg"),
        _n(active & (F.col("ventas_netas_soles").cast("double") < 0), "ventas_netas_negativas"),
        _n(active & ((off < 0) | (off > 100)), "descuento_pct_fuera_rango"),
    ])


# -- dispatches -----------------------------------------------------------------------


def v04_null_rates(fill_rate: DataFrame | None) -> DataFrame | list[Column]:
    rejected = F.col("flag_in_full").cast("bigint") == 0
    carrier, reason = F.col("transportista").isNull(), F.col("motivo_rechazo").isNull()
    return _over(fill_rate, [
        F.count(F.lit(1)).alias("total_filas"),
        _n(carrier, "transportista_null"),
        _share(carrier, "pct_transportista_null"),
        _n(rejected, "total_rechazos"),
        _n(rejected & reason, "motivo_rechazo_null_en_rechazos"),
        percent(F.count_if(rejected & reason), F.count_if(rejected), 2)
        .alias("pct_motivo_null_sobre_rechazos"),
    ])


def v05_otif(fill_rate: DataFrame | None) -> DataFrame | list[Column]:
    on = {c: F.col(c).cast("bigint") == 1 for c in ("flag_otif", "flag_on_time", "flag_in_full")}
    both = on["flag_on_time"] & on["flag_in_full"]
    return _over(fill_rate, [
        F.count(F.lit(1)).alias("total_filas"),
        _n(on["flag_otif"], "otif_positivos"),
        _n(both, "on_time_and_in_full"),
        _n(on["flag_otif"] & ~both, "otif_inconsistente"),
        _share(on["flag_otif"], "pct_otif"),
    ])


# -- stock ----------------------------------------------------------------------------


def v06_signs(inventario: DataFrame | None) -> DataFrame | list[Column]:
    stock = F.col("stock_disponible").cast("bigint")
    return _over(inventario, [
        F.count(F.lit(1)).alias("total_filas"),
        _n(stock < 0, "stock_negativo"),
        _n(stock == 0, "stock_cero"),
        _n(stock > 0, "stock_positivo"),
        _share(stock < 0, "pct_stock_negativo"),
    ])


def v07_adjustment_flag(inventario: DataFrame | None) -> DataFrame | list[Column]:
    negative = F.col("stock_disponible").cast("bigint") < 0
    flag = F.col("flag_ajuste_pendiente")
    return _over(inventario, [
        _n(negative, "stock_negativo_total"),
        _n(negative & (flag == "S"), "neg_con_flag_ajuste_s"),
        _n(negative & (flag == "N"), "neg_con_flag_ajuste_n"),
        _n(negative & flag.isNull(), "neg_con_flag_ajuste_null"),
    ])


# -- masters --------------------------------------------------------------------------


def v08_customer_nulls(clientes: DataFrame | None) -> DataFrame | list[Column]:
    return _over(clientes, [
        F.count(F.lit(1)).alias("total_clientes"),
        _n(F.col("direccion_fiscal").isNull(), "direccion_null"),
        _share(F.col("direccion_fiscal").isNull(), "pct_direccion_null"),
        _n(F.col("distrito").isNull(), "distrito_null"),
        _n(F.col("telefono").isNull(), "telefono_null"),
        _n(F.col("email_contacto").isNull(), "email_null"),
    ])


def cohort() -> Column:
    early = F.col("fecha_alta_sistema").cast("date") < F.lit("2022-01-01").cast("date")
    return F.when(early, "pre_2022").otherwise("2022_en_adelante").alias("cohorte")


def cohort_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total"),
        _n(F.col("direccion_fiscal").isNull(), "direccion_null"),
        _share(F.col("direccion_fiscal").isNull(), "pct_null"),
    ]


def v09_cohorts(clientes: DataFrame) -> DataFrame:
    return clientes.groupBy(cohort()).agg(*cohort_measures()).orderBy("cohorte")


def v10_duplicate_codes(productos: DataFrame | None) -> DataFrame | list[Column]:
    marked = F.col("cod_sap").cast("string").endswith(DUPLICATE_SUFFIX)
    return _over(productos, [
        F.count(F.lit(1)).alias("total_productos"),
        _n(marked, "cod_sap_con_dup"),
        _n(~marked, "cod_sap_limpio"),
    ])


def v11_duplicate_code_rows(productos: DataFrame) -> DataFrame:
    return (
        productos.where(F.col("cod_sap").cast("string").endswith(DUPLICATE_SUFFIX))
        .select("id_producto_raw", "cod_sku", "cod_sap", "nombre_sku", "estado_producto")
        .orderBy("cod_sap")
    )


def v12_promotion_ids(promociones: DataFrame | None) -> DataFrame | list[Column]:
    sap = F.col("id_promocion_sap")
    odd = sap.isNotNull() & ~sap.rlike(r"^\d{8,10}\z")
    return _over(promociones, [
        F.count(F.lit(1)).alias("total_promociones"),
        _n(sap.isNull(), "id_sap_null"),
        _share(sap.isNull(), "pct_id_sap_null"),
        _n(sap.isNotNull(), "id_sap_presente"),
        _n(odd, "id_sap_formato_no_estandar"),
        _share(odd, "pct_formato_no_estandar"),
    ])


# -- targets, returns, promotion spend ----------------------------------------------------


def v13_versions(metas: DataFrame | None) -> DataFrame | list[Column]:
    approved = F.col("es_version_aprobada").cast("bigint")
    return _over(metas, [
        F.count(F.lit(1)).alias("total_filas"),
        _n(approved == 1, "filas_aprobadas"),
        _n(approved == 0, "filas_no_aprobadas"),
        F.count_distinct("version_meta").alias("versiones_distintas"),
    ])


def version_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("filas"),
        _n(F.col("es_version_aprobada").cast("bigint") == 1, "aprobadas"),
        _n(F.col("aprobado_por").isNull(), "sin_aprobador"),
        _n(F.col("fecha_aprobacion").isNull(), "sin_fecha_aprobacion"),
    ]


def v14_by_version(metas: DataFrame) -> DataFrame:
    return metas.groupBy("version_meta").agg(*version_measures()).orderBy("version_meta")


def return_measures() -> list[Column]:
    """``total_filas`` counts the rows of the state, as its twin ``filas_estado`` does."""
    return [
        F.count(F.lit(1)).alias("total_filas"),
        F.count(F.lit(1)).alias("filas_estado"),
        _n(F.col("num_nota_credito").isNull(), "nota_credito_null"),
        _n(F.col("fecha_aprobacion_dev").isNull(), "fecha_aprobacion_null"),
    ]


def v15_return_states(devoluciones: DataFrame) -> DataFrame:
    return devoluciones.groupBy("estado_devolucion").agg(*return_measures()).orderBy("estado_devolucion")


def v16_orphan_promotions(inversion: DataFrame, promociones: DataFrame) -> DataFrame:
    """Spend rows without a promotion, counted as the row-level left join would.

    Both sides are counted per key first; a key repeated on the right multiplies
    the rows of the left, which here is a multiplication instead of a fan-out.
    """
    key = "id_promocion_tm"
    spend = inversion.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("id_promocion_sap").isNull()).alias("_sap"))
    known = promociones.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_p"))
    joined = spend.join(known, key, "left").withColumn("_x", F.coalesce("_p", F.lit(1)))
    n = F.col("_n") * F.col("_x")
    missing, orphan = F.col(key).isNull(), F.col("_p").isNull() & F.col(key).isNotNull()
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return joined.agg(
        whole(n).alias("total_inversiones"),
        whole(F.when(missing, n)).alias("inv_sin_id_tm"),
        whole(F.col("_sap") * F.col("_x")).alias("inv_sin_id_sap"),
        whole(F.when(orphan, n)).alias("id_tm_sin_match_en_promociones"),
    )


# What counts as the known extent of each problem, for the summary. A
# number is an exact row count, a pair a range of the share of rows.
KNOWN_PROBLEMS = {
    "ventas": 3998,
    "fill_rate": (0.07, 0.09),
    "inventario": 1640,
    "clientes": 27,
    "productos": 2,
    "promociones": (0.22, 0.25),
    "metas": (216, 655),  # approved rows, all rows
}


def v17_summary(raw: Callable[[str], DataFrame], known: Mapping = KNOWN_PROBLEMS) -> DataFrame:
    """One row per dataset: problem rows, their share, and whether that was expected."""
    problems = {
        "ventas": (F.col("estado_linea") == DUPLICATE_STATE, "estado_linea = DUPLICADO"),
        "fill_rate": (F.col("transportista").isNull(), "transportista IS NULL"),
        "inventario": (F.col("stock_disponible").cast("bigint") < 0, "stock_disponible < 0"),
        "clientes": (F.col("direccion_fiscal").isNull(), "direccion_fiscal IS NULL"),
        "productos": (F.col("cod_sap").cast("string").endswith(DUPLICATE_SUFFIX),
                      "cod_sap con sufijo _DUP"),
        "promociones": (F.col("id_promocion_sap").isNull(), "id_promocion_sap IS NULL"),
        # a NULL approval is a draft as well
        "metas": (~F.coalesce(F.col("es_version_aprobada").cast("bigint") == 1, F.lit(False)),
                  "es_version_aprobada != 1 (borradores)"),
    }
    rows = []
    for name, (problem, text) in problems.items():
        counts = raw(name).agg(F.count(F.lit(1)).alias("filas_raw"), _n(problem, "filas_problema"))
        bad, every = F.col("filas_problema"), F.col("filas_raw")
        want = known[name]
        if name == "metas":
            fine = (every - bad == want[0]) & (every == want[1])
        elif isinstance(want, tuple):
            fine = (bad / F.nullif(every, F.lit(0))).between(*want)
        else:
            fine = bad == want
        rows.append(counts.select(
            F.lit(name).alias("dataset"), every, bad,
            percent(bad, every, 2).alias("pct_problema"),
            F.lit(text).alias("descripcion_problema"),
            F.when(fine, "OK_ESPERADO").otherwise("REVISAR").alias("semaforo"),
        ))
    return stack(rows).orderBy(F.desc("pct_problema"), "dataset")


# The tag each check carries in its first column.
TAGS = {
    "V01": "V01_ventas_conteo_estado",
    "V02": "V02_ventas_sufijo_dup",
    "V03": "V03_ventas_consistencia_numerica",
    "V04": "V04_fill_rate_nulls",
    "V05": "V05_fill_rate_flags_otif",
    "V06": "V06_inventario_stock_negativo",
    "V07": "V07_inventario_flag_ajuste",
    "V08": "V08_clientes_direccion_null",
    "V09": "V09_clientes_direccion_null_por_cohorte",
    "V10": "V10_productos_cod_sap_dup",
    "V11": "V11_productos_dup_detalle",
    "V12": "V12_promociones_id_sap_nulls",
    "V13": "V13_metas_versiones",
    "V14": "V14_metas_dist_version",
    "V15": "V15_devoluciones_nota_credito",
    "V16": "V16_inversion_orphan_keys",
    "V17": "V17_RESUMEN",
}


def checks(raw: Callable[[str], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """All seventeen raw checks by id, tagged; each runs when called."""
    plain = {
        "V01": lambda: v01_state_counts(raw("ventas")),
        "V02": lambda: v02_suffix(raw("ventas")),
        "V03": lambda: v03_ranges(raw("ventas")),
        "V04": lambda: v04_null_rates(raw("fill_rate")),
        "V05": lambda: v05_otif(raw("fill_rate")),
        "V06": lambda: v06_signs(raw("inventario")),
        "V07": lambda: v07_adjustment_flag(raw("inventario")),
        "V08": lambda: v08_customer_nulls(raw("clientes")),
        "V09": lambda: v09_cohorts(raw("clientes")),
        "V10": lambda: v10_duplicate_codes(raw("productos")),
        "V11": lambda: v11_duplicate_code_rows(raw("productos")),
        "V12": lambda: v12_promotion_ids(raw("promociones")),
        "V13": lambda: v13_versions(raw("metas")),
        "V14": lambda: v14_by_version(raw("metas")),
        "V15": lambda: v15_return_states(raw("devoluciones")),
        "V16": lambda: v16_orphan_promotions(raw("inversion_promocional"), raw("promociones")),
        "V17": lambda: v17_summary(raw),
    }
    return {
        check: lambda check=check, make=make: make().select(F.lit(TAGS[check]).alias("validacion"), "*")
        for check, make in plain.items()
    }


# Expected measures of the published data set.
EXPECTED: dict[str, dict[str, int]] = {
    "V01": {"total_filas": 503998, "filas_duplicado": 3998, "filas_activo": 500000},
    "V02": {"duplicados_con_sufijo_dup": 3998, "duplicados_sin_sufijo_dup": 0},
    "V03": {"cant_vendida_cero_o_neg": 0, "precio_unitario_cero_o_neg": 0,
            "ventas_netas_negativas": 0},
    "V05": {"otif_inconsistente": 0},
    "V06": {"stock_negativo": 1640},
    "V07": {"neg_con_flag_ajuste_n": 0, "neg_con_flag_ajuste_null": 0},
    "V08": {"total_clientes": 300, "direccion_null": 27},
    "V10": {"total_productos": 78, "cod_sap_con_dup": 2},
    "V12": {"id_sap_null": 50},
    "V13": {"total_filas": 655, "filas_aprobadas": 216},
    "V16": {"id_tm_sin_match_en_promociones": 0},
}

_INTEGER_TEXT = r"^\s*[+-]?\d+\s*\z"


def _measures(check: str, df: DataFrame) -> DataFrame:
    """First row of a check as (check_id, campo, valor); text counts only if it is an integer."""
    cells = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            number = value.cast("double")
        else:
            text = value.cast("string")
            number = F.when(text.rlike(_INTEGER_TEXT), F.trim(text).try_cast("double"))
        cells.append(F.struct(F.lit(f.name).alias("campo"), number.alias("valor")))
    return df.limit(1).select(F.lit(check).alias("check_id"), F.inline(F.array(*cells)))


def _truncated(c: Column) -> Column:
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("bigint")


def score(measured: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Grade every check: the first expected field that is off decides its status."""
    spark = next(iter(measured.values())).sparkSession
    listed = spark.createDataFrame([(c,) for c in measured], "check_id string")
    wanted = spark.createDataFrame(
        [(c, i, field, int(value)) for c, fields in expected.items()
         for i, (field, value) in enumerate(fields.items())],
        "check_id string, orden int, campo string, esperado bigint",
    )
    graded = {c: df for c, df in measured.items() if c in expected}
    if not graded:
        return listed.select("check_id", F.lit("INFO").alias("estado"))
    values = stack(_measures(c, df) for c, df in graded.items())
    with_rows = values.select("check_id").distinct().withColumn("_row", F.lit(True))
    found = (
        wanted.join(listed, "check_id", "left_semi")
        .join(values, ["check_id", "campo"], "left")
        .join(with_rows, "check_id", "left")
    )
    grade = (
        F.when(F.col("_row").isNull(), "FAIL")
        .when(F.col("valor").isNull(), "WARN")
        .when(_truncated(F.col("valor")) != F.col("esperado"), "FAIL")
    )
    first_off = found.withColumn("_g", grade).groupBy("check_id").agg(
        F.min(F.when(F.col("_g").isNotNull(), F.struct("orden", "_g"))).alias("_off"))
    return listed.join(first_off.withColumn("_graded", F.lit(True)), "check_id", "left").select(
        "check_id",
        F.when(F.col("_graded").isNull(), "INFO")
        .otherwise(F.coalesce(F.col("_off._g"), F.lit("PASS"))).alias("estado"),
    )


def run_checks(
    spark: SparkSession,
    todo: Mapping[str, Callable[[], DataFrame]],
    expected: Mapping[str, Mapping[str, int]],
    only: str | None = None,
) -> DataFrame:
    """Run checks one by one, so that one failing query does not stop the others."""
    rows = []
    for check, make in todo.items():
        if only and check != only:
            continue
        try:
            graded = score({check: make()}, expected).first()
            rows.append((check, graded["estado"], None))
        except Exception as error:  # the report is the place for any failure
            rows.append((check, "ERROR", str(error)[:1024]))
    return spark.createDataFrame(rows, "check_id string, estado string, detalle string")


def tally(scored: DataFrame) -> DataFrame:
    return scored.groupBy("estado").agg(F.count(F.lit(1)).alias("checks"))


def failed(scored: DataFrame) -> bool:
    return not scored.where(F.col("estado").isin("FAIL", "ERROR")).isEmpty()


# -- source profiling rules -------------------------------------------------------------


def _rule(rule: str, counts: DataFrame, affected: str, total: str, word: str) -> DataFrame:
    return counts.select(
        F.lit(rule).alias("regla"),
        F.when(F.col(affected) > 0, word).otherwise("OK").alias("estado"),
        F.col(affected).alias("afectados"),
        F.col(total).alias("total"),
    )


def profile_sales(ventas: DataFrame) -> DataFrame:
    """Rows by state, and rows sharing invoice and line id, from one grouping."""
    state = F.col("estado_linea")
    per_key = ventas.groupBy("num_factura", "id_linea_venta").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(state == DUPLICATE_STATE).alias("_d"),
        F.count_if(state == "ACTIVO").alias("_a"),
    )
    n = F.col("_n")
    whole = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    return per_key.agg(
        whole(n, "total"), whole(F.col("_d"), "marcados"),
        whole(F.when(n > 1, n), "llave_repetida"), whole(F.col("_a"), "tras_filtro"),
    )


def profile_stock(inventario: DataFrame) -> DataFrame:
    stock = F.col("stock_disponible")
    return inventario.agg(
        F.count(F.lit(1)).alias("total"), _n(stock < 0, "negativos"), _n(stock >= 0, "tras_filtro"))


def stock_sample(inventario: DataFrame, n: int = 5) -> DataFrame:
    """A few offending rows, in a fixed order so that the sample is repeatable."""
    columns = ["id_snapshot_inv", "fecha_snapshot", "id_almacen", "stock_disponible",
               "motivo_ajuste"]
    return inventario.where(F.col("stock_disponible") < 0).select(*columns).orderBy(
        "fecha_snapshot", "id_snapshot_inv", *columns[2:]).limit(n)


def profile_promotions(promociones: DataFrame, inversion: DataFrame) -> DataFrame:
    sap, tm = F.col("id_promocion_sap"), F.col("id_promocion_tm")
    spent = inversion.where(~is_missing(tm))
    lonely = key_difference(promociones, spent, "id_promocion_tm")
    return combined([
        promociones.agg(F.count(F.lit(1)).alias("total_promociones"),
                        _n(is_missing(sap), "promociones_sin_sap")),
        inversion.agg(F.count(F.lit(1)).alias("total_inversiones"),
                      _n(is_missing(sap), "inversiones_sin_sap"),
                      _n(is_missing(tm), "inversiones_sin_tm")),
        lonely.agg(F.count(F.lit(1)).alias("tm_solo_en_promociones")),
    ])


def profile_dispatches(fill_rate: DataFrame) -> DataFrame:
    reason, carrier = F.col("motivo_rechazo"), F.col("transportista")
    rejected = (
        F.col("cantidad_rechazada_uds") > 0
        if "cantidad_rechazada_uds" in fill_rate.columns else F.lit(True)
    )
    imputed = lambda c: fill_missing(c, UNSPECIFIED, empty_is_null=True) == UNSPECIFIED
    return fill_rate.agg(
        F.count(F.lit(1)).alias("total"),
        _n(is_missing(reason), "motivo_vacio"),
        _n(is_missing(carrier), "transportista_vacio"),
        _n(rejected, "rechazados"),
        _n(rejected & is_missing(reason), "rechazados_sin_motivo"),
        _n(imputed(reason), "motivo_imputado"),
        _n(imputed(carrier), "transportista_imputado"),
    )


def profile_customers(clientes: DataFrame, before: str = "2023-01-01") -> DataFrame:
    """Inactive customers, and those closed before a date; unreadable dates do not count."""
    closed = F.try_to_timestamp(F.col("fecha_baja_sistema").cast("string"))
    inactive = F.col("estado_cliente") == "INACTIVO"
    return clientes.agg(
        F.count(F.lit(1)).alias("total"),
        _n(inactive, "inactivos_total"),
        _n(inactive & (closed < F.lit(before).cast("timestamp")), "inactivos_antes"),
    )


def profile_summary(raw: Callable[[str], DataFrame]) -> DataFrame:
    rows = [
        _rule("VQ-01", profile_sales(raw("ventas")), "marcados", "total", "FALLA"),
        _rule("VQ-02", profile_stock(raw("inventario")), "negativos", "total", "FALLA"),
        _rule("VQ-03", profile_promotions(raw("promociones"), raw("inversion_promocional")),
              "promociones_sin_sap", "total_promociones", "FALLA"),
        _rule("VQ-04", profile_dispatches(raw("fill_rate")), "transportista_vacio", "total",
              "FALLA"),
        _rule("VQ-05", profile_customers(raw("clientes")), "inactivos_antes", "total",
              "ADVERTENCIA"),
    ]
    return stack(rows).withColumn("pct", percent("afectados", "total", 1)).orderBy("regla")
