"""The run of all raw checks: one aggregate per table, one report.

A check is a list of measures of one table, perhaps per group. All checks of a table are taken by one
aggregate, whose row is then unfolded to (check, group, field, value), so every raw table
is read once however many checks it has. The promotion keys of two tables meet in one full join of
their counts per key, which serves the check of each table and the check across them.

A check that fails must not take the others along. One whose columns are not there is
found before anything runs. If an aggregate fails while it runs, its checks are taken one by one,
and those that fail again are errors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retaloom.operators.joins import stack
from retaloom.plans import quality as q
from retaloom.plans.trusted import DUPLICATE_SUFFIX
from retaloom.session import as_table

MEASURES = "check_id string, grupo string, campo string, valor double"
STATES = ("PASS", "FAIL", "WARN", "INFO", "ERROR")
MESSAGE = 1024


@dataclass(frozen=True)
class Check:
    id: str
    measures: tuple[Column, ...]  # aliased
    by: Column | None = None


def _check(id: str, measures: Sequence[Column], by: Column | None = None) -> Check:
    return Check(id, tuple(measures), by)


def table_checks() -> dict[str, list[Check]]:
    marked = F.col("cod_sap").cast("string").endswith(DUPLICATE_SUFFIX)
    return {
        "ventas": [_check("V01", q.v01_state_counts(None)), _check("V02", q.v02_suffix(None)),
                   _check("V03", q.v03_ranges(None))],
        "fill_rate": [_check("V04", q.v04_null_rates(None)), _check("V05", q.v05_otif(None))],
        "inventario": [_check("V06", q.v06_signs(None)), _check("V07", q.v07_adjustment_flag(None))],
        "clientes": [_check("V08", q.v08_customer_nulls(None)), _check("V09", q.cohort_measures(), q.cohort())],
        "productos": [_check("V10", q.v10_duplicate_codes(None)),
                      _check("V11", [F.count_if(marked).alias("filas")])],
        "metas": [_check("V13", q.v13_versions(None)),
                  _check("V14", q.version_measures(), F.col("version_meta"))],
        "devoluciones": [_check("V15", q.return_measures(), F.col("estado_devolucion"))],
    }


def fused(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Measures of all checks from one pass over the frame."""
    groups = {c.id: f"_by_{c.id}" for c in checks if c.by is not None}
    given = df.withColumns({groups[c.id]: c.by.cast("string") for c in checks if c.by is not None})
    names = {c.id: df.agg(*c.measures).columns for c in checks}
    made = [m.cast("double").alias(f"{c.id}|{n}") for c in checks for m, n in zip(c.measures, names[c.id])]
    sets = ([[]] if any(c.by is None for c in checks) else []) + [[F.col(g)] for g in groups.values()]
    if groups:
        one = given.groupingSets(sets, *[F.col(g) for g in groups.values()]).agg(F.grouping_id().alias("_set"), *made)
    else:
        one = given.agg(F.lit(0).alias("_set"), *made)
    every = (1 << len(groups)) - 1
    which = {c.id: every for c in checks}  # bits of the groups that a row is not by
    which.update({c: every & ~(1 << (len(groups) - 1 - i)) for i, c in enumerate(groups)})
    cells = [
        F.when(F.col("_set") == which[c.id], F.struct(
            F.lit(c.id).alias("check_id"),
            (F.col(groups[c.id]) if c.id in groups else F.lit(None).cast("string")).alias("grupo"),
            F.lit(n).alias("campo"), F.col(f"`{c.id}|{n}`").alias("valor")))
        for c in checks for n in names[c.id]]
    return one.select(F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))


def promotions(inversion: DataFrame, promociones: DataFrame) -> DataFrame:
    """Measures of V12 and V16: both tables counted per key once, then joined."""
    key = "id_promocion_tm"
    count = lambda name: F.count(F.lit(1)).alias(name)
    sap = F.col("id_promocion_sap")
    odd = sap.isNotNull() & ~sap.rlike(r"^\d{8,10}\z")
    promos = promociones.groupBy(key).agg(
        count("_p"), F.count_if(sap.isNull()).alias("_p_null"), F.count_if(odd).alias("_p_odd"))
    spend = inversion.groupBy(key).agg(count("_n"), F.count_if(sap.isNull()).alias("_n_null"))
    both = spend.join(promos, key, "full")
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
    times = F.coalesce("_p", F.lit(1))
    n, lonely = F.col("_n") * times, F.col("_p").isNull() & F.col(key).isNotNull()
    total = whole(F.col("_p"))
    share = lambda c: q.percent(c, total, 2)
    measures = {
        ("V12", "total_promociones"): total, ("V12", "id_sap_null"): whole(F.col("_p_null")),
        ("V12", "pct_id_sap_null"): share(whole(F.col("_p_null"))),
        ("V12", "id_sap_presente"): whole(F.col("_p") - F.col("_p_null")),
        ("V12", "id_sap_formato_no_estandar"): whole(F.col("_p_odd")),
        ("V12", "pct_formato_no_estandar"): share(whole(F.col("_p_odd"))),
        ("V16", "total_inversiones"): whole(n), ("V16", "inv_sin_id_tm"): whole(F.when(F.col(key).isNull(), n)),
        ("V16", "inv_sin_id_sap"): whole(F.col("_n_null") * times),
        ("V16", "id_tm_sin_match_en_promociones"): whole(F.when(lonely, n)),
    }
    one = both.agg(*[c.alias("|".join(name)) for name, c in measures.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check_id"), F.lit(None).cast("string").alias("grupo"),
                 F.lit(field).alias("campo"), F.col(f"`{check}|{field}`").alias("valor"))
        for check, field in measures])))


def run(spark: SparkSession, raw: Callable[[str], DataFrame],
        checks: Mapping[str, Sequence[Check]] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Takes all checks; gives their measures, stored, and the checks that failed with the reason."""
    found, errors = [], {}

    def take(label: str, make: Callable[[], DataFrame]) -> str | None:
        try:
            found.append(as_table(make(), f"checks-{label}"))
            return None
        except Exception as error:  # the report is the place for any failure
            return str(error)[:MESSAGE]

    for table, listed in (checks or table_checks()).items():
        df, sound = raw(table), []
        for check in listed:
            try:
                fused(df, [check]).schema
                sound.append(check)
            except Exception as error:
                errors[check.id] = str(error)[:MESSAGE]
        if sound and take(table, lambda: fused(df, sound)):
            for check in sound:
                reason = take(check.id, lambda: fused(df, [check]))
                if reason:
                    errors[check.id] = reason
    if checks is None or "promociones" in checks:
        reason = take("promociones", lambda: promotions(raw("inversion_promocional"), raw("promociones")))
        if reason:
            errors.update({"V12": reason, "V16": reason})
    measures = stack(found) if found else spark.createDataFrame([], MEASURES)
    return measures.select("check_id", "grupo", "campo", "valor"), errors


def report(measures: DataFrame, errors: Mapping[str, str], listed: Sequence[str],
           expected: Mapping[str, Mapping[str, int]] = q.EXPECTED) -> DataFrame:
    """check_id, etiqueta, estado, detalle for every check of the list.

    FAIL: an expected field is off, or the check gave no row. WARN: an expected field is not there.
    The first field, in the order of the expectations, that is not as expected decides.
    """
    spark = measures.sparkSession
    wanted = [(c, i, f, int(v)) for c, fields in expected.items() for i, (f, v) in enumerate(fields.items())]
    wanted = spark.createDataFrame(wanted, "check_id string, orden int, campo string, esperado bigint")
    known = spark.createDataFrame([(c, q.TAGS.get(c, c), errors.get(c)) for c in listed],
                                  "check_id string, etiqueta string, detalle string")
    values = measures.where(F.col("grupo").isNull())
    there = measures.select("check_id").distinct().withColumn("_there", F.lit(True))
    graded = (
        wanted.join(values.select("check_id", "campo", "valor"), ["check_id", "campo"], "left")
        .join(there, "check_id", "left")
        .withColumn("_g", F.when(F.col("_there").isNull(), "FAIL").when(F.col("valor").isNull(), "WARN")
                    .when(q._truncated(F.col("valor")) != F.col("esperado"), "FAIL"))
        .groupBy("check_id").agg(F.min(F.when(F.col("_g").isNotNull(), F.struct(
            "orden", "_g", "campo", "valor", "esperado"))).alias("_off")).withColumn("_graded", F.lit(True)))
    off = F.concat_ws(" ", F.col("_off.campo"), F.coalesce(F.col("_off.valor").cast("bigint").cast("string"), F.lit("-")),
                      F.lit("!="), F.col("_off.esperado").cast("string"))
    return known.join(graded, "check_id", "left").select(
        "check_id", "etiqueta",
        F.when(F.col("detalle").isNotNull(), "ERROR").when(F.col("_graded").isNull(), "INFO")
        .otherwise(F.coalesce(F.col("_off._g"), F.lit("PASS"))).alias("estado"),
        F.coalesce("detalle", F.when(F.col("_off").isNotNull(), off)).alias("detalle"))


def tally(reported: DataFrame) -> DataFrame:
    """Checks per state, states without any included."""
    states = reported.sparkSession.createDataFrame([(s,) for s in STATES], "estado string")
    return states.join(reported, "estado", "left").groupBy("estado").agg(F.count("check_id").alias("checks"))
