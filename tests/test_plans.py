"""Cells and their changes, bitmaps, least squares, components, the run of checks, classifier metrics."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from retaloom.medallion import from_standins
from retaloom.plans import cells, checkrun, distinct, forecast, panel, regress, series
from retaloom.queries import QUERIES
from retaloom.queries.registry import plain
from retaloom.sources import commits
from retaloom.streaming import refresh


def jobs(spark, make):
    """Jobs that start while ``make`` builds a frame."""
    spark.sparkContext.setJobGroup("build", "build")
    try:
        made = make()
        return made, len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# -- cells ---------------------------------------------------------------------------------

SHAPE = cells.Shape(("id_fecha", "k"), ("v",))


def facts(spark, rows):
    made = [(d, k, None if v is None else Decimal(v), s) for d, k, v, s in rows]
    return spark.createDataFrame(made, "id_fecha int, k int, v decimal(18,2), signo int")


def listed(df):
    return sorted((r.id_fecha, r.k, r.v, r.filas) for r in cells.as_fact(df, SHAPE).collect())


def test_changes_of_cells_equal_counting_anew(spark):
    rng = random.Random(3)
    rows = [(20240100 + 100 * rng.randrange(3) + 1, rng.randrange(4), None if rng.random() < .3 else rng.randrange(50), 1)
            for _ in range(60)]
    old, gone, new = rows[:40], rows[10:25], rows[40:]
    stored = cells.cells(facts(spark, old).drop("signo"), SHAPE)
    change = cells.cells(facts(spark, [(*r[:3], -1) for r in gone] + new), SHAPE)
    now = cells.cells(facts(spark, old[:10] + old[25:] + new).drop("signo"), SHAPE)
    assert listed(cells.merged(stored, change, SHAPE)) == listed(now)


def test_cells_that_lose_their_rows_go_and_values_become_null(spark):
    stored = cells.cells(facts(spark, [(20240101, 1, 5, 1), (20240101, 2, 5, 1), (20240101, 2, None, 1)]).drop("signo"), SHAPE)
    change = cells.cells(facts(spark, [(20240101, 1, 5, -1), (20240101, 2, 5, -1)]), SHAPE)
    assert listed(cells.merged(stored, change, SHAPE)) == [(20240101, 2, None, 1)]


def test_only_touched_months_are_read_and_written_once(spark, tmp_path):
    path = str(tmp_path / "cells")
    rows = [(20240000 + 100 * m + 1, 1, m, 1) for m in range(1, 7)]
    refresh.store_cube(cells.cells(facts(spark, rows).drop("signo"), SHAPE), path)
    before = commits.latest(spark, path)
    change = cells.cells(facts(spark, [(20240201, 1, 10, 1), (20240501, 1, 5, -1)]), SHAPE)
    for _ in range(3):
        assert sorted(refresh.refresh_cells(spark, path, change, SHAPE, "a")) == [202402, 202405]
    after = commits.latest(spark, path)
    assert after.number == before.number + 1
    changed = {k for k in before.parts if before.parts[k] != after.parts.get(k)}
    assert changed == {"periodo=202402", "periodo=202405"} and "periodo=202405" not in after.parts
    assert [r[2] for r in listed(commits.read(spark, path))] == [1, 12, 3, 4, 6]
    text = spark._jvm.PythonSQLUtils.explainString(
        commits.read(spark, path).where(F.col("periodo").isin([202402]))._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(periodo" in text


def test_late_returns_reach_every_line_of_their_key(spark):
    keys = "id_fecha int, id_canal int, id_geografia int, id_producto int, id_vendedor int, num_factura int"
    lines = spark.createDataFrame([(20240105, 1, 1, 7, 1, 10), (20240207, 1, 1, 7, 1, 10), (20240105, 1, 1, 8, 1, 10)], keys)
    late = spark.createDataFrame([(10, 7, 2, 3.5, 1), (10, 7, 1, 1.5, 1), (99, 7, 5, 5.0, 1)],
                                 "num_factura_origen int, id_producto int, cantidad_devuelta int, "
                                 "monto_devolucion_soles double, signo int")
    got = cells.cells(cells.returns_change(lines, late), cells.SALES).collect()
    assert sorted((r.id_fecha, r.id_producto, r.unidades_devueltas, float(r.monto_devuelto_soles), r.filas) for r in got) == [
        (20240105, 7, 3, 5.0, 0), (20240207, 7, 3, 5.0, 0)]


# -- bitmaps -------------------------------------------------------------------------------

def test_bitmaps_of_two_loads_count_once(spark, folder):
    m = from_standins(spark, folder)
    column, near = distinct.CUSTOMER
    fact = m.fact("ventas")
    first = m.with_fact("ventas", fact.where("id_fecha < 19980101"))
    second = m.with_fact("ventas", fact.where("id_fecha >= 19970101"))  # a year comes twice
    known = distinct.numbers(first.fact("ventas"), column, near)
    every = distinct.numbers(fact, column, near, known)
    n = every.count()
    assert sorted(r[0] for r in every.select(distinct.NUMBER).collect()) == list(range(1, n + 1))
    assert known.join(every, [column, distinct.NUMBER]).count() == known.count()
    parts = [distinct.bitmaps(s, column, every) for s in (first, second)]
    got = distinct.count_at(distinct.merged(parts), [[], ["nombre_canal"]], "n")
    want = {None: fact.select(column).distinct().count()}
    names = {r.id_canal: r.nombre_canal for r in m.dim("canal").collect()}
    for r in fact.groupBy("id_canal").agg(F.count_distinct(column).alias("n")).collect():
        want[names[r.id_canal]] = r.n
    assert {r.nombre_canal: r.n for r in got.collect()} == want


def test_no_two_tasks_make_bitmaps_of_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(distinct, "TASK_BYTES", distinct.MAP_BYTES)
    rows = [(m, t, t and t + "1", d, n) for n in range(1, 70001, 700)
            for m, t, d in (("2000-01", "a", "x"), ("2000-02", None, "x"), ("2000-01", "b", None))[:1 + n % 3]]
    cells = spark.createDataFrame(rows, f"{', '.join(f'{c} string' for c in distinct.LEVELS)}, n int")
    cells = cells.groupBy(*distinct.LEVELS, F.bitmap_bucket_number("n").alias(distinct.BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias(distinct.MAP))
    sets = [[], ["anio_mes"], ["tipo_canal", "nombre_canal"], distinct.LEVELS]
    got = distinct.count_at(cells, sets, "n")
    want = Counter()
    for s in sets:
        level = sum(1 << i for i, c in enumerate(reversed(distinct.LEVELS)) if c not in s)
        kept = lambda r: tuple(v if c in s else None for c, v in zip(distinct.LEVELS, r))
        want.update((*k, level) for k, _ in {(kept(r), r[-1]) for r in rows})
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    folds = [i for i, line in enumerate(plan) if "partial_bitmap_or_agg" in line]
    assert len(folds) == len(sets) and not any("Expand" in line for line in plan)
    assert all("bitmap_or_agg" in plan[i - 1] for i in folds)  # the whole one, without a shuffle in between
    assert {tuple(r[:-1]): r.n for r in got.collect()} == want


def test_rows_of_a_bucket_meet_before_its_bitmap_is_made(spark, folder):
    m = from_standins(spark, folder)
    column, near = distinct.INVOICE
    cells = distinct.bitmaps(m, column, distinct.numbers(m.fact("ventas"), column, near))
    plan = cells._jdf.queryExecution().executedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(plan) if "partial_bitmap_construct_agg" in line)
    assert "bitmap_construct_agg" in plan[made - 1]  # the whole one, without a shuffle in between


# -- least squares and components --------------------------------------------------------------

def test_coefficients_equal_least_squares(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 3)), 4)
    y = np.round(x @ [2.0, -1.0, 0.5] + 7 + rng.normal(size=300) * .01, 4)
    rows = [(i % 2, float(a), float(b), float(c), float(v)) for i, ((a, b, c), v) in enumerate(zip(x, y))]
    rows.append((0, None, 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "k int, a double, b double, c double, y double").repartition(7)
    d = lambda c: F.col(c).cast("decimal(12,4)")
    columns = {"one": F.lit(1).cast("decimal(1,0)"), "a": d("a"), "b": d("b"), "c": d("c"), "again": d("b")}
    for r in regress.fit(df, "k", columns, d("y")).collect():
        mine = np.arange(300) % 2 == r.k
        want = np.linalg.lstsq(np.column_stack([np.ones(mine.sum()), x[mine]]), y[mine], rcond=None)[0]
        assert np.allclose(r.coef[:4], want, atol=1e-9) and r.coef[4] == 0.0 and r.n == 150


def daily(spark, values, special=()):
    start = dt.date(2023, 1, 2)
    rows = [(1, start + dt.timedelta(days=i), float(v), int(i in special)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id_canal bigint, ds date, ventas_netas_soles double, es_feriado int")


def parts(df):
    rows = series.components(df).orderBy("ds").collect()
    for r in rows:
        assert sum(getattr(r, p) for p in series.PARTS) == r.valor
    return rows


def test_a_flat_series_has_no_parts(spark):
    for r in parts(daily(spark, [100] * 120, special={10})):
        assert (r.tendencia, r.estacionalidad, r.feriado, r.pico, r.escalon, r.residuo) == (100, 0, 0, 0, 0, 0)


def test_spikes_steps_and_holidays_are_told_apart(spark):
    rng = np.random.default_rng(1)
    y = 1000 + rng.normal(size=240) * 5
    y[60] += 400
    y[120:] += 300
    y[[30, 90, 150, 200]] += 80
    rows = parts(daily(spark, y, special={30, 90, 150, 200}))
    assert [i for i, r in enumerate(rows) if abs(r.pico) > 200] == [60]
    steps = [i for i in range(1, 240) if rows[i].escalon != rows[i - 1].escalon]
    assert len(steps) == 1 and abs(steps[0] - 120) <= 1 and abs(float(rows[-1].escalon) - 300) < 15
    assert 50 < float(rows[30].feriado) < 90 and rows[31].feriado == 0


def test_noise_alone_makes_no_step(spark):
    rng = np.random.default_rng(2)
    assert {r.escalon for r in parts(daily(spark, 1000 + rng.normal(size=400) * 30))} == {0}


def test_parts_of_the_days_ahead_mean_the_same(spark):
    history = daily(spark, [100 + 10 * (i % 7) for i in range(140)])
    predicted = spark.createDataFrame(
        [(1, dt.date(2023, 5, 22) + dt.timedelta(days=i), 200.0 + i, 190.0, 215.0) for i in range(14)],
        "id_canal bigint, forecast_timestamp date, forecast_value double, "
        "prediction_interval_lower_bound double, prediction_interval_upper_bound double")
    rows = forecast.explain(series.components(history), predicted).collect()
    past = {r.fecha.weekday(): r.estacionalidad for r in rows if r.tipo == "history"}
    for r in rows:
        total = r.tendencia + r.estacionalidad + r.feriado + r.pico + r.escalon + r.residuo
        assert abs(total - r.valor) < 1e-9
        assert (r.lim_inf is None) == (r.tipo == "history")
        if r.tipo == "forecast":
            assert r.estacionalidad == past[r.fecha.weekday()]


# -- checks and metrics ----------------------------------------------------------------------

def test_a_check_that_breaks_does_not_take_others_along(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "x int, s string")
    listed = {"t": [
        checkrun.Check("A", (F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))),
        checkrun.Check("B", (F.sum(F.col("s").cast("int")).alias("n"),)),  # fails while it runs
        checkrun.Check("C", (F.sum("no_column").alias("n"),)),
        checkrun.Check("D", (F.count(F.lit(1)).alias("n"),), F.col("s"))]}
    measures, errors = checkrun.run(spark, lambda name: rows, listed)
    assert set(errors) == {"B", "C"} and all(errors.values())
    assert sorted((r.check_id, r.grupo, r.campo, r.valor) for r in measures.collect() if r.grupo is None) == [
        ("A", None, "n", 2.0), ("A", None, "s", 3.0)]
    assert sorted((r.grupo, r.valor) for r in measures.where("grupo is not null").collect()) == [("a", 1.0), ("b", 1.0)]
    got = {r.check_id: r.estado for r in checkrun.report(measures, errors, "ABCDE", {"A": {"n": 2, "s": 4}, "E": {"n": 1}}).collect()}
    assert got == {"A": "FAIL", "B": "ERROR", "C": "ERROR", "D": "INFO", "E": "FAIL"}


def test_each_table_is_scanned_once(spark, folder):
    m = from_standins(spark, folder)
    for name, checks in checkrun.table_checks().items():
        text = spark._jvm.PythonSQLUtils.explainString(checkrun.fused(m.raw(name), checks)._jdf.queryExecution(), "simple")
        once = spark._jvm.PythonSQLUtils.explainString(m.raw(name)._jdf.queryExecution(), "simple")
        assert text.count("FileScan") == once.count("FileScan"), name


@pytest.mark.parametrize("n", [5, 4000])
def test_area_under_ties_and_weights(spark, n):
    rng = np.random.default_rng(n)
    s, y, w = np.round(rng.random(n), 2), rng.integers(0, 2, n), rng.integers(1, 4, n)
    y[:2] = 0, 1
    df = spark.createDataFrame([(float(a), int(b), float(c)) for a, b, c in zip(s, y, w)] + [(None, 1, 1.0), (0.5, None, 1.0)],
                               "s double, y int, w double").repartition(5)
    for weight, u in ((None, np.ones(n)), ("w", w)):
        row = panel.metrics(df, "y", "s", weight=weight).first()
        p, q = y == 1, y == 0
        wins = ((s[p][:, None] > s[q]) + 0.5 * (s[p][:, None] == s[q])) * u[p][:, None] * u[q]
        assert abs(row.roc_auc - wins.sum() / (u[p].sum() * u[q].sum())) < 1e-6
        assert (row.tp, row.tn) == (int((p & (s >= .5)).sum()), int((q & (s < .5)).sum()))


def test_metrics_of_nothing_and_of_one_class(spark):
    df = spark.createDataFrame([(0.7, 1)], "s double, y int")
    assert panel.metrics(df, "y", "s").first().roc_auc is None
    none = panel.metrics(df.where("false"), "y", "s").first()
    assert (none.tp, none.precision, none.roc_auc) == (0, 0.0, None)


def test_building_metrics_starts_no_job(spark):
    df = spark.range(10).selectExpr("id / 10 as s", "id % 2 as y")
    made, started = jobs(spark, lambda: panel.metrics(df, "y", "s"))
    assert started == 0 and made.count() == 1


@pytest.mark.parametrize("name", ["rec_calendar_gaps", "rec_calendar_keys"])
def test_damage_of_the_calendar_is_found(spark, folder, name):
    rows = QUERIES[name].run(spark, folder).collect()
    if name == "rec_calendar_keys":
        assert [(r.id_fecha, r.veces) for r in rows] == [(19990728, 2)]
    else:
        assert (dt.date(1998, 3, 10), dt.date(1998, 3, 14), 5) in {(r.desde, r.hasta, r.dias) for r in rows}


def test_sums_beyond_a_long_stay_whole(spark):
    day = dt.date(2000, 1, 1)
    rows = [(day + dt.timedelta(days=i), c, Decimal(big), Decimal("2.00"), 1)
            for c, big in ((1, "3000000000.50"), (2, "5.25")) for i in range(3)]
    daily = spark.createDataFrame(
        rows, "ds date, id_canal int, ventas_netas_soles decimal(28,2), inversion_promo decimal(28,2), es_feriado int")
    got = plain(series.whole_sums(series.regression_sums(daily)), series.SUMS)
    assert dict(got.dtypes)["s_yy"] == "decimal(38,0)" and dict(got.dtypes)["s_xy"] == "bigint"
    found = {r.id_canal: (int(r.s_yy), r.s_xy) for r in got.collect()}
    assert found == {1: (27000000009000000001, 18000000003), 2: (83, 32)}
    small = series.whole_sums(series.regression_sums(daily.where("id_canal = 2")))
    assert {t for c, t in small.dtypes if c.startswith("s_")} == {"bigint"}


def test_training_rows_are_spread_by_their_number(spark):
    rows = spark.range(4000).select(*[F.col("id").alias(c) for c in panel.KEYS]).coalesce(1)
    assert panel.spread(rows, 4000, per_task=4000).rdd.getNumPartitions() == 1
    spread = panel.spread(rows, 4000, per_task=100)
    assert spread.rdd.getNumPartitions() == 40
    assert max(spread.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 200
    assert spread.exceptAll(rows).isEmpty() and spread.count() == 4000
