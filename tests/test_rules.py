"""Cleaning, keys, calendar and checks on hand-written dirty rows."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retaloom.functions import dates, numbers, text
from retaloom.operators import joins
from retaloom.plans import calendar, curated, forecast, kpis, quality, segment, series, trusted

D = dt.date


def one(df):
    return [tuple(r) for r in df.collect()]


def test_sales_cleaning(spark):
    raw = spark.createDataFrame(
        [("1-1", "ACTIVO", D(2024, 1, 1)), ("1-2_DUP", "DUPLICADO", D(2024, 1, 1)),
         ("1-3", None, D(2024, 1, 1)), ("1-4_DUP", "ACTIVO", D(2024, 1, 1)),
         ("1_DUP-5", "ACTIVO", D(2024, 1, 1))],
        "id_linea_venta string, estado_linea string, fecha_carga date")
    out = trusted.ventas(raw)
    assert out.columns == ["estado_linea", "id_linea_venta", "fecha_carga_raw"]
    assert sorted(r.id_linea_venta for r in out.collect()) == ["1-1", "1-4", "1_DUP-5"]


def test_suffix_is_kept_before_a_line_break(spark):
    df = spark.createDataFrame([("a_DUP\n",), ("a_DUP",), (None,)], "c string")
    assert one(df.select(text.strip_suffix(F.col("c"), "_DUP"))) == [("a_DUP\n",), ("a",), (None,)]


def test_stock_cleaning_drops_negative_and_null(spark):
    raw = spark.createDataFrame([(-1,), (0,), (None,), (5,)], "stock_disponible bigint")
    assert sorted(one(trusted.inventario(raw))) == [(0,), (5,)]


@pytest.mark.parametrize("empty_is_null,expected", [(False, ["", "No especificado", "T"]),
                                                    (True, ["No especificado"] * 2 + ["T"])])
def test_carrier_imputation(spark, empty_is_null, expected):
    raw = spark.createDataFrame([(None, None), ("", "x"), ("T", "y")],
                                "transportista string, motivo_rechazo string")
    out = trusted.fill_rate(raw, empty_is_null)
    assert sorted(r.transportista for r in out.collect()) == expected


def test_promotion_ids(spark):
    raw = spark.createDataFrame([(None,), ("",), ("  ",), ("\t12345678 \n",), ("S1",)],
                                "id_promocion_sap string")
    out = {(r.id_promocion_sap, r.flag_sap_id_pendiente) for r in trusted.promociones(raw).collect()}
    assert out == {(None, 1), ("", 1), ("12345678", 0), ("S1", 0)}


def test_approved_only(spark):
    raw = spark.createDataFrame([(1,), (0,), (None,)], "es_version_aprobada int")
    assert one(trusted.approved_only(raw)) == [(1,)]


def test_trailing_number(spark):
    df = spark.createDataFrame([("CLI-000123",), ("CLI",), ("9-X",), (None,), ("A" + "9" * 30,)],
                               "c string")
    assert one(df.select(text.trailing_number(F.col("c")))) == [
        (123,), (None,), (None,), (None,), (None,)]


def test_folder_date(spark):
    paths = ["s3://b/raw/ventas/20240131/x.csv", "/raw/ventas/fecha=20240131/x.csv",
             "/raw/ventas/20241399/x.csv", "/raw/ventas/2024013/x.csv", "/raw/ventas/x.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(text.folder_date(F.col("p"))).collect()] == [
        D(2024, 1, 31), D(2024, 1, 31), None, None, None]


@pytest.mark.parametrize("day,week", [(D(2023, 1, 1), 1), (D(2024, 1, 1), 0), (D(2023, 12, 31), 53),
                                      (D(2024, 12, 31), 52)])
def test_sunday_week(spark, day, week):
    df = spark.createDataFrame([(day,)], "d date")
    assert one(df.select(dates.sunday_week(F.col("d")))) == [(week,)]


def test_calendar_of_three_years(spark):
    days = calendar.calendar(calendar.days_between(spark, "2023-01-01", "2025-12-31")).cache()
    assert days.count() == 1096 and len(days.columns) == 18
    assert days.where("es_feriado = 1").count() == 36
    easter = {r.fecha for r in days.where("nombre_feriado like '%Santo'").collect()}
    assert {D(2023, 4, 6), D(2023, 4, 7), D(2024, 3, 28), D(2024, 3, 29), D(2025, 4, 17),
            D(2025, 4, 18)} <= easter
    row = days.where("id_fecha = 20231231").first()
    assert (row.semana_label, row.trimestre, row.semestre, row.nombre_dia, row.mes_nombre) == (
        "S53-2023", "Q4", 2, "Domingo", "Diciembre")
    assert (row.es_fin_semana, row.es_dia_habil, row.anio_mes, row.periodo) == (
        1, 0, "2023-12", 202312)


def test_rounding_is_half_up_on_decimals(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (None,)], "x double")
    assert one(df.select(numbers.rounded("x", 2))) == [(1.01,), (2.68,), (-1.01,), (None,)]


def test_percent_guards(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (1, 3)], "a int, b int")
    assert one(df.select(numbers.percent("a", "b", 2))) == [(None,), (None,), (33.33,)]


SALE = """num_factura string, id_producto bigint, fecha_emision date, id_linea_venta string,
 id_cliente bigint, id_canal bigint, id_geografia bigint, id_vendedor bigint, id_almacen bigint,
 cantidad_vendida bigint, precio_unitario_soles decimal(18,2), monto_bruto_soles decimal(18,2),
 descuento_pct decimal(18,2), ventas_netas_soles decimal(18,2), costo_ventas_soles decimal(18,2),
 inversion_promocional_soles decimal(18,2), _tag bigint"""


def sale(invoice, product, line, tag=0, customer=1, day=D(2024, 1, 2)):
    one = Decimal("1.00")
    return (invoice, product, day, line, customer, 1, 1, 1, 1, 2, one, one, one, one, one, one, tag)


RETURNS = "num_factura_origen string, id_producto bigint, cantidad_devuelta bigint, " \
          "monto_devolucion_soles decimal(18,2)"


def test_returns_are_summed_per_key_and_shown_on_every_line(spark):
    sales = spark.createDataFrame(
        [sale("A", 1, "A-1", 1), sale("A", 1, "A-2", 2), sale("B", 1, "B-1", 3)], SALE)
    back = spark.createDataFrame([("A", 1, 2, Decimal("5.50")), ("A", 1, 1, Decimal("1.00")),
                                  ("C", 9, 4, Decimal("1.00"))], RETURNS)
    fact = curated.fact_ventas(sales, back)
    got = sorted((r.num_factura, r.unidades_devueltas, float(r.monto_devuelto_soles))
                 for r in fact.collect())
    assert got == [("A", 3, 6.5), ("A", 3, 6.5), ("B", 0, 0.0)]
    once = curated.fact_ventas(sales, back, once=True)
    assert sorted((r.id_linea_venta, r.unidades_devueltas) for r in once.collect()) == [
        ("A-1", 3), ("A-2", 0), ("B-1", 0)]


def test_returns_once_with_identical_copies(spark):
    sales = spark.createDataFrame([sale("A", 1, "A-1", t) for t in (7, 3, 9)], SALE)
    back = spark.createDataFrame([("A", 1, 2, Decimal("5.50"))], RETURNS)
    fact = curated.fact_ventas(sales, back, once=True)
    assert sorted(r.unidades_devueltas for r in fact.collect()) == [0, 0, 2]


def test_customer_without_sales_and_exact_duplicate(spark):
    people = spark.createDataFrame(
        [("CLI-1", "a", "r", "N", "s", 1.0, 10), ("CLI-1", "a", "r", "N", "s", 1.0, 10),
         ("CLI-2", "b", "r", "N", "s", 1.0, 10)],
        "id_cliente_raw string, razon_social string, ruc string, tipo_persona string, "
        "segmento_comercial string, limite_credito_soles double, dias_credito int")
    sales = spark.createDataFrame(
        [sale("A", 1, "A-1", day=D(2024, 5, 1)), sale("A", 1, "A-2", day=D(2024, 3, 1))], SALE)
    got = sorted(((r.id_cliente, r.fecha_primer_compra)
                  for r in curated.dim_cliente(people, sales).collect()), key=lambda t: t[0])
    assert got == [(1, D(2024, 3, 1)), (2, None)]


def test_orphans_count_null_keys_and_empty_facts(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1,), (None,)], "k bigint")
    got = joins.orphan_counts(fact, {"a": ("k", dim, "k")})
    assert one(got) == [("a", 2)]
    assert one(joins.orphan_counts(fact.where("false"), {"a": ("k", dim, "k")})) == [("a", 0)]


def test_orphan_promotions_fan_out_like_a_join(spark):
    spend = spark.createDataFrame([("T1", "s"), ("T1", None), ("T2", "s"), (None, None)],
                                  "id_promocion_tm string, id_promocion_sap string")
    promos = spark.createDataFrame([("T1",), ("T1",), (None,)], "id_promocion_tm string")
    row = quality.v16_orphan_promotions(spend, promos).first().asDict()
    assert row == {"total_inversiones": 6, "inv_sin_id_tm": 1, "inv_sin_id_sap": 3,
                   "id_tm_sin_match_en_promociones": 1}


def test_scorer(spark):
    def row(**kw):
        return spark.createDataFrame([tuple(kw.values())], list(kw))

    empty = spark.createDataFrame([], "a bigint")
    measured = {
        "pass": row(a=3, b=0), "fail": row(a=3, b=1), "warn_missing": row(b=0),
        "warn_text": row(a="x"), "text_ok": row(a=" 3 "), "text_float": row(a="3.7"),
        "truncated": row(a=3.9), "empty": empty, "info": row(a=1),
        "warn_first": row(a="x", b=1), "fail_first": row(a=4, b="x"),
        "null": spark.createDataFrame([(None,)], "a bigint"),
    }
    wanted = {c: {"a": 3, "b": 0} if c in ("pass", "fail", "warn_first", "fail_first") else {"a": 3}
              for c in measured if c != "info"}
    got = {r.check_id: r.estado for r in quality.score(measured, wanted).collect()}
    assert got == {
        "pass": "PASS", "fail": "FAIL", "warn_missing": "WARN", "warn_text": "WARN",
        "text_ok": "PASS", "text_float": "WARN", "truncated": "PASS", "empty": "FAIL",
        "info": "INFO", "warn_first": "WARN", "fail_first": "FAIL", "null": "WARN"}


def test_run_checks_records_errors_and_goes_on(spark):
    good = spark.createDataFrame([(1,)], "a bigint")
    todo = {"bad": lambda: good.select("nope"), "good": lambda: good}
    scored = quality.run_checks(spark, todo, {"good": {"a": 1}})
    assert {r.check_id: r.estado for r in scored.collect()} == {"bad": "ERROR", "good": "PASS"}
    assert quality.failed(scored)
    only = quality.run_checks(spark, todo, {"good": {"a": 1}}, only="good")
    assert not quality.failed(only) and {tuple(r) for r in quality.tally(only).collect()} == {("PASS", 1)}


def test_status_has_three_states(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.5, 1.0), (1.0, 0.0), (1.0, None)], "v double, t double")
    v, t = F.col("v"), F.col("t")
    assert [r[0] for r in df.select(kpis.status(v, t)).collect()] == [True, False, None, None]
    assert [r[0] for r in df.select(kpis.status(v, t, True)).collect()] == [True, True, None, None]


def test_totals_of_nothing_are_zero(spark):
    cube = spark.createDataFrame(
        [], "ventas_netas double, margen_bruto double, inversion_promo double, "
            "cantidad_vendida bigint, unidades_devueltas bigint")
    assert set(kpis.commercial_totals(cube).first().asDict().values()) == {0}


def test_coverage_ignores_cells_without_cover(spark):
    cube = spark.createDataFrame([("a", 10, 5.0, 1.0), ("a", 0, 0.0, 1.0), ("a", 6, None, 1.0)],
                                 "g string, stock_disponible bigint, dias_cobertura double, "
                                 "meta_dias_cobertura double")
    assert kpis.coverage_by(cube, ["g"]).first().dias == 8.0


def test_sku_without_sales(spark):
    products = spark.createDataFrame(
        [(1, "c", "n", "k", "l", Decimal("10.00"), Decimal("6.00")),
         (2, "c", "n", "k", "l", Decimal("0.00"), Decimal("6.00"))],
        "id_producto bigint, cod_sku string, nombre_sku string, categoria string, "
        "linea_negocio string, precio_lista_soles decimal(18,2), costo_estandar_soles decimal(18,2)")
    fact = spark.createDataFrame([], "id_producto bigint, cantidad_vendida bigint, "
                                     "ventas_netas_soles decimal(18,2), unidades_devueltas bigint")
    rows = {r.id_producto: r for r in segment.sku_features(products, fact).collect()}
    assert (rows[1].margen_pct, rows[1].unidades_vendidas, rows[1].ventas_netas,
            rows[1].tasa_devolucion_pct) == (40.0, 0, 0.0, 0.0)
    assert rows[2].margen_pct is None


def test_future_regressors_follow_plan(spark):
    train = spark.createDataFrame(
        [(D(2025, 1, d), 1, Decimal("1.00"), Decimal(d), 0) for d in (1, 2, 3)],
        "ds date, id_canal bigint, ventas_netas_soles decimal(18,2), inversion_promo decimal(18,2),"
        " es_feriado int")
    rows = {r.ds: r for r in series.future_regressors(train, 90, "2026-01-01").collect()}
    assert len(rows) == 90 and max(rows) == D(2026, 3, 31)
    assert rows[D(2026, 1, 15)].inversion_promo == 2.0  # mean of January
    assert rows[D(2026, 2, 15)].inversion_promo == 0.0  # no history
    assert [d for d, r in rows.items() if r.es_feriado] == [D(2026, 1, 1)]


# -- forecasts -----------------------------------------------------------------------------


def _model(spark, values, start="2021-01-01"):
    """The model row of one series."""
    days = [d.date() for d in pd.date_range(start, periods=len(values))]
    daily = spark.createDataFrame(
        [(1, d, float(v)) for d, v in zip(days, values)], "id_canal bigint, ds date, y double")
    return forecast.fit(daily, "y").first().asDict()


def test_a_yearly_wave_is_forecast(spark):
    t = np.arange(3 * 365 + 90)
    values = 1000 + 300 * np.sin(2 * np.pi * t / 365.25)
    model = _model(spark, values[:-90])
    ahead = forecast._predict(model, pd.date_range("2021-01-01", periods=len(t))[-90:], np.zeros((90, 0)), 1.6)
    assert np.abs(ahead["forecast_value"] - values[-90:]).mean() < 40
    assert model["seasonal_periods"] == "WEEKLY,YEARLY"


def test_short_series_get_mean_and_spread(spark):
    model = _model(spark, [10.0, 14.0, 12.0])
    ahead = forecast._predict(model, pd.date_range("2021-01-04", periods=5), np.zeros((5, 0)), 1.6)
    assert ahead["forecast_value"].tolist() == [12.0] * 5 and (ahead["standard_error"] == 2.0).all()
    assert model["non_seasonal_d"] is None and model["has_drift"] is None
    one = _model(spark, [7.0])
    alone = forecast._predict(one, pd.date_range("2021-01-02", periods=2), np.zeros((2, 0)), 1.6)
    assert alone["forecast_value"].tolist() == [7.0, 7.0] and alone["standard_error"].isna().all()


def test_drift_is_forecast_only_where_it_is_found(spark):
    rng = np.random.default_rng(2)
    flat = _model(spark, 1000 + np.cumsum(rng.normal(0, 5, 400)))
    assert flat["non_seasonal_d"] == 1 and not flat["has_drift"] and flat["drift"] == 0
    rising = _model(spark, np.cumsum(rng.normal(4, 2, 400)))
    assert rising["has_drift"] and abs(rising["drift"] - 4) < 1


def test_any_confidence_has_its_half_width():
    assert abs(forecast.half_width(0.9) - 1.6448536270) < 1e-9
    assert 0.6 < forecast.half_width(0.5) < forecast.half_width(0.7)
