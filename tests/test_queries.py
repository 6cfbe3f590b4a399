"""Every registered query against its SQL twin, on whole tables.

The queries run a few at a time, as one pass; each test waits for its own.
"""

from concurrent.futures import ThreadPoolExecutor

import pytest
from compare import connect, differences

from retaloom.queries import QUERIES

# May find nothing at the smallest scale.
MAY_BE_EMPTY = {"rec_key_uniqueness"}
AT_ONCE = 4


class Collected:
    """Columns and rows of a result, as the comparison takes them."""

    def __init__(self, df):
        self.columns, self._rows = df.columns, df.collect()

    def collect(self):
        return self._rows


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.fixture(scope="module")
def results(spark, folder, request):
    chosen = [i.callspec.params["name"] for i in request.session.items
              if i.nodeid.split("::")[-1].startswith("test_matches_sql[") and "test_queries" in i.nodeid]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        yield {n: pool.submit(lambda n=n: Collected(QUERIES[n].run(spark, folder))) for n in chosen}


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_matches_sql(results, duck, name):
    message = differences(results[name].result(), duck, QUERIES[name].sql)
    if name in MAY_BE_EMPTY and message == "both sides are empty":
        return
    assert message == ""


# -- model jobs: no SQL twin, so their properties -----------------------------------------


def test_forecast_has_ninety_days_per_channel_and_ordered_bounds(spark, folder):
    rows = QUERIES["forecast_90d"].run(spark, folder).collect()
    assert len(rows) == 90 * len({r.id_canal for r in rows})
    for r in rows:
        assert (r.prediction_interval_lower_bound < r.forecast_value
                < r.prediction_interval_upper_bound)


def test_forecast_is_repeatable(spark, folder):
    once, again = (
        sorted(map(tuple, QUERIES["forecast_90d"].run(spark, folder).collect())) for _ in range(2))
    assert once == again


def test_regressors_explain_sales(spark, folder):
    plain = {r.id_canal: r.AIC for r in
             QUERIES["forecast_fit_eval_plain"].run(spark, folder).collect()}
    richer = {r.id_canal: r.AIC for r in QUERIES["forecast_fit_eval"].run(spark, folder).collect()}
    assert all(richer[c] < plain[c] for c in plain)


def test_more_promotion_raises_the_forecast(spark, folder):
    total = lambda n: sum(r.forecast_value for r in QUERIES[n].run(spark, folder).collect())
    assert total("forecast_what_if") > total("forecast_90d")


def test_explained_components_add_up(spark, folder):
    rows = QUERIES["forecast_explain"].run(spark, folder).collect()
    assert {r.tipo for r in rows} == {"history", "forecast"}
    for r in rows:
        parts = (r.tendencia, r.estacionalidad, r.feriado, r.pico, r.escalon, r.residuo)
        assert abs(r.valor - sum(parts)) < 1e-3


def test_kmeans_covers_all_products(spark, folder):
    rows = QUERIES["sku_kmeans"].run(spark, folder).collect()
    products = spark.read.parquet(f"{folder}/part.parquet").count()
    assert len(rows) == products
    assert {r.cluster for r in rows} == {1, 2, 3, 4}


def test_stockout_scores_are_probabilities_with_keys(spark, folder):
    rows = QUERIES["stockout_gbt_scores"].run(spark, folder).collect()
    assert rows and all(0 <= r.probabilidad <= 1 for r in rows)
    assert len({(r.id_producto, r.id_almacen, r.id_fecha) for r in rows}) == len(rows)
