"""Training tables, metrics and model jobs."""

from pyspark.sql import functions as F

from retaloom.functions.numbers import rounded
from retaloom.plans import forecast, panel, segment, series
from retaloom.queries.registry import query
from retaloom.queries.sqlbase import b, d, pct, r, ratio, rm
from retaloom.session import as_table

HOLDOUT = "2000-01-01"
XREGS = ("inversion_promo", "es_feriado")

_SERIES = """
  serie AS (SELECT t.fecha AS ds, v.id_canal, SUM(v.ventas_netas_soles) AS y,
                   SUM(v.inversion_promocional_soles) AS x, MAX(t.es_feriado) AS h
            FROM fact_ventas v JOIN dim_tiempo t ON v.id_fecha = t.id_fecha GROUP BY 1, 2)"""


def _series(m):
    return series.daily_series(m.fact("ventas"), m.dim("tiempo"))


@query("series_daily", f"""
SELECT * FROM (WITH {_SERIES}
  SELECT ds, id_canal, {d('y')} AS ventas_netas_soles, {d('x')} AS inversion_promo,
         {b('h')} AS es_feriado FROM serie) AS s""")
def daily(m):
    return _series(m)


@query("series_future_regressors", f"""
SELECT * FROM (WITH {_SERIES},
  ahead AS (SELECT id_canal, CAST(unnest(generate_series(MAX(ds) + INTERVAL 1 DAY,
              MAX(ds) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM serie GROUP BY 1),
  promo AS (SELECT id_canal, month(ds) AS mes, {ratio('SUM(x)', 'COUNT(x)')} AS p
            FROM serie GROUP BY 1, 2)
  SELECT a.ds, a.id_canal, {r('COALESCE(p.p, 0)', 6)} AS inversion_promo,
         CASE WHEN (month(a.ds), day(a.ds)) IN ((1, 1), (12, 25), (12, 8), (11, 1))
              THEN 1 ELSE 0 END::BIGINT AS es_feriado
  FROM ahead a LEFT JOIN promo p ON a.id_canal = p.id_canal AND month(a.ds) = p.mes) AS s""")
def future(m):
    # the horizon runs from November to February, which holds no movable holiday
    rows = series.future_regressors(_series(m))
    return rows.withColumn("inversion_promo", F.round(
        F.col("inversion_promo").cast("decimal(38,10)"), 6).cast("double"))


_STEP = "CAST(ROUND(CAST({} AS DECIMAL(38,10)), 4) AS DECIMAL(18,4))"


@query("series_decompose", f"""
SELECT * FROM (WITH {_SERIES},
  t AS (SELECT id_canal, ds, CAST(y AS DECIMAL(18,4)) AS v,
               {_STEP.format(ratio('SUM(y) OVER w', 'COUNT(y) OVER w'))} AS tr
        FROM serie WINDOW w AS (PARTITION BY id_canal ORDER BY ds
                                ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
  s AS (SELECT *, {_STEP.format(ratio('SUM(v - tr) OVER k', 'COUNT(*) OVER k'))} AS se
        FROM t WINDOW k AS (PARTITION BY id_canal, dayofweek(ds)))
  SELECT id_canal, ds, {d('v')} AS valor, {d('tr')} AS tendencia, {d('se')} AS estacionalidad,
         {d('v - tr - se')} AS residuo FROM s) AS q""")
def decompose(m):
    return series.decompose(_series(m))


@query("series_xreg_sufficient_stats", f"""
SELECT * FROM (WITH {_SERIES},
  s AS (SELECT id_canal, CAST(y AS DECIMAL(16,2)) AS y, CAST(x AS DECIMAL(16,2)) AS x,
               CAST(h AS DECIMAL(16,2)) AS h FROM serie)
  SELECT id_canal, COUNT(*) AS n, {b('SUM(y)')} AS s_y, {b('SUM(x)')} AS s_x, {b('SUM(h)')} AS s_h,
         {b('ROUND(SUM(x * x), 0)')} AS s_xx, {b('ROUND(SUM(h * h), 0)')} AS s_hh,
         {b('ROUND(SUM(x * h), 0)')} AS s_xh, {b('ROUND(SUM(x * y), 0)')} AS s_xy,
         {b('ROUND(SUM(h * y), 0)')} AS s_hy, {b('ROUND(SUM(y * y), 0)')} AS s_yy
  FROM s GROUP BY 1) AS q""".replace(b("SUM(y)"), b("ROUND(SUM(y), 0)"))
       .replace(b("SUM(x)"), b("ROUND(SUM(x), 0)")), wide=series.SUMS)
def sufficient(m):
    return series.whole_sums(as_table(series.regression_sums(_series(m)), "sums"))  # a row per channel


# -- panel ---------------------------------------------------------------------------


def _panel_sql(trend):
    return f"""
SELECT * FROM (WITH lagged AS (
    SELECT i.*, LAG(stock_disponible, 1) OVER w AS s1, LAG(stock_disponible, 2) OVER w AS s2,
           LAG(stock_reservado, 1) OVER w AS r1, LAG(dias_cobertura, 1) OVER w AS c1,
           LAG(demanda_diaria_prom, 1) OVER w AS d1,
           SUM(flag_quiebre) OVER (PARTITION BY id_producto, id_almacen ORDER BY id_fecha
                                   ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS q3
    FROM fact_inventario i WINDOW w AS (PARTITION BY id_producto, id_almacen ORDER BY id_fecha))
  SELECT l.id_producto, l.id_almacen, l.id_fecha, {b('flag_quiebre')} AS flag_quiebre,
         s1 AS stock_mes_anterior, r1 AS reservado_mes_anterior, {d('c1')} AS cobertura_mes_anterior,
         {d('d1')} AS demanda_mes_anterior, {trend} AS tendencia_stock,
         {b('q3')} AS quiebres_ultimos_3_meses, p.categoria, p.linea_negocio, a.tipo_almacen,
         a.macroregion, t.mes, t.trimestre, t.fecha >= DATE '{HOLDOUT}' AS split
  FROM lagged l JOIN dim_producto p ON l.id_producto = p.id_producto
  JOIN dim_almacen a ON l.id_almacen = a.id_almacen
  JOIN dim_tiempo t ON l.id_fecha = t.id_fecha WHERE s1 IS NOT NULL) AS q"""


def _panel(m, corrected=True, dense=False):
    fact = panel.densify(m.fact("inventario")) if dense else m.fact("inventario")
    return panel.lag_features(
        fact, m.dim("producto"), m.dim("almacen"), m.dim("tiempo"), HOLDOUT, corrected)


@query("panel_lag_features", _panel_sql("stock_disponible - s1"))
def lag_features(m):
    return _panel(m, corrected=False)


@query("panel_lag_features_corrected", _panel_sql("s1 - s2"))
def lag_features_corrected(m):
    return _panel(m)


@query("panel_lag_features_dense", f"""
SELECT i.id_producto, i.id_almacen, i.id_fecha, i.stock_disponible,
       j.stock_disponible AS stock_mes_anterior
FROM fact_inventario i JOIN fact_inventario j
  ON i.id_producto = j.id_producto AND i.id_almacen = j.id_almacen
 AND strptime(CAST(i.id_fecha AS VARCHAR), '%Y%m%d') - INTERVAL 1 MONTH
   = strptime(CAST(j.id_fecha AS VARCHAR), '%Y%m%d')""")
def lag_features_dense(m):
    rows = _panel(m, dense=True).where(F.col("flag_quiebre").isNotNull())
    stock = m.fact("inventario").select(*panel.KEYS, "stock_disponible")
    return rows.join(stock, panel.KEYS).select(*panel.KEYS, "stock_disponible", "stock_mes_anterior")


@query("panel_class_weights", f"""
SELECT {b('flag_quiebre')} AS flag_quiebre, COUNT(*) AS filas,
       {r(ratio('SUM(COUNT(*)) OVER ()', '2 * COUNT(*)'), 8)} AS peso
FROM fact_inventario GROUP BY flag_quiebre""")
def class_weights(m):
    return panel.class_weights(m.fact("inventario"))


# A score any engine can compute: the lower the previous stock, the higher the risk.
_SCORE = "1.0 / (1 + stock_mes_anterior)"


@query("panel_classifier_metrics", f"""
SELECT tp, fp, fn, tn, COALESCE({r(ratio('tp', 'tp + fp'), 6)}, 0) AS precision,
       COALESCE({r(ratio('tp', 'tp + fn'), 6)}, 0) AS recall,
       COALESCE({r(ratio('2 * tp', '2 * tp + fp + fn'), 6)}, 0) AS f1_score,
       {r(ratio('tp + tn', 'tp + fp + fn + tn'), 6)} AS accuracy,
       {r('(u - p * (p + 1) / 2.0) / (p * n)', 6)} AS roc_auc
FROM (SELECT COUNT(*) FILTER (WHERE s >= 0.5 AND y = 1) AS tp,
             COUNT(*) FILTER (WHERE s >= 0.5 AND y = 0) AS fp,
             COUNT(*) FILTER (WHERE s < 0.5 AND y = 1) AS fn,
             COUNT(*) FILTER (WHERE s < 0.5 AND y = 0) AS tn,
             {d('COUNT(*) FILTER (WHERE y = 1)')} AS p, {d('COUNT(*) FILTER (WHERE y = 0)')} AS n,
             {d('SUM(k) FILTER (WHERE y = 1)')} AS u
      FROM (SELECT y, s, rank() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS k
            FROM (SELECT flag_quiebre AS y, {_SCORE.replace('1.0', '1.0::DOUBLE')} AS s
                  FROM ({_panel_sql('s1 - s2')}) AS pp WHERE split) AS a) AS c) AS x""")
def classifier_metrics(m):
    held = _panel(m).where("split").withColumn("s", F.expr(_SCORE).cast("double"))
    return panel.metrics(held, "flag_quiebre", "s")


@query("stockout_gbt_scores")
def gbt_scores(m):
    rows = as_table(_panel(m), "panel")
    return panel.predict(panel.train(rows), rows)


@query("stockout_gbt_holdout_metrics")
def gbt_metrics(m):
    rows = as_table(_panel(m), "panel")
    scored = panel.predict(panel.train(rows), rows)
    return panel.metrics(scored.where("split"), "flag_quiebre", "probabilidad")


@query("stockout_gbt_importances")
def gbt_importances(m):
    rows = as_table(_panel(m), "panel")
    return panel.importances(panel.train(rows), rows)


# -- segments -------------------------------------------------------------------------

_SKU = f"""
  sku AS (SELECT p.id_producto, p.cod_sku, p.nombre_sku, p.categoria, p.linea_negocio,
                 {d('p.precio_lista_soles')} AS precio_lista_soles,
                 {pct('p.precio_lista_soles - p.costo_estandar_soles', 'p.precio_lista_soles')}
                   AS margen_pct,
                 {b('COALESCE(SUM(v.cantidad_vendida), 0)')} AS unidades_vendidas,
                 {d('COALESCE(SUM(v.ventas_netas_soles), 0)')} AS ventas_netas,
                 COALESCE({pct('SUM(v.unidades_devueltas)', 'SUM(v.cantidad_vendida)')}, 0)
                   AS tasa_devolucion_pct
          FROM dim_producto p LEFT JOIN fact_ventas v ON p.id_producto = v.id_producto
          GROUP BY 1, 2, 3, 4, 5, p.precio_lista_soles, p.costo_estandar_soles)"""


def _features(m):
    return segment.sku_features(m.dim("producto"), m.fact("ventas"))


@query("sku_features", f"SELECT * FROM (WITH {_SKU} SELECT * FROM sku) AS q")
def sku_features(m):
    return _features(m)


# A label any engine can compute stands in for the segment: one of four price bands.
_BAND = "CASE WHEN precio_lista_soles < 925 THEN 1 WHEN precio_lista_soles < 950 THEN 2 " \
        "WHEN precio_lista_soles < 975 THEN 3 ELSE 4 END"


def _banded(m):
    return _features(m).withColumn("cluster", F.expr(_BAND))


def _cmean(c):
    return r(ratio(f"SUM(CAST({c} AS DECIMAL(28,4)))", f"COUNT({c})"), 4)


@query("sku_cluster_profile", f"""
SELECT * FROM (WITH {_SKU}
  SELECT {b(_BAND)} AS cluster, COUNT(*) AS skus, {_cmean('precio_lista_soles')} AS precio_medio,
         {_cmean('margen_pct')} AS margen_medio, {_cmean('ventas_netas')} AS ventas_medias,
         {d('SUM(CAST(ventas_netas AS DECIMAL(28,4)))')} AS ventas
  FROM sku GROUP BY 1) AS q""")
def cluster_profile(m):
    return segment.profile(_banded(m))


@query("sku_segment_overview", f"""
SELECT * FROM (WITH {_SKU}
  SELECT COUNT(*) AS skus, COUNT(DISTINCT {_BAND}) AS clusters FROM sku) AS q""")
def segment_overview(m):
    return segment.overview(_banded(m))


@query("sku_segment_table", f"""
SELECT * FROM (WITH {_SKU} SELECT {b(_BAND)} AS cluster, * FROM sku) AS q""")
def segment_table(m):
    return segment.ordered_table(_banded(m))


@query("sku_davies_bouldin", f"""
SELECT * FROM (WITH {_SKU},
  pts AS (SELECT {_BAND} AS c, precio_lista_soles AS a, margen_pct AS e FROM sku),
  cen AS (SELECT c, AVG(a) AS ma, AVG(e) AS me FROM pts GROUP BY 1),
  dist AS (SELECT p.c, (a - ma) * (a - ma) + (e - me) * (e - me) AS d2
           FROM pts p JOIN cen ON p.c = cen.c),
  spread AS (SELECT dist.c, AVG(sqrt(d2)) AS s, ANY_VALUE(ma) AS ma, ANY_VALUE(me) AS me
             FROM dist JOIN cen ON dist.c = cen.c GROUP BY 1),
  worst AS (SELECT i.c, MAX((i.s + j.s) / sqrt((i.ma - j.ma) * (i.ma - j.ma)
                                               + (i.me - j.me) * (i.me - j.me))) AS w
            FROM spread i JOIN spread j ON i.c <> j.c GROUP BY 1)
  SELECT {r('(SELECT AVG(w) FROM worst)', 6)} AS davies_bouldin_index,
         {r('(SELECT AVG(d2) FROM dist)', 6)} AS mean_squared_distance) AS q""")
def davies_bouldin(m):
    return segment.cluster_quality(_banded(m), ["precio_lista_soles", "margen_pct"])


@query("sku_kmeans")
def kmeans(m):
    rows = _features(m)
    return segment.assign(segment.train(rows), rows)


@query("sku_kmeans_quality")
def kmeans_quality(m):
    rows = _features(m)
    assigned = segment.assign(segment.train(rows), rows)
    return segment.cluster_quality(assigned, [f"z_{c}" for c in segment.FEATURES])


# -- forecasts --------------------------------------------------------------------------


def _daily(m):
    """Days x channels rows, written once for everything a forecast takes from them."""
    return as_table(_series(m), "series")


def _models(daily):
    return forecast.fit(daily, regressors=XREGS)


@query("forecast_fit_eval_plain")
def fit_eval_plain(m):
    return forecast.evaluate(forecast.fit(series.sales_only(_daily(m))))


@query("forecast_90d_plain")
def forecast_plain(m):
    return forecast.forecast(forecast.fit(series.sales_only(_daily(m))))


@query("forecast_explain")
def forecast_explain(m):
    daily = _daily(m)
    models = as_table(forecast.fit(series.sales_only(daily)), "models")  # one row per series
    return forecast.explain(series.components(daily), forecast.forecast(models))


_SORTED = "list_sort({})[(len(a) + 1) // 2]"


@query("forecast_explain_past", f"""
SELECT * FROM (WITH {_SERIES},
  t AS (SELECT id_canal, ds, h, CAST(y AS DECIMAL(18,4)) AS v,
               {_STEP.format(ratio('SUM(y) OVER w', 'COUNT(y) OVER w'))} AS tr
        FROM serie WINDOW w AS (PARTITION BY id_canal ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
  s AS (SELECT *, {_STEP.format(ratio('SUM(v - tr) OVER k', 'COUNT(*) OVER k'))} AS se
        FROM t WINDOW k AS (PARTITION BY id_canal, dayofweek(ds))),
  f AS (SELECT *, CASE WHEN h = 1 THEN {_STEP.format(ratio(
               'SUM(CASE WHEN h = 1 THEN v - tr - se END) OVER (PARTITION BY id_canal)',
               'COUNT(CASE WHEN h = 1 THEN 1 END) OVER (PARTITION BY id_canal)'))} ELSE 0 END AS fe FROM s),
  g AS (SELECT *, v - tr - se - fe AS resto, list(v - tr - se - fe) OVER (
               PARTITION BY id_canal ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING) AS a FROM f),
  m AS (SELECT *, {_SORTED.format('a')} AS med FROM g),
  u AS (SELECT *, {_SORTED.format('list_transform(a, lambda z: abs(z - med))')} AS usual FROM m),
  p AS (SELECT *, CASE WHEN abs(resto - med) > usual * 6 THEN resto - med ELSE 0 END AS pico FROM u),
  l AS (SELECT *, v - se - fe - pico AS nivel, {_STEP.format(ratio(
               'SUM(abs(resto - pico)) OVER (PARTITION BY id_canal)', 'COUNT(*) OVER (PARTITION BY id_canal)'))} AS ruido
        FROM p),
  j AS (SELECT *, CASE WHEN COUNT(nivel) OVER b = 28 AND COUNT(nivel) OVER n = 28
               THEN {_STEP.format(ratio('SUM(nivel) OVER n', 'COUNT(nivel) OVER n'))}
                  - {_STEP.format(ratio('SUM(nivel) OVER b', 'COUNT(nivel) OVER b'))} END AS salto
        FROM l WINDOW b AS (PARTITION BY id_canal ORDER BY ds ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING),
                      n AS (PARTITION BY id_canal ORDER BY ds ROWS BETWEEN CURRENT ROW AND 27 FOLLOWING)),
  e AS (SELECT *, CASE WHEN abs(salto) > ruido * {round(series.JUMP * 1.25 * (2 / series.SIDE) ** 0.5, 4)}
               AND abs(salto) > COALESCE(MAX(abs(salto)) OVER (PARTITION BY id_canal ORDER BY ds
                                         ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), -1)
               AND abs(salto) >= COALESCE(MAX(abs(salto)) OVER (PARTITION BY id_canal ORDER BY ds
                                          ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING), -1)
               THEN salto ELSE 0 END AS paso FROM j),
  c AS (SELECT *, SUM(paso) OVER (PARTITION BY id_canal ORDER BY ds ROWS UNBOUNDED PRECEDING) AS es FROM e)
  SELECT id_canal, ds, {d('v')} AS valor, {d('tr - es')} AS tendencia, {d('se')} AS estacionalidad,
         {d('fe')} AS feriado, {d('pico')} AS pico, {d('es')} AS escalon, {d('resto - pico')} AS residuo
  FROM c) AS q""")
def explain_past(m):
    return series.components(_daily(m))


@query("forecast_fit_eval")
def fit_eval(m):
    return forecast.evaluate(_models(_daily(m)))


@query("forecast_90d")
def forecast_90(m):
    daily = _daily(m)
    return forecast.forecast_with(_models(daily), series.future_regressors(daily), XREGS)


@query("forecast_what_if")
def what_if(m):
    daily = _daily(m)
    plan = series.future_regressors(daily).withColumn(
        "inversion_promo", F.col("inversion_promo") * 2)
    return forecast.forecast_with(_models(daily), plan, XREGS)


_DESIGN = [*[f"CAST(isodow(ds) = {i + 1} AS INT)" for i in range(7)],
           *[f"CASE WHEN dias >= 730 THEN CAST(ROUND({f}((ds - DATE '2000-01-01') * {k * 2 * 3.141592653589793 / 365.25!r}), 6)"
             f" AS DECIMAL(8,6)) ELSE 0 END" for k in (1, 2) for f in ("sin", "cos")],
           "CAST(x AS DECIMAL(16,2))", "CAST(h AS DECIMAL(16,2))", "CAST(y AS DECIMAL(16,2))"]


def _elimination(k: int) -> str:
    """Coefficients by elimination, a step per column: rows (id_canal, i, j, v) of the matrix."""
    columns = ", ".join(f"{e} AS c{n}" for n, e in enumerate(_DESIGN))
    sums = " UNION ALL ".join(
        f"SELECT id_canal, {i} AS i, {j} AS j, CAST(SUM(c{i} * c{j}) AS DOUBLE) AS v FROM diseno GROUP BY 1"
        for i in range(k) for j in range(k + 1))
    steps = "".join(f""",
  m{p + 1} AS MATERIALIZED (
    SELECT m.id_canal, m.i, m.j, CASE
             WHEN piv.v > 1e-9 * d.v THEN CASE WHEN m.i = {p} THEN m.v / piv.v ELSE m.v - col.v * (lin.v / piv.v) END
             WHEN m.i = {p} OR m.j = {p} THEN 0 ELSE m.v END AS v
    FROM m{p} m
    JOIN (SELECT id_canal, v FROM m{p} WHERE i = {p} AND j = {p}) piv ON m.id_canal = piv.id_canal
    JOIN (SELECT id_canal, v FROM m0 WHERE i = {p} AND j = {p}) d ON m.id_canal = d.id_canal
    JOIN (SELECT id_canal, i, v FROM m{p} WHERE j = {p}) col ON m.id_canal = col.id_canal AND m.i = col.i
    JOIN (SELECT id_canal, j, v FROM m{p} WHERE i = {p}) lin ON m.id_canal = lin.id_canal AND m.j = lin.j)"""
                    for p in range(k))
    return f"""{_SERIES},
  diseno AS MATERIALIZED (
    SELECT id_canal, {columns} FROM (
      SELECT *, MAX(ds) OVER (PARTITION BY id_canal) - MIN(ds) OVER (PARTITION BY id_canal) + 1 AS dias FROM serie)),
  m0 AS MATERIALIZED ({sums}){steps},
  pend AS (SELECT id_canal, MAX(v) FILTER (i = {k - 2}) AS px, MAX(v) FILTER (i = {k - 1}) AS ph
           FROM m{k} WHERE j = {k} GROUP BY 1)"""


_SLOPES = _elimination(len(_DESIGN) - 1)


@query("forecast_slopes", f"""
SELECT * FROM (WITH {_SLOPES}
  SELECT id_canal, (SELECT COUNT(*) FROM serie s WHERE s.id_canal = pend.id_canal) AS n,
         {r('px', 6)} AS inversion_promo, {r('ph', 4)} AS es_feriado FROM pend) AS q""")
def regression_slopes(m):
    found = forecast.slopes(forecast.regression(_daily(m), regressors=XREGS), XREGS)
    return found.select("id_canal", "n", rounded("inversion_promo", 6).alias("inversion_promo"),
                        rounded("es_feriado", 4).alias("es_feriado"))


@query("forecast_what_if_effect", f"""
SELECT * FROM (WITH {_SLOPES},
  ahead AS (SELECT id_canal, CAST(unnest(generate_series(MAX(ds) + INTERVAL 1 DAY,
              MAX(ds) + INTERVAL 90 DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM serie GROUP BY 1),
  promo AS (SELECT id_canal, month(ds) AS mes, {ratio('SUM(x)', 'COUNT(x)')} AS p FROM serie GROUP BY 1, 2)
  SELECT a.id_canal, a.ds AS forecast_timestamp, {r('px * COALESCE(p.p, 0)', 3)} AS efecto
  FROM ahead a JOIN pend ON a.id_canal = pend.id_canal
  LEFT JOIN promo p ON a.id_canal = p.id_canal AND month(a.ds) = p.mes) AS q""")
def what_if_effect(m):
    """What doubling the planned spend adds to each day: one model, two plans."""
    daily = _daily(m)
    models = as_table(_models(daily), "models")
    plan = series.future_regressors(daily)
    double = plan.withColumn("inversion_promo", F.col("inversion_promo") * 2)
    keys, value = ["id_canal", "forecast_timestamp"], "forecast_value"
    usual = forecast.forecast_with(models, plan, XREGS).select(*keys, value)
    more = forecast.forecast_with(models, double, XREGS).select(*keys, F.col(value).alias("_more"))
    return usual.join(more, keys).select(*keys, rounded(F.col("_more") - F.col(value), 3).alias("efecto"))


def _named(m):
    return forecast.named_forecast(forecast_90(m), m.dim("canal"))


@query("forecast_channel_names")
def channel_names(m):
    return _named(m)


@query("forecast_total_by_day")
def total_by_day(m):
    return forecast.total_by_day(_named(m))


@query("forecast_channel_summary")
def channel_summary(m):
    return forecast.summary_by_channel(_named(m))


@query("forecast_history", f"""
SELECT * FROM (WITH {_SERIES}
  SELECT s.id_canal, c.nombre_canal, s.ds AS fecha, {d('s.y')} AS ventas_netas_soles
  FROM serie s JOIN dim_canal c ON s.id_canal = c.id_canal
  WHERE s.ds >= DATE '2000-01-01' AND s.ds < DATE '2001-01-01') AS q""")
def history(m):
    named = forecast.named_history(_series(m), m.dim("canal"))
    day = F.col("fecha")
    return named.where((day >= F.lit("2000-01-01").cast("date"))
                       & (day < F.lit("2001-01-01").cast("date")))


# A forecast any engine can compute: the same weekday in the last four weeks.
_WEEKDAY = f"""{_SERIES},
  fin AS (SELECT id_canal, MAX(ds) AS ultimo FROM serie GROUP BY 1),
  cerca AS (SELECT s.id_canal, s.ds, CAST(s.y AS DECIMAL(18,2)) AS y,
                   date_diff('day', s.ds, f.ultimo) AS hace
            FROM serie s JOIN fin f ON s.id_canal = f.id_canal
            WHERE date_diff('day', s.ds, f.ultimo) < 28),
  pron AS (SELECT c.nombre_canal, CAST(p.ds + CAST(7 * (p.hace // 7 + 1) AS INTEGER) AS DATE) AS fecha,
                  {rm(ratio('SUM(p.y)', 'COUNT(p.y)'))} AS v, MIN(p.y) AS a, MAX(p.y) AS z
           FROM cerca p JOIN dim_canal c ON p.id_canal = c.id_canal GROUP BY p.id_canal, 1, 2)"""


def _weekday(m):
    return forecast.named_forecast(forecast.same_weekday(_daily(m)), m.dim("canal"))


@query("forecast_weekday_channel_names", f"""
SELECT * FROM (WITH {_WEEKDAY}
  SELECT nombre_canal, fecha, {d('v')} AS venta_pronostico, {d('a')} AS lim_inf, {d('z')} AS lim_sup
  FROM pron) AS q""")
def weekday_names(m):
    return _weekday(m).drop("id_canal")


@query("forecast_weekday_total_by_day", f"""
SELECT * FROM (WITH {_WEEKDAY}
  SELECT fecha, {d('SUM(v)')} AS venta, {d('SUM(a)')} AS lim_inf, {d('SUM(z)')} AS lim_sup
  FROM pron GROUP BY 1) AS q""")
def weekday_total(m):
    return forecast.total_by_day(_weekday(m))


@query("forecast_weekday_channel_summary", f"""
SELECT * FROM (WITH {_WEEKDAY},
  k AS (SELECT nombre_canal, {ratio('SUM(v)', 'COUNT(v)')} AS media, {ratio('SUM(z)', 'COUNT(z)')} AS sup
        FROM pron GROUP BY 1)
  SELECT nombre_canal, {r('media', 2)} AS venta_diaria_media, {r('sup - media', 2)} AS ic_90
  FROM k) AS q""")
def weekday_summary(m):
    return forecast.summary_by_channel(_weekday(m))


@query("forecast_days_ahead", f"""
SELECT * FROM (WITH {_SERIES}
  SELECT id_canal, CAST(unnest(generate_series(MAX(ds) + INTERVAL 1 DAY, MAX(ds) + INTERVAL 90 DAY,
                                               INTERVAL 1 DAY)) AS DATE) AS forecast_timestamp,
         TRUE AS acotado FROM serie GROUP BY 1) AS q""")
def days_ahead(m):
    """The fitted forecast covers each series' next ninety days, each value inside its band."""
    inside = F.col("forecast_value").between(
        F.col("prediction_interval_lower_bound"), F.col("prediction_interval_upper_bound"))
    return forecast_90(m).select("id_canal", "forecast_timestamp", inside.alias("acotado"))


@query("stockout_gbt_keys", f"""
SELECT id_producto, id_almacen, id_fecha, flag_quiebre, TRUE AS probable
FROM ({_panel_sql('s1 - s2')}) AS p""")
def gbt_keys(m):
    """Every row of the panel has one score, and it is a probability."""
    return gbt_scores(m).select(
        *panel.KEYS, "flag_quiebre", F.col("probabilidad").between(0, 1).alias("probable"))


@query("sku_kmeans_keys", """
SELECT id_producto, TRUE AS con_segmento FROM dim_producto""")
def kmeans_keys(m):
    return kmeans(m).select("id_producto", F.col("cluster").between(1, 4).alias("con_segmento"))
