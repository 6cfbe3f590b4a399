"""Forecasts of many daily series: one small fit per series, Spark spreads the series.

A series reaches a task as its daily totals, so a fit sees at most one row per
calendar day however many sale lines there are. The model of a series is one row
(orders, coefficients, state), so models are an ordinary DataFrame that can be
stored, inspected and used to forecast again with other regressors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from retaloom.functions.numbers import mean, rounded, rounded_money
from retaloom.plans import calendar, regress, series
from retaloom.plans.regress import EPOCH, YEAR
from retaloom.session import as_table

# Ship the fitting functions with the job: executors need numpy and pandas only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODEL_SCHEMA = """
    id_canal bigint, non_seasonal_p int, non_seasonal_d int, non_seasonal_q int, has_drift boolean,
    log_likelihood double, AIC double, variance double, seasonal_periods string,
    has_spikes_and_dips boolean, has_step_changes boolean, last_ds date,
    weekday array<double>, yearly array<double>, slopes array<double>, phi array<double>, theta array<double>,
    drift double, level double, recent array<double>, shocks array<double>
"""
FORECAST_SCHEMA = """
    id_canal bigint, forecast_timestamp date, forecast_value double, standard_error double,
    prediction_interval_lower_bound double, prediction_interval_upper_bound double
"""
ORDERS = [(p, q) for p in range(3) for q in range(3)]
KPSS_LIMIT = 0.463  # 5 % critical value of the level-stationarity test

@dataclass(frozen=True)
class Needs:
    """Days of history from which a part of the fit is used at all.

    Below ``week`` a series gets its mean and spread alone. Below ``difference`` and
    ``steps`` the test for differencing and for step changes is not run, and its
    result is NULL. From ``yearly`` on, a yearly wave of ``waves`` harmonics is fitted.
    """

    week: int = 14
    difference: int = 31
    steps: int = 61
    yearly: int = 730
    waves: int = 2


def _wave(days: pd.DatetimeIndex, harmonics: int) -> np.ndarray:
    turn = 2 * np.pi * (days - pd.Timestamp(EPOCH)).days.to_numpy() / YEAR
    parts = [np.round(f(k * turn), 6) for k in range(1, harmonics + 1) for f in (np.sin, np.cos)]
    return np.column_stack(parts) if parts else np.zeros((len(days), 0))


def half_width(confidence: float) -> float:
    """Standard errors on each side of a two-sided normal interval."""
    return NormalDist().inv_cdf((1 + confidence) / 2)


def _shocks(w: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """One-step errors of an ARMA process, starting from zero errors."""
    ar = w.copy()
    for i, c in enumerate(phi, start=1):
        ar[i:] -= c * w[:-i]
    if not len(theta):
        return ar
    e = np.zeros(len(w) + len(theta))
    lags = theta[::-1]
    for t in range(len(w)):
        e[t + len(theta)] = ar[t] - lags @ e[t:t + len(theta)]
    return e[len(theta):]


def _stable(c: np.ndarray, sign: float) -> bool:
    if not len(c):
        return True
    roots = np.roots(np.r_[1.0, -sign * c])
    return bool(np.all(np.abs(roots) < 0.995))


def _lagged(x: np.ndarray, lags: int, start: int) -> np.ndarray:
    return np.column_stack([x[start - i:len(x) - i] for i in range(1, lags + 1)])


def _arma(w: np.ndarray):
    """Least-squares ARMA fits over the order grid (Hannan-Rissanen), best AIC first."""
    n = len(w)
    long = min(14, max(2, n // 10))  # lags of the first, long regression
    design = _lagged(w, long, long)
    guess = np.zeros(n)
    guess[long:] = w[long:] - design @ np.linalg.lstsq(design, w[long:], rcond=None)[0]
    best = None
    for p, q in ORDERS:
        start = long + max(p, q)
        parts = [_lagged(w, p, start)] if p else []
        parts += [_lagged(guess, q, start)] if q else []
        coef = np.zeros(0)
        if parts:
            coef = np.linalg.lstsq(np.hstack(parts), w[start:], rcond=None)[0]
        phi, theta = coef[:p], coef[p:]
        if not (_stable(phi, 1.0) and _stable(theta, -1.0)):
            continue
        e = _shocks(w, phi, theta)
        var = max(float(e @ e) / n, 1e-12)
        loglik = -0.5 * n * (np.log(2 * np.pi * var) + 1)
        aic = -2 * loglik + 2 * (p + q + 2)
        if best is None or aic < best[0]:
            best = (aic, loglik, var, phi, theta, e)
    return best


def _kpss(x: np.ndarray) -> float:
    e = x - x.mean()
    n, lags = len(e), int(4 * (len(e) / 100) ** 0.25)
    long_run = e @ e / n
    for k in range(1, lags + 1):
        long_run += 2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / n
    return float((np.cumsum(e) ** 2).sum() / (n * n * max(long_run, 1e-12)))


def _flat(pdf: pd.DataFrame, daily: pd.DataFrame, y: np.ndarray, slopes: int) -> dict:
    """Mean and spread of a series that is too short for more; no spread for one day."""
    var = float(y.var(ddof=1)) if len(y) > 1 else None
    return {
        "id_canal": int(pdf["id_canal"].iloc[0]), "non_seasonal_p": 0, "non_seasonal_d": None,
        "non_seasonal_q": 0, "has_drift": None, "log_likelihood": None, "AIC": None, "variance": var,
        "seasonal_periods": "NO_SEASONALITY", "has_spikes_and_dips": None, "has_step_changes": None,
        "last_ds": daily.index[-1].date(), "weekday": np.full(7, y.mean()), "yearly": [],
        "slopes": np.zeros(slopes), "phi": [], "theta": [], "drift": 0.0, "level": 0.0,
        "recent": [], "shocks": [],
    }


def _fit(pdf: pd.DataFrame, slopes: int, needs: Needs) -> pd.DataFrame:
    """Orders and state of what the regression leaves over."""
    pdf = pdf.assign(ds=pd.to_datetime(pdf["ds"])).set_index("ds").sort_index()
    daily = pdf[["y", "rest"]].astype(float).asfreq("D").interpolate(limit_direction="both")
    rest, n = daily["rest"].to_numpy(), len(daily)
    if n < needs.week or not np.isfinite(rest).all():
        known = daily["y"].to_numpy()
        known = known[np.isfinite(known)]
        return pd.DataFrame([_flat(pdf, daily, known if len(known) else np.zeros(1), slopes)])
    weekday, yearly, extra = np.split(np.asarray(pdf["coef"].iloc[0], dtype=float), [7, 7 + 2 * needs.waves])
    d = int(_kpss(rest) > KPSS_LIMIT) if n >= needs.difference else None
    w = np.diff(rest) if d else rest
    mean = float(w.mean())
    aic, loglik, var, phi, theta, e = _arma(w - mean)
    sigma = np.sqrt(var)
    # A differenced series drifts only if its mean step stands out from its errors.
    trend = bool(d and abs(mean) > 2 * sigma / np.sqrt(len(w)))
    drift = mean if trend or not d else 0.0
    steps = None
    if n >= needs.steps:
        month = np.convolve(rest, np.ones(30) / 30, mode="valid")
        steps = bool((np.abs(month[30:] - month[:-30]) > 2 * rest.std()).any())
    return pd.DataFrame([{
        "id_canal": int(pdf["id_canal"].iloc[0]),
        "non_seasonal_p": len(phi), "non_seasonal_d": d, "non_seasonal_q": len(theta),
        "has_drift": None if d is None else trend,
        "log_likelihood": loglik, "AIC": aic, "variance": var,
        "seasonal_periods": "WEEKLY,YEARLY" if n >= needs.yearly else "WEEKLY",
        "has_spikes_and_dips": bool((np.abs(e) > 4 * sigma).any()), "has_step_changes": steps,
        "last_ds": daily.index[-1].date(),
        "weekday": weekday, "yearly": yearly, "slopes": extra, "phi": phi, "theta": theta,
        "drift": drift, "level": float(rest[-1]),
        "recent": (w - mean)[::-1][:2], "shocks": e[::-1][:2],
    }])


def regression(series: DataFrame, value: str = "ventas_netas_soles", regressors: tuple[str, ...] = (),
               needs: Needs = Needs()) -> DataFrame:
    """Weekday levels, yearly wave and slopes of every series: id_canal, n, coef."""
    span = series.groupBy("id_canal").agg((F.datediff(F.max("ds"), F.min("ds")) + 1).alias("_span"))
    rows = series.join(span, "id_canal")
    columns = regress.daily_design("ds", needs.waves, regressors, F.col("_span") >= needs.yearly)
    return regress.fit(rows, "id_canal", columns, F.col(value).cast(regress.AMOUNT))


def slopes(coefficients: DataFrame, regressors: tuple[str, ...], needs: Needs = Needs()) -> DataFrame:
    """What one more of each regressor adds to a day's value, by series."""
    first = 7 + 2 * needs.waves
    return coefficients.select("id_canal", "n", *[
        F.get("coef", F.lit(first + i)).alias(r) for i, r in enumerate(regressors)])


def fit(series: DataFrame, value: str = "ventas_netas_soles",
        regressors: tuple[str, ...] = (), needs: Needs = Needs()) -> DataFrame:
    """One model row per series; without ``regressors`` the first model version, else the second.

    Levels and slopes are solved from sums in Spark; a group holds what they leave over. A
    series whose fit fails for numerical reasons gets mean and spread, so it does not
    fail the others.
    """
    count = len(regressors)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return _fit(pdf, count, needs)
        except np.linalg.LinAlgError:
            return _fit(pdf, count, Needs(week=len(pdf) * 2 + 10 ** 6))

    # One row per series. Written, so that the planner does not carry the elimination along.
    coefficients = as_table(regression(series, value, regressors, needs).select("id_canal", "coef"), "coef")
    columns = regress.daily_design("ds", needs.waves, regressors)
    explained = F.aggregate(
        F.zip_with(F.array(*[c.cast("double") for c in columns.values()]), F.col("coef"), lambda a, b: a * b),
        F.lit(0.0), lambda a, b: a + b)
    y = F.col(value).cast("double")
    rows = series.join(coefficients, "id_canal", "left").select(
        "id_canal", "ds", y.alias("y"), (y - explained).alias("rest"), "coef")
    return rows.groupBy("id_canal").applyInPandas(one, MODEL_SCHEMA)


def evaluate(models: DataFrame) -> DataFrame:
    return models.select(
        "id_canal", "non_seasonal_p", "non_seasonal_d", "non_seasonal_q", "has_drift",
        "log_likelihood", "AIC", "variance", "seasonal_periods", "has_spikes_and_dips",
        "has_step_changes",
    )


def _predict(model: pd.Series, dates: pd.DatetimeIndex, extra: np.ndarray, z: float) -> pd.DataFrame:
    h = len(dates)
    phi, theta = np.asarray(model["phi"]), np.asarray(model["theta"])
    past, shocks = list(model["recent"]), list(model["shocks"])
    path, weights = np.zeros(h), np.zeros(h)
    for t in range(h):
        shock_part = sum(c * shocks[j - t] for j, c in enumerate(theta) if j - t >= 0)
        path[t] = sum(c * past[i] for i, c in enumerate(phi)) + shock_part
        past.insert(0, path[t])
        weights[t] = 1.0 if t == 0 else sum(
            c * weights[t - i] for i, c in enumerate(phi, start=1) if t >= i
        ) + (theta[t - 1] if t <= len(theta) else 0.0)
    path += model["drift"]
    if model["non_seasonal_d"] == 1:
        path, weights = model["level"] + np.cumsum(path), np.cumsum(weights)
    slopes = np.asarray(model["slopes"], dtype=float)
    value = path + np.asarray(model["weekday"])[dates.dayofweek]
    yearly = np.asarray(model["yearly"], dtype=float)
    value = value + _wave(dates, len(yearly) // 2) @ yearly
    if len(slopes):
        value = value + extra @ slopes
    variance = np.nan if pd.isna(model["variance"]) else model["variance"]
    error = np.sqrt(variance * np.cumsum(weights ** 2))
    return pd.DataFrame({
        "id_canal": model["id_canal"], "forecast_timestamp": dates.date, "forecast_value": value,
        "standard_error": error, "prediction_interval_lower_bound": value - z * error,
        "prediction_interval_upper_bound": value + z * error,
    })


def forecast(models: DataFrame, horizon: int = 90, confidence: float = 0.9) -> DataFrame:
    """The next ``horizon`` days of every series fitted without regressors."""
    z = half_width(confidence)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, model in batch.iterrows():
                dates = pd.date_range(
                    pd.Timestamp(model["last_ds"]) + pd.Timedelta(days=1), periods=horizon)
                yield _predict(model, dates, np.zeros((horizon, 0)), z)

    return models.mapInPandas(run, FORECAST_SCHEMA)


def forecast_with(models: DataFrame, future: DataFrame, regressors: tuple[str, ...],
                  confidence: float = 0.9) -> DataFrame:
    """Forecast over the days in ``future`` with its regressor values.

    The models are not fitted again, so ``future`` may hold a what-if plan. A
    group is one model row and its days ahead.
    """
    z, names = half_width(confidence), list(regressors)

    def run(model: pd.DataFrame, ahead: pd.DataFrame) -> pd.DataFrame:
        if model.empty or ahead.empty:
            return pd.DataFrame()
        ahead = ahead.sort_values("ds")
        dates = pd.DatetimeIndex(pd.to_datetime(ahead["ds"]))
        return _predict(model.iloc[0], dates, ahead[names].to_numpy(dtype=float), z)

    return models.groupBy("id_canal").cogroup(
        future.select("id_canal", "ds", *names).groupBy("id_canal")
    ).applyInPandas(run, FORECAST_SCHEMA)


def same_weekday(series: DataFrame, value: str = "ventas_netas_soles", weeks: int = 4) -> DataFrame:
    """The next seven days of every series: mean of the same weekday in its last weeks.

    The yardstick for fitted models. The band is what these days have ranged over.
    """
    last = series.groupBy("id_canal").agg(F.max("ds").alias("_last"))
    recent = series.join(last, "id_canal").where(F.datediff("_last", "ds") < 7 * weeks)
    ahead = F.expr("date_add(ds, cast(7 * (datediff(_last, ds) div 7 + 1) as int))")
    exact = F.col(value).cast("decimal(18,2)")
    return recent.groupBy("id_canal", ahead.alias("forecast_timestamp")).agg(
        rounded_money(mean(exact)).alias("forecast_value"),
        F.min(exact).alias("prediction_interval_lower_bound"),
        F.max(exact).alias("prediction_interval_upper_bound"))


def explain(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """Parts of past days, and of the days ahead with their band, in one table.

    ``history`` are components. A part means the same in both halves: the weekday part ahead is that
    of the past, the step part stays where the past left it, holidays add what they added, and
    the trend is the rest of the forecast. Spikes and remainders are not foreseen.
    """
    double = lambda names: [F.col(c).cast("double").alias(c) for c in names]
    past = history.select(
        "id_canal", F.col("ds").alias("fecha"), F.lit("history").alias("tipo"), *double(["valor", *series.PARTS]),
        *[F.lit(None).cast("double").alias(c) for c in ("lim_inf", "lim_sup")])
    # One row per series and weekday, and one per series.
    week = history.groupBy("id_canal", F.weekday("ds").alias("_wd")).agg(F.max("estacionalidad").alias("estacionalidad"))
    last = history.groupBy("id_canal").agg(
        F.max_by("escalon", "ds").alias("escalon"),
        F.max(F.when(F.col("feriado") != 0, F.col("feriado"))).alias("_special"))
    special = calendar.holidays(predicted.select(F.col("forecast_timestamp").alias("fecha")).distinct())
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    ahead = (
        predicted.withColumn("_wd", F.weekday("forecast_timestamp"))
        .join(week, ["id_canal", "_wd"], "left").join(last, "id_canal", "left")
        .join(special.select(F.col("fecha").alias("forecast_timestamp"), F.lit(True).alias("_is")).distinct(),
              "forecast_timestamp", "left")
        .select(
            "id_canal", F.col("forecast_timestamp").alias("fecha"), F.lit("forecast").alias("tipo"),
            F.col("forecast_value").alias("valor"), zero(F.col("estacionalidad")).alias("estacionalidad"),
            zero(F.when(F.col("_is"), F.col("_special"))).alias("feriado"), F.lit(0.0).alias("pico"),
            zero(F.col("escalon")).alias("escalon"), F.lit(0.0).alias("residuo"),
            F.col("prediction_interval_lower_bound").alias("lim_inf"),
            F.col("prediction_interval_upper_bound").alias("lim_sup")))
    parts = F.col("estacionalidad") + F.col("feriado") + F.col("escalon")
    return past.unionByName(ahead.withColumn("tendencia", F.col("valor") - parts))


# -- reports ------------------------------------------------------------------------


def named_forecast(predicted: DataFrame, channels: DataFrame) -> DataFrame:
    return predicted.join(channels.select("id_canal", "nombre_canal"), "id_canal").select(
        "id_canal", "nombre_canal", F.col("forecast_timestamp").alias("fecha"),
        F.col("forecast_value").alias("venta_pronostico"),
        F.col("prediction_interval_lower_bound").alias("lim_inf"),
        F.col("prediction_interval_upper_bound").alias("lim_sup"),
    )


def named_history(series: DataFrame, channels: DataFrame) -> DataFrame:
    return series.join(channels.select("id_canal", "nombre_canal"), "id_canal").select(
        "id_canal", "nombre_canal", F.col("ds").alias("fecha"), "ventas_netas_soles")


def total_by_day(named: DataFrame) -> DataFrame:
    return named.groupBy("fecha").agg(
        F.sum("venta_pronostico").alias("venta"), F.sum("lim_inf").alias("lim_inf"),
        F.sum("lim_sup").alias("lim_sup"),
    ).orderBy("fecha")


def summary_by_channel(named: DataFrame) -> DataFrame:
    """Mean daily forecast and half width of its band."""
    means = named.groupBy("nombre_canal").agg(
        mean("venta_pronostico").alias("media"), mean("lim_sup").alias("_sup"))
    return means.select(
        "nombre_canal", rounded("media", 2).alias("venta_diaria_media"),
        rounded(F.col("_sup") - F.col("media"), 2).alias("ic_90"),
    )
