"""Daily series per channel: training tables, regressors and decomposition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.functions.numbers import ratio
from retaloom.plans import calendar

STEP = "decimal(18,4)"


def daily_series(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Net sales, promotion spend and holiday flag per day and channel.

    Sales are reduced to one row per day and channel before the calendar is joined.
    """
    per_day = fact.groupBy("id_fecha", "id_canal").agg(
        F.sum("ventas_netas_soles").alias("ventas_netas_soles"),
        F.sum("inversion_promocional_soles").alias("inversion_promo"),
    )
    return per_day.join(F.broadcast(days.select("id_fecha", "fecha", "es_feriado")), "id_fecha").select(
        F.col("fecha").alias("ds"), "id_canal", "ventas_netas_soles", "inversion_promo", "es_feriado")


def sales_only(series: DataFrame) -> DataFrame:
    """The series without regressors."""
    return series.select("ds", "id_canal", "ventas_netas_soles")


def future_regressors(series: DataFrame, horizon: int = 90, start: str | None = None) -> DataFrame:
    """Regressors for the days to forecast, per channel.

    Promotion spend is planned at the channel's historic mean for the calendar
    month (0 without history); holidays follow from the dates. The days start at
    ``start``, by default the day after the last one of the channel. Each channel
    unfolds its own days: no cross join.
    """
    first = F.lit(start).cast("date") if start else F.date_add(F.max("ds"), 1)
    days = series.groupBy("id_canal").agg(first.alias("_first")).select(
        "id_canal",
        F.explode(F.sequence("_first", F.date_add("_first", horizon - 1))).alias("ds"),
    )
    promo = series.groupBy("id_canal", F.month("ds").alias("_mes")).agg(
        ratio(F.sum("inversion_promo"), F.count("inversion_promo")).alias("_promo"))
    special = calendar.holidays(days.select(F.col("ds").alias("fecha")))
    return (
        days.withColumn("_mes", F.month("ds"))
        .join(promo, ["id_canal", "_mes"], "left")
        .join(special, F.col("ds") == F.col("fecha"), "left")
        .select(
            "ds", "id_canal",
            F.coalesce("_promo", F.lit(0.0)).alias("inversion_promo"),
            F.when(F.col("fecha").isNotNull(), 1).otherwise(0).alias("es_feriado"),
        )
    )


def decompose(series: DataFrame, key: str = "id_canal", value: str = "ventas_netas_soles") -> DataFrame:
    """Trend (centred 7-row mean), weekday effect and remainder of each series.

    The windows run within one series, whose length is bounded by the calendar.
    Components are decimals, so they add up to the value exactly.
    """
    in_order = Window.partitionBy(key).orderBy("ds").rowsBetween(-3, 3)
    y = F.col(value).cast(STEP)
    step = lambda c: F.round(c.cast("decimal(38,10)"), 4).cast(STEP)
    trended = series.select(
        key, "ds", y.alias("valor"),
        step(ratio(F.sum(value).over(in_order), F.count(value).over(in_order))).alias("tendencia"),
    ).withColumn("_wd", F.dayofweek("ds"))
    gap = F.col("valor") - F.col("tendencia")
    same_day = Window.partitionBy(key, "_wd")
    seasonal = step(ratio(F.sum(gap).over(same_day), F.count(gap).over(same_day)))
    return trended.withColumn("estacionalidad", seasonal).select(
        key, "ds", "valor", "tendencia", "estacionalidad",
        (gap - F.col("estacionalidad")).alias("residuo"),
    )


PARTS = ("tendencia", "estacionalidad", "feriado", "pico", "escalon", "residuo")
NEAR = 7  # rows on each side among which a spike must stand out
SIDE = 28  # rows on each side of a step
SPIKE, JUMP = 6, 6  # times the usual deviation


def components(series: DataFrame, key: str = "id_canal", value: str = "ventas_netas_soles") -> DataFrame:
    """Trend, weekday, holiday, spike and step part of each day, and what they leave over.

    The weekday part is that of ``decompose``; the holiday part is what holidays of the series
    leave over on the mean. A spike is a remainder further from the median of its neighbours than
    ``SPIKE`` times their median deviation. A step is a day after which the mean of ``SIDE`` days differs
    from that of the days before by more than ``JUMP`` standard errors, and by more than on any
    day around; its size stays in the step part from then on, and is taken out of the trend.
    Every window runs within one series, whose length is bounded by the calendar. All parts
    are decimals and add up to the value exactly; a series without ups and downs has neither.
    """
    if "es_feriado" not in series.columns:
        special = calendar.holidays(series.select(F.col("ds").alias("fecha")).distinct())
        days = special.select(F.col("fecha").alias("ds"), F.lit(1).alias("es_feriado")).distinct()
        series = series.join(days, "ds", "left")
    in_order = Window.partitionBy(key).orderBy("ds")
    among = in_order.rowsBetween(-NEAR, NEAR)
    before, after = in_order.rowsBetween(-SIDE, -1), in_order.rowsBetween(0, SIDE - 1)
    step = lambda c: F.round(c.cast("decimal(38,10)"), 4).cast(STEP)
    average = lambda c, w: step(ratio(F.sum(c).over(w), F.count(c).over(w)))
    middle = lambda a: F.element_at(F.array_sort(a), F.expr("cast((_near + 1) div 2 as int)"))

    parted = (
        decompose(series, key, value)
        .join(series.select(key, "ds", (F.coalesce("es_feriado", F.lit(0)) == 1).alias("_special")), [key, "ds"])
        .withColumn("_gap", F.col("valor") - F.col("tendencia") - F.col("estacionalidad"))
    )
    on_special = F.when(F.col("_special"), F.col("_gap"))
    whole = Window.partitionBy(key)
    parted = parted.withColumn("feriado", F.when(F.col("_special"), average(on_special, whole)).otherwise(
        F.lit(0).cast(STEP))).withColumn("_rest", (F.col("_gap") - F.col("feriado")).cast(STEP))

    parted = parted.withColumn("_around", F.collect_list("_rest").over(among)).withColumn(
        "_near", F.size("_around")).withColumn("_median", middle(F.col("_around"))).withColumn(
        "_usual", middle(F.transform("_around", lambda a: F.abs(a - F.col("_median")))))
    off = F.col("_rest") - F.col("_median")
    parted = parted.withColumn("pico", F.when(F.abs(off) > F.col("_usual") * SPIKE, off).otherwise(0).cast(STEP))

    parted = parted.withColumn("_level", (
        F.col("valor") - F.col("estacionalidad") - F.col("feriado") - F.col("pico")).cast(STEP))
    left = F.col("_rest") - F.col("pico")
    full = (F.count("_level").over(before) == SIDE) & (F.count("_level").over(after) == SIDE)
    parted = parted.withColumn("_jump", F.when(full, average("_level", after) - average("_level", before)).cast(STEP))
    parted = parted.withColumn("_noise", average(F.abs(left), whole))
    size = F.abs("_jump")
    # The mean deviation of a normal remainder is 0.8 of its standard one; a difference of two means
    # of SIDE days has sqrt(2 / SIDE) of that.
    limit = F.col("_noise") * F.lit(round(JUMP * 1.25 * (2 / SIDE) ** 0.5, 4)).cast("decimal(8,4)")
    first = (size > F.coalesce(F.max(size).over(in_order.rowsBetween(-SIDE, -1)), F.lit(-1))) & (
        size >= F.coalesce(F.max(size).over(in_order.rowsBetween(1, SIDE)), F.lit(-1)))
    parted = parted.withColumn("_step", F.when((size > limit) & first, F.col("_jump")).otherwise(0).cast(STEP))
    so_far = F.sum("_step").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).cast(STEP)
    return parted.withColumn("escalon", so_far).select(
        key, "ds", "valor", (F.col("tendencia") - F.col("escalon")).cast(STEP).alias("tendencia"),
        "estacionalidad", "feriado", "pico", "escalon", left.cast(STEP).alias("residuo"))


def regression_sums(series: DataFrame) -> DataFrame:
    """Sufficient statistics of sales on promotion spend and holidays, per channel."""
    y, x, h = (F.col(c).cast("decimal(16,2)") for c in
               ("ventas_netas_soles", "inversion_promo", "es_feriado"))

    def add(c: Column, name: str) -> Column:
        return F.sum(c).alias(name)

    return series.groupBy("id_canal").agg(
        F.count(F.lit(1)).alias("n"), add(y, "s_y"), add(x, "s_x"), add(h, "s_h"),
        add(x * x, "s_xx"), add(h * h, "s_hh"), add(x * h, "s_xh"),
        add(x * y, "s_xy"), add(h * y, "s_hy"), add(y * y, "s_yy"),
    )


SUMS = ("s_y", "s_x", "s_h", "s_xx", "s_hh", "s_xh", "s_xy", "s_hy", "s_yy")
LONG = 2**63 - 1


def whole_sums(sums: DataFrame) -> DataFrame:
    """Sufficient statistics rounded to whole numbers: a column is a long if all its values
    fit, else decimal(38,0), as sums of squares outgrow a long first. ``sums`` is read twice."""
    whole = {c: F.round(c, 0).cast("decimal(38,0)") for c in SUMS}
    most = sums.agg(*[F.max(F.abs(whole[c])).alias(c) for c in SUMS]).first()
    return sums.select("id_canal", "n", *[
        (whole[c].cast("bigint") if (most[c] or 0) <= LONG else whole[c]).alias(c) for c in SUMS])
