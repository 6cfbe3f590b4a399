"""The calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom.functions import dates as d


def days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(span).alias("fecha"))


def days_covering(facts: DataFrame, column: str) -> DataFrame:
    """Every day of the years a fact covers; the range is one small aggregate."""
    first = F.trunc(F.min(column), "year")
    last = F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1)
    return facts.agg(F.sequence(first, last).alias("_s")).select(F.explode("_s").alias("fecha"))


def holidays(days: DataFrame) -> DataFrame:
    """(fecha, nombre) for the holidays of every year present in ``days``."""
    years = days.select(F.year("fecha").alias("anio")).distinct()
    easter = d.easter_sunday(F.col("anio"))
    listed = [
        F.struct(F.make_date("anio", F.lit(m), F.lit(day)).alias("fecha"), F.lit(name).alias("nombre"))
        for m, day, name in d.FIXED_HOLIDAYS
    ] + [
        F.struct(F.date_add(easter, shift).alias("fecha"), F.lit(name).alias("nombre"))
        for shift, name in d.EASTER_HOLIDAYS
    ]
    return years.select(F.inline(F.array(*listed)))


def calendar(days: DataFrame, special: DataFrame | None = None) -> DataFrame:
    """One row per day with the 18 calendar attributes.

    ``special`` is a (fecha, nombre) frame of holidays; by default they follow
    from the years in ``days``. Its size is bounded by the calendar range.
    """
    marked = days.join(
        F.broadcast(special if special is not None else holidays(days)), "fecha", "left"
    )
    f, weekday = F.col("fecha"), F.dayofweek("fecha")
    weekend, holiday = weekday.isin(1, 7), F.col("nombre").isNotNull()
    week = d.sunday_week(f)
    return marked.select(
        d.date_key(f).alias("id_fecha"),
        "fecha",
        F.year(f).cast("bigint").alias("anio"),
        F.concat(F.lit("Q"), F.quarter(f)).alias("trimestre"),
        F.month(f).cast("bigint").alias("mes"),
        d.name_from(d.MONTHS, F.month(f)).alias("mes_nombre"),
        week.alias("semana_anio"),
        F.dayofmonth(f).cast("bigint").alias("dia_mes"),
        weekday.cast("bigint").alias("dia_semana"),
        d.name_from(d.WEEKDAYS, weekday).alias("nombre_dia"),
        F.when(weekend, 1).otherwise(0).alias("es_fin_semana"),
        F.when(holiday, 1).otherwise(0).alias("es_feriado"),
        F.col("nombre").alias("nombre_feriado"),
        d.period_key(f).alias("periodo"),
        F.date_format(f, "yyyy-MM").alias("anio_mes"),
        F.ceil(F.month(f) / 6).cast("bigint").alias("semestre"),
        F.concat(F.lit("S"), F.lpad(week.cast("string"), 2, "0"), F.lit("-"), F.year(f))
        .alias("semana_label"),
        F.when(~weekend & ~holiday, 1).otherwise(0).alias("es_dia_habil"),
    )
