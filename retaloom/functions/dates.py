"""Calendar attributes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month and day names, January and Sunday first.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
    "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
WEEKDAYS = ("Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado")

# Holidays with a fixed date, as (month, day, name).
FIXED_HOLIDAYS = (
    (1, 1, "Año Nuevo"),
    (5, 1, "Día del Trabajo"),
    (6, 29, "San Pedro y San Pablo"),
    (7, 28, "Fiestas Patrias"),
    (7, 29, "Fiestas Patrias"),
    (8, 30, "Santa Rosa de Lima"),
    (10, 8, "Combate de Angamos"),
    (11, 1, "Todos los Santos"),
    (12, 8, "Inmaculada Concepción"),
    (12, 25, "Navidad"),
)
# Holidays that move with Easter Sunday, as (days after, name).
EASTER_HOLIDAYS = ((-3, "Jueves Santo"), (-2, "Viernes Santo"))


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def period_key(d: Column) -> Column:
    return (F.year(d) * 100 + F.month(d)).cast("bigint")


def sunday_week(d: Column) -> Column:
    """Week of the year, weeks starting on Sunday; days before the first are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def name_from(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def easter_sunday(year: Column) -> Column:
    """Western Easter by the anonymous Gregorian rule, in integer column arithmetic."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    golden = year % 19
    century, in_century = div(year, 100), year % 100
    leap_skips, leap_rest = div(century, 4), century % 4
    moon_shift = div(century - div(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - leap_skips - moon_shift + 15) % 30
    weekday = (F.lit(32) + leap_rest * 2 + div(in_century, 4) * 2 - epact - in_century % 4) % 7
    correction = div(golden + epact * 11 + weekday * 22, 451)
    days = epact + weekday - correction * 7 + 114
    return F.make_date(year, div(days, 31), days % 31 + 1)
