"""Text rules that Spark does not come with."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed pattern: a delivery folder is named by the eight digits of its day, optionally with
# the name of a partition column and an equals sign before them.
FOLDER_DATE = r"/(?:\w+=)?(\d{8})/"


def strip_suffix(c: Column, suffix: str) -> Column:
    # \z, not $, which also matches before a final line break.
    return F.regexp_replace(c, re.escape(suffix) + r"\z", "")


def trailing_number(c: Column) -> Column:
    """Number formed by the last digits of a code; NULL when there are none."""
    return F.regexp_substr(c, F.lit(r"\d+\z")).try_cast("bigint")


def trim_all(c: Column) -> Column:
    """Trim every kind of white space (``trim`` only removes blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+\z", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (trim_all(c) == "")


def is_missing(c: Column) -> Column:
    """NULL or exactly the empty string."""
    return c.isNull() | (c == "")


def fill_missing(c: Column, value: str, empty_is_null: bool = False) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")) if empty_is_null else c, F.lit(value))


def folder_date(path: Column) -> Column:
    """Delivery date from a file path; NULL when the folder is not a date."""
    digits = F.regexp_extract(path, FOLDER_DATE, 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")
