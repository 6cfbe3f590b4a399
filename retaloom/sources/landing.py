"""Delivered CSV files: dated folders and master snapshots."""

from __future__ import annotations

import re
from collections.abc import Collection
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from retaloom.functions.text import FOLDER_DATE, folder_date

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def listed(paths: DataFrame) -> DataFrame:
    """(fecha_particion, archivo_origen) of the files in dated folders; others are ignored."""
    return paths.select(
        folder_date(F.col("path")).alias("fecha_particion"), F.col("path").alias("archivo_origen")
    ).where(F.col("fecha_particion").isNotNull())


def date_folders(spark: SparkSession, root: str, source: str) -> dict[date, list[str]]:
    """Folders by delivery date. Only names are listed: one entry per date, no files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{source}")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[date, list[str]] = {}
    for entry in files.listStatus(where) if files.exists(where) else ():
        digits = re.search(FOLDER_DATE, f"/{entry.getPath().getName()}/")
        try:
            day = datetime.strptime(digits[1], "%Y%m%d").date() if digits else None
        except ValueError:
            day = None
        if day and entry.isDirectory():
            found.setdefault(day, []).append(entry.getPath().toString())
    return found


def deliveries(spark: SparkSession, root: str, source: str,
               days: Collection[date] | None = None) -> DataFrame:
    """Files delivered so far, or for some dates. Only names are read: the content is pruned."""
    folders = [f for day, own in date_folders(spark, root, source).items()
               if days is None or day in days for f in own]
    if not folders:
        return spark.createDataFrame([], "fecha_particion date, archivo_origen string")
    return listed(spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folders))


def last_files(files: DataFrame) -> dict[date, str]:
    """The file of each date whose name comes last."""
    last = files.groupBy("fecha_particion").agg(F.max("archivo_origen").alias("f"))
    return {row["fecha_particion"]: row["f"] for row in last.collect()}


def read_files(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows of files or folders with their delivery date and file. Header names are checked
    against the schema."""
    rows = spark.read.csv(
        paths, schema=schema, header=True, enforceSchema=False, mode="FAILFAST",
        pathGlobFilter="*.csv", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    path = F.col("_metadata.file_path")
    return rows.select("*", folder_date(path).alias("fecha_carga"), path.alias("archivo_origen"))


def bad_dates(spark: SparkSession, paths: list[str], schema: str) -> dict[date, str]:
    """Dates with a file that lacks its header or has a row that does not parse, and an example.

    One pass over all files: rows that do not parse are kept as text, among them the headers.
    """
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    rows = spark.read.csv(
        paths, schema=f"{schema}, _line string", header=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_line", pathGlobFilter="*.csv",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    line = F.coalesce("_line", F.concat_ws(",", *[F.col(n).cast("string") for n in names]))
    header = F.lower(F.regexp_replace(line, '"', "")) == ",".join(names).lower()
    path = F.col("_metadata.file_path")
    files = rows.select(path.alias("f"), header.alias("h"), F.col("_line").alias("l")).groupBy("f").agg(
        F.max("h").alias("headed"), F.max(F.when(~F.col("h"), F.col("l"))).alias("example"))
    wrong = files.where(~F.col("headed") | F.col("example").isNotNull()).select(
        folder_date(F.col("f")).alias("d"), F.concat(
            F.lit("file "), "f", F.lit(": "), F.coalesce("example", F.lit("no header"))).alias("m"))
    return {row["d"]: row["m"] for row in wrong.groupBy("d").agg(F.max("m").alias("m")).collect()}


def read_master(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A master file with the time of its load."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False).withColumn(
        "fecha_snapshot", F.current_timestamp())
