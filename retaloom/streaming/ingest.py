"""Incremental load of dated deliveries, as a batch and as a stream.

A load writes whole delivery dates: it reads every file of the new dates and
replaces their partitions in one commit, then records the committed row counts per
file. Repeating a load after a crash at any point gives the same table and no
second audit row for a date that was recorded.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from retaloom.plans.audit import ERROR, OK, AuditLog
from retaloom.sources import landing, tables

PARTITION = "fecha_carga"


def _same(path: Column) -> Column:
    """One spelling per file: listings and file metadata differ in slashes and escapes."""
    plus = F.regexp_replace(path, r"\+", "%2B")
    return F.regexp_replace(F.coalesce(F.try_url_decode(plus), path), r"^(\w+):/+", r"$1:/")


def _load(spark: SparkSession, source: str, files: DataFrame, paths: list[str], dates: list[date],
          schema: str, table: str, log: AuditLog) -> None:
    rows = landing.read_files(spark, paths, schema)
    # A date delivered without rows replaces what it had before by nothing.
    tables.replace_partitions(
        rows, table, PARTITION, gone=lambda there: {d.isoformat() for d in dates} - there)
    # counted from the committed partitions of these dates only
    counts = (
        tables.read_table(spark, table).where(F.col(PARTITION).isin(dates))
        .groupBy(_same(F.col("archivo_origen")).alias("_file"))
        .agg(F.count(F.lit(1)).alias("registros_cargados"))
    )
    mine = files.where(F.col("fecha_particion").isin(dates))
    log.append_files(source, "INCREMENTAL", mine.join(
        counts, _same(F.col("archivo_origen")) == F.col("_file"), "left").select(
        "archivo_origen", "fecha_particion",
        F.coalesce("registros_cargados", F.lit(0)).cast("bigint").alias("registros_cargados")))


def load_dates(spark: SparkSession, source: str, files: DataFrame, paths: dict[date, list[str]],
               schema: str, table: str, log: AuditLog) -> set[date]:
    """Load all dates in one job, from all files or the given ones; gives the dates that failed.

    If the job fails, one pass finds the dates with bad files; these are recorded as
    errors and the others loaded together. If no file is to blame, all dates are errors.
    """
    def load(days: list[date]) -> None:
        chosen = [p for d in days for p in paths[d]]
        _load(spark, source, files, chosen, days, schema, table, log)

    days = sorted(paths)
    if not days:
        return set()
    try:
        load(days)
        return set()
    except Exception as error:
        reasons = landing.bad_dates(spark, [p for d in days for p in paths[d]], schema)
        first = str(error)
    good = [d for d in days if d not in reasons]
    if not reasons:
        reasons = dict.fromkeys(days, first)
    elif good:
        try:
            load(good)
        except Exception as error:
            reasons |= dict.fromkeys(good, str(error))
    log.append([{
        "tabla_destino": source, "archivo_origen": paths[d][0], "fecha_particion": d,
        "tipo": "INCREMENTAL", "estado": ERROR, "mensaje_error": reasons[d],
    } for d in sorted(reasons)])
    return set(reasons)


def ingest(spark: SparkSession, root: str, source: str, schema: str, table: str, log: AuditLog,
           replace: bool = False, last_file_only: bool = False,
           only: set[date] | None = None) -> dict[str, int]:
    """Load the dates not recorded as done (all dates with ``replace``), or those among ``only``.

    Folder names are listed, files only below the dates to load. A file that arrives late
    for a recorded date is ignored unless ``replace``. Gives the number of files
    loaded, failed, and passed over because they were loaded before.
    """
    folders = landing.date_folders(spark, root, source)
    done = set() if replace else log.done_dates(source)
    paths = {d: own for d, own in folders.items() if d not in done and (only is None or d in only)}
    files = landing.deliveries(spark, root, source, set(paths))
    if last_file_only:
        paths = {d: [f] for d, f in landing.last_files(files).items()}
        files = files.groupBy("fecha_particion").agg(F.max("archivo_origen").alias("archivo_origen"))
    else:  # a dated folder may be without files
        have = {row[0] for row in files.select("fecha_particion").distinct().collect()}
        paths = {d: own for d, own in paths.items() if d in have}
    failed = load_dates(spark, source, files, paths, schema, table, log)
    total = files.count()
    bad = files.where(F.col("fecha_particion").isin(failed)).count() if failed else 0
    skipped = 0
    if done & set(folders):
        skipped = log.loaded_files(source).where(
            F.col("fecha_particion").isin(done & set(folders))).count()
    return {"exitosos": total - bad, "errores": bad, "omitidos": skipped}


def watch(spark: SparkSession, root: str, source: str, schema: str, table: str, log: AuditLog,
          checkpoint: str, replace: bool = False) -> StreamingQuery:
    """The same load driven by a file stream that reports new file names.

    The stream carries names only. A micro-batch names the dates to load; their
    folders are then read whole, so a date split over micro-batches, or delivered
    again, is never stored in part.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        days = {row[0] for row in landing.listed(batch).select("fecha_particion").distinct().collect()}
        ingest(spark, root, source, schema, table, log, replace, only=days)

    names = (
        spark.readStream.format("binaryFile").schema(landing.LISTING)
        .option("pathGlobFilter", "*.csv").load(f"{root}/{source}/*").select("path")
    )
    return (
        names.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def snapshot(spark: SparkSession, path: str, name: str, schema: str, table: str,
             log: AuditLog) -> bool:
    """Replace a master by its current file."""
    try:
        tables.write_table(landing.read_master(spark, path, schema), table)
        n = tables.read_table(spark, table).count()  # from file footers
        log.append([{"tabla_destino": name, "archivo_origen": path, "tipo": "SNAPSHOT",
                     "estado": OK, "registros_cargados": n}])
        return True
    except Exception as error:
        log.append([{"tabla_destino": name, "archivo_origen": path, "tipo": "SNAPSHOT",
                     "estado": ERROR, "mensaje_error": str(error)}])
        return False
