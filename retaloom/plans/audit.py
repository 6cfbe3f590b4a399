"""The audit log and the step runner that writes it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timezone
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from retaloom.schemas import LAYER_AUDIT, RAW_AUDIT
from retaloom.sources import commits
from retaloom.sources.tables import create_empty

OK, ERROR = "EXITOSO", "ERROR"
MESSAGE_LENGTH = 1024
AT_ONCE = 4  # tables written at the same time


class AuditLog:
    """An append-only table with one row per loaded file or refreshed table.

    It is laid out by the table that a row is about, so a question about one table reads its rows
    only, and folds small files: any number of loads leaves a bounded number of them.
    """

    BY = "tabla_destino"

    def __init__(self, spark: SparkSession, path: str, raw: bool = False):
        self.spark, self.path, self.raw = spark, path, raw
        self.schema = RAW_AUDIT if raw else LAYER_AUDIT
        self._one = Lock()  # steps that run at once add their rows one after another
        create_empty(spark, path, self.schema, self.BY)

    def read(self) -> DataFrame:
        names = [c.split()[0] for c in self.schema.split(",")]
        return commits.read(self.spark, self.path).select(*names)

    def append(self, rows: list[dict]) -> None:
        now = datetime.now(timezone.utc)
        full = [{
            "registros_cargados": None, "fecha_particion": None, "archivo_origen": "",
            "fecha_carga": now, **row,
            "mensaje_error": (row.get("mensaje_error") or "")[:MESSAGE_LENGTH] or None,
        } for row in rows]
        names = [c.split()[0] for c in self.schema.split(",")]
        values = [tuple(row[n] for n in names) for row in full]
        with self._one:
            commits.append(self.spark.createDataFrame(values, self.schema).coalesce(1), self.path, self.BY)

    def append_files(self, table: str, kind: str, files: DataFrame) -> None:
        """A row of success per loaded file, written by the executors.

        ``files``: archivo_origen, fecha_particion, registros_cargados.
        """
        given = files.withColumns({
            "tabla_destino": F.lit(table), "tipo": F.lit(kind), "estado": F.lit(OK),
            "mensaje_error": F.lit(None).cast("string"), "fecha_carga": F.current_timestamp()})
        names = [c.split()[0] for c in self.schema.split(",")]
        commits.append(given.select(*names), self.path, self.BY)

    def loaded_files(self, table: str) -> DataFrame:
        """archivo_origen, fecha_particion of the files recorded as loaded."""
        return self.read().where(
            (F.col("tabla_destino") == table) & (F.col("tipo") == "INCREMENTAL")
            & (F.col("estado") == OK)).select("archivo_origen", "fecha_particion").distinct()

    def done_dates(self, table: str) -> set[date]:
        """Delivery dates already loaded: at most one per calendar day."""
        rows = self.read().where(
            (F.col("tabla_destino") == table) & (F.col("tipo") == "INCREMENTAL")
            & (F.col("estado") == OK) & F.col("fecha_particion").isNotNull()
        ).select("fecha_particion").distinct()
        return {row[0] for row in rows.collect()}

    def errors(self) -> DataFrame:
        return self.read().where(F.col("estado") == ERROR).orderBy(F.desc("fecha_carga"))

    def loads(self) -> DataFrame:
        return self.read().where(F.col("estado") == OK).orderBy(
            "tabla_destino", F.desc("fecha_carga"))

    def latest(self, n: int = 10) -> DataFrame:
        return self.read().orderBy(F.desc("fecha_carga"), "tabla_destino").limit(n)

    def tally(self) -> DataFrame:
        return self.read().groupBy("estado").agg(F.count(F.lit(1)).alias("pasos"))


def run_step(log: AuditLog, table: str, kind: str, make: Callable[[], DataFrame],
             write: Callable[[DataFrame], None]) -> bool:
    """Build and store one table and record it; a failure is recorded, not raised.

    The row count is observed while the table is written, without a second scan.
    """
    try:
        seen = Observation()
        write(make().observe(seen, F.count(F.lit(1)).alias("filas")))
        log.append([{"tabla_destino": table, "tipo": kind, "estado": OK,
                     "registros_cargados": seen.get["filas"]}])
        return True
    except Exception as error:
        log.append([{"tabla_destino": table, "tipo": kind, "estado": ERROR,
                     "mensaje_error": str(error)}])
        return False


def run_steps(log: AuditLog, kind: str, steps: Sequence[tuple[str, Callable[[], DataFrame], Callable[[DataFrame], None]]],
              at_once: int = AT_ONCE) -> list[bool]:
    """Steps (table, make, write) that do not read each other's tables, some at the same time.

    Small tables, listings, commits and the last tasks of a large table leave cores idle; the
    other steps use them. A step that fails does not stop the others.
    """
    with ThreadPoolExecutor(at_once) as pool:
        runs = [pool.submit(inheritable_thread_target(log.spark)(run_step), log, table, kind, make, write)
                for table, make, write in steps]
        return [run.result() for run in runs]


def run_action(log: AuditLog, table: str, kind: str, action: Callable[[], None]) -> bool:
    """Record a step that produces a model rather than a table; it counts as one row."""
    try:
        action()
        log.append([{"tabla_destino": table, "tipo": kind, "estado": OK, "registros_cargados": 1}])
        return True
    except Exception as error:
        log.append([{"tabla_destino": table, "tipo": kind, "estado": ERROR,
                     "mensaje_error": str(error)}])
        return False
