"""Incremental loads, partition replacement, cube refresh and the audit log.

The deliveries are the events table sliced into dated CSV folders. Every call
works in a folder of its own below the shared folder.
"""

from uuid import uuid4

from pyspark.sql import functions as F

from retaloom.functions.dates import period_key
from retaloom.functions.numbers import total
from retaloom.plans import audit, cells, cubes, curated, trusted
from retaloom.queries.registry import query
from retaloom.queries.olap import COMMERCIAL_TYPES, INVENTORY_TYPES
from retaloom.queries.sqlbase import d, r
from retaloom.session import shared_folder
from retaloom.sources import landing, tables
from retaloom.streaming import ingest, refresh

EVENT_FILE = "event_id bigint, user_id bigint, event_type string, value double"
_BY_DAY = f"""
SELECT CAST(ts AS DATE) AS fecha_carga, COUNT(*) AS filas, SUM(event_id) AS ids,
       {r('SUM(CAST(value AS DECIMAL(18,2)))', 2)} AS valor
FROM events GROUP BY 1"""
_BY_DAY = _BY_DAY.replace("SUM(event_id)", "CAST(SUM(event_id) AS BIGINT)")


def _work(m) -> str:
    return f"{shared_folder(m.spark)}/loads-{uuid4().hex}"


def _events(m):
    return m.spark.read.parquet(f"{m.folder}/events.parquet")


def _deliver(m, root, rows):
    """Write rows as one folder per day, as a delivery would arrive."""
    rows.select(
        "event_id", "user_id", "event_type", "value",
        F.date_format("ts", "yyyyMMdd").alias("fecha"),
    ).hint("rebalance", "fecha").write.mode("append").partitionBy("fecha").option(
        "header", True).csv(f"{root}/eventos")


def _by_day(spark, table):
    return tables.read_table(spark, table).groupBy("fecha_carga").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("event_id").alias("ids"),
        F.round(F.sum(F.col("value").cast("decimal(18,2)")), 2).cast("double").alias("valor"))


def _setup(m):
    work = _work(m)
    log = audit.AuditLog(m.spark, f"{work}/etl_control", raw=True)
    return f"{work}/landing", f"{work}/raw/eventos", log, f"{work}/checkpoint"


def _load(m, root, table, log, **kw):
    return ingest.ingest(m.spark, root, "eventos", EVENT_FILE, table, log, **kw)


@query("ingest_incremental", _BY_DAY)
def incremental(m):
    """Two deliveries, each picked up by its own load."""
    root, table, log, _ = _setup(m)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    _deliver(m, root, _events(m).where(early))
    _load(m, root, table, log)
    _deliver(m, root, _events(m).where(~early))
    _load(m, root, table, log)
    return _by_day(m.spark, table)


@query("ingest_replay", """
SELECT CAST(ts AS DATE) AS fecha_particion, COUNT(*) AS registros_cargados, 1 AS veces
FROM events GROUP BY 1""".replace("1 AS veces", "CAST(1 AS BIGINT) AS veces"))
def replay(m):
    """A second run loads nothing and records nothing."""
    root, table, log, _ = _setup(m)
    _deliver(m, root, _events(m))
    _load(m, root, table, log)
    _load(m, root, table, log)
    per_file = log.read().groupBy("fecha_particion", "archivo_origen").agg(
        F.max("registros_cargados").alias("n"), F.count(F.lit(1)).alias("veces"))
    return per_file.groupBy("fecha_particion").agg(
        F.sum("n").alias("registros_cargados"), F.max("veces").alias("veces"))


@query("ingest_late_file_ignored", _BY_DAY)
def late(m):
    """A file for a date that is done already does not change it."""
    root, table, log, _ = _setup(m)
    _deliver(m, root, _events(m))
    _load(m, root, table, log)
    _deliver(m, root, _events(m).where(F.col("event_type") == "error"))
    _load(m, root, table, log)
    return _by_day(m.spark, table)


@query("ingest_replace_partition", f"""
SELECT CAST(ts AS DATE) AS fecha_carga, COUNT(*) AS filas, CAST(SUM(event_id) AS BIGINT) AS ids,
       {r('SUM(CAST(value AS DECIMAL(18,2)))', 2)} AS valor
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error') AS e
GROUP BY 1""")
def replaced(m):
    """With ``replace`` the dates are loaded again from all their files."""
    root, table, log, _ = _setup(m)
    _deliver(m, root, _events(m))
    _load(m, root, table, log)
    _deliver(m, root, _events(m).where(F.col("event_type") == "error"))
    _load(m, root, table, log, replace=True)
    return _by_day(m.spark, table)


@query("ingest_stream", _BY_DAY)
def stream(m):
    """The same load driven by a file stream, run until caught up, twice."""
    root, table, log, checkpoint = _setup(m)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    for part in (early, ~early):
        _deliver(m, root, _events(m).where(part))
        ingest.watch(m.spark, root, "eventos", EVENT_FILE, table, log, checkpoint).awaitTermination()
    return _by_day(m.spark, table)


@query("ingest_master_snapshot", f"""
SELECT id_almacen, cod_almacen, nombre_almacen, macroregion, TRUE AS con_fecha_snapshot
FROM dim_almacen""")
def master(m):
    work = _work(m)
    log = audit.AuditLog(m.spark, f"{work}/etl_control", raw=True)
    m.raw("almacen").select("id_almacen", "cod_almacen", "nombre_almacen", "macroregion").write.csv(
        f"{work}/landing/almacen", header=True)
    schema = "id_almacen bigint, cod_almacen string, nombre_almacen string, macroregion string"
    table = f"{work}/raw/almacen"
    for _ in range(2):  # a snapshot replaces the one before
        ingest.snapshot(m.spark, f"{work}/landing/almacen/*.csv", "almacen", schema, table, log)
    return tables.read_table(m.spark, table).select(
        "id_almacen", "cod_almacen", "nombre_almacen", "macroregion",
        F.col("fecha_snapshot").isNotNull().alias("con_fecha_snapshot"))


@query("ingest_listing", """
SELECT DISTINCT CAST(ts AS DATE) AS fecha_particion FROM events""")
def listing(m):
    """Delivery dates found in folder names; other folders and file types are ignored."""
    root, *_ = _setup(m)
    _deliver(m, root, _events(m))
    return landing.deliveries(m.spark, root, "eventos").select("fecha_particion").distinct()


_TRUSTED = {
    "ventas": "tru_ventas", "pedidos": "raw_pedidos", "fill_rate": "tru_fill_rate",
    "inventario": "tru_inventario", "devoluciones": "raw_devoluciones", "metas": "tru_metas",
    "promociones": "tru_promociones", "inversion_promocional": "raw_inversion",
    "clientes": "tru_clientes", "productos": "tru_productos",
    "metas_operativas": "tru_metas_operativas", "canal": "dim_canal",
    "geografia": "dim_geografia", "almacen": "dim_almacen", "vendedor": "dim_vendedor",
}


@query("audit_log", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS tabla_destino, 'FULL_REFRESH' AS tipo, 'EXITOSO' AS estado, "
    f"COUNT(*) AS registros_cargados FROM {table}" for name, table in _TRUSTED.items()
) + """
UNION ALL SELECT 'rota', 'FULL_REFRESH', 'ERROR', CAST(NULL AS BIGINT)""")
def audit_rows(m):
    """Every trusted table written with its audit row, and one step that fails."""
    work = _work(m)
    log = audit.AuditLog(m.spark, f"{work}/etl_control")

    def step(name, make):
        return name, make, lambda df: tables.write_table(
            df, f"{work}/trusted/{name}", trusted.LAYOUT_DATE.get(name))

    audit.run_steps(log, "FULL_REFRESH", [
        step("rota", lambda: m.trusted("ventas").select("no_existe")),
        *[step(name, lambda name=name: m.trusted(name)) for name in _TRUSTED]])
    return log.read().select("tabla_destino", "tipo", "estado", "registros_cargados")


@query("audit_tally", """
SELECT 'EXITOSO' AS estado, COUNT(DISTINCT CAST(ts AS DATE)) AS pasos FROM events""")
def audit_tally(m):
    root, table, log, _ = _setup(m)
    _deliver(m, root, _events(m))
    _load(m, root, table, log)
    return log.tally()


@query("ingest_replace_with_empty_file", _BY_DAY.replace(
    "FROM events", "FROM events WHERE CAST(ts AS DATE) <> (SELECT CAST(MIN(ts) AS DATE) FROM events)"))
def replaced_by_nothing(m):
    """A date that is delivered again with a header alone loses its rows."""
    root, table, log, _ = _setup(m)
    _deliver(m, root, _events(m))
    _load(m, root, table, log)
    first = _events(m).agg(F.date_format(F.min("ts"), "yyyyMMdd")).first()[0]
    _events(m).select("event_id", "user_id", "event_type", "value").limit(0).coalesce(1).write.mode(
        "overwrite").option("header", True).csv(f"{root}/eventos/fecha={first}")
    _load(m, root, table, log, replace=True)
    return _by_day(m.spark, table)


@query("audit_failed_step_keeps_table", """
SELECT * REPLACE (CAST(margen_objetivo_pct AS DOUBLE) AS margen_objetivo_pct) FROM dim_canal""")
def kept_table(m):
    """A refresh that fails while it writes leaves the table as it was."""
    work = _work(m)
    log = audit.AuditLog(m.spark, f"{work}/etl_control")
    table = f"{work}/curated/DIM_CANAL"
    write = lambda df: tables.write_table(df, table)
    audit.run_step(log, "DIM_CANAL", "FULL_REFRESH", lambda: m.dim("canal"), write)
    audit.run_step(log, "DIM_CANAL", "FULL_REFRESH", lambda: m.dim("canal").withColumn(
        "nombre_canal", F.raise_error(F.lit("no canal")).cast("string")), write)
    return tables.read_table(m.spark, table)


def _four_steps(m) -> audit.AuditLog:
    """Three dimensions written one after another, then a step that fails."""
    work = _work(m)
    log = audit.AuditLog(m.spark, f"{work}/etl_control")
    for name in ("canal", "geografia", "almacen"):
        audit.run_step(log, name, "FULL_REFRESH", lambda: m.dim(name),
                       lambda df: tables.write_table(df, f"{work}/curated/{name}"))
    audit.run_step(log, "rota", "FULL_REFRESH", lambda: m.trusted("ventas").select("no_existe"),
                   lambda df: tables.write_table(df, f"{work}/curated/rota"))
    return log


_DIM_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS tabla_destino, 'EXITOSO' AS estado, COUNT(*) AS registros_cargados"
    f" FROM dim_{name}" for name in ("canal", "geografia", "almacen"))


@query("audit_errors", """
SELECT 'rota' AS tabla_destino, 'ERROR' AS estado, TRUE AS con_mensaje, COUNT(*) >= 0 AS leido
FROM dim_canal""")
def audit_errors(m):
    return _four_steps(m).errors().select(
        "tabla_destino", "estado", (F.length("mensaje_error") > 0).alias("con_mensaje"),
        F.lit(True).alias("leido"))


@query("audit_loads", _DIM_COUNTS)
def audit_loads(m):
    return _four_steps(m).loads().select("tabla_destino", "estado", "registros_cargados")


@query("audit_latest", f"""
SELECT * FROM ({_DIM_COUNTS}) AS x WHERE tabla_destino = 'almacen'
UNION ALL SELECT 'rota', 'ERROR', CAST(NULL AS BIGINT)""")
def audit_latest(m):
    """The two rows written last."""
    return _four_steps(m).latest(2).select("tabla_destino", "estado", "registros_cargados")


_CUBE = f"""
SELECT periodo, nombre_canal, {d('SUM(ventas_netas)')} AS ventas_netas,
       CAST(SUM(num_facturas) AS BIGINT) AS num_facturas, COUNT(*) AS celdas
FROM cubo_facturas_dedup GROUP BY 1, 2"""


@query("cube_incremental_refresh", _CUBE)
def incremental_refresh(m):
    """A cube stored before the last year of sales came in, then refreshed month by month."""
    table = f"{_work(m)}/kpi/CUBO_FACTURAS_MV"
    fact = m.fact("ventas")
    late = F.col("fecha_emision") >= F.lit("2001-01-01").cast("date")
    refresh.store_cube(cubes.invoices_deduplicated(m.with_fact("ventas", fact.where(~late))), table)

    def build(periods):
        months = period_key(F.col("fecha_emision")).isin(periods)
        return cubes.invoices_deduplicated(m.with_fact("ventas", fact.where(months)))

    changed = refresh.changed_periods(fact.where(late), "fecha_emision")
    refresh.refresh(m.spark, table, build, changed)
    return tables.read_table(m.spark, table).groupBy("periodo", "nombre_canal").agg(
        total("ventas_netas").alias("ventas_netas"), F.sum("num_facturas").alias("num_facturas"),
        F.count(F.lit(1)).alias("celdas"))


def _between(column, first, last):
    return F.col(column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


@query("cube_commercial_refresh", f"SELECT * REPLACE ({COMMERCIAL_TYPES}) FROM cubo_comercial")
def commercial_refresh(m):
    """Cells and cube as they stood before five things came in: two months of sales, the removal of
    duplicates from one, a month of returns, other targets, and a new brand on some products."""
    work = _work(m)
    kept, cube = f"{work}/kpi/CELDAS_VENTAS", f"{work}/kpi/CUBO_COMERCIAL_MV"
    sales, returns = m.trusted("ventas"), m.trusted("devoluciones")
    late, wrong = _between("fecha_emision", "2001-03-01", "2001-04-30"), _between(
        "fecha_emision", "1996-01-01", "1996-01-31")
    came = _between("fecha_solicitud_dev", "1998-05-01", "1998-05-31")
    twice = m.raw("ventas").where(wrong & (F.col("estado_linea") == "DUPLICADO"))
    then = returns.where(~F.coalesce(came, F.lit(False)))
    old = curated.fact_ventas(sales.where(~late), then)
    removed = curated.fact_ventas(twice, then)
    targets, goods = m.fact("metas_comercial"), m.dim("producto")
    other = (F.col("periodo") == 199907) & (F.col("id_canal") == 2)
    doubled = F.when(other, F.col("meta_ventas_netas_soles") * 2).otherwise(F.col("meta_ventas_netas_soles"))
    targets_then = targets.where("periodo != 200002").withColumn(
        "meta_ventas_netas_soles", doubled.cast(targets.schema["meta_ventas_netas_soles"].dataType))
    goods_then = goods.withColumn("marca", F.when(F.col("id_producto") % 50 == 0, "OLD").otherwise(F.col("marca")))
    before = m.with_table("fact", "metas_comercial", targets_then).with_table("dim", "producto", goods_then)
    refresh.store_cube(cells.cells(old.unionByName(removed), cells.SALES), kept)
    refresh.publish(m.spark, kept, cube, cells.SALES, lambda of: cubes.commercial(before.with_fact("ventas", of)))

    change = cells.sales_change(
        curated.fact_ventas(sales.where(late), returns), removed, cells.returns_change(old, returns.where(came)))
    for _ in range(2):  # a job that is run again adds nothing
        months = set(refresh.refresh_cells(m.spark, kept, change, cells.SALES, token="delivery-1"))
    stored = tables.read_table(m.spark, kept)
    for more in (
        cells.changed_keys(targets_then, targets, "periodo"),
        cells.months_of_keys(stored, "id_producto", cells.changed_keys(goods_then, goods, "id_producto")),
    ):
        months |= {r[0] for r in more.collect()}
    refresh.publish(m.spark, kept, cube, cells.SALES,
                    lambda of: cubes.commercial(m.with_fact("ventas", of)), months)
    return tables.read_table(m.spark, cube)


@query("cube_inventory_refresh", f"""
SELECT * REPLACE ({INVENTORY_TYPES}, {d('demanda_diaria_total')} AS demanda_diaria_total)
FROM cubo_inventario_aditivo""")
def inventory_refresh(m):
    """Snapshots of one month come late, those of another are corrected, and targets change."""
    work = _work(m)
    kept, cube = f"{work}/kpi/CELDAS_INVENTARIO", f"{work}/kpi/CUBO_INVENTARIO_MV"
    fact = cells.stock_rows(m.fact("inventario"))
    late, wrong = F.expr("id_fecha div 100 = 200005"), F.expr("id_fecha div 100 = 199803")
    mistaken = cells.stock_rows(fact.where(wrong).withColumn("stock_disponible", F.col("stock_disponible") * 0))
    targets = m.fact("metas_operativo")
    then = targets.withColumn("meta_quiebre_pct", F.when(F.col("periodo") == 199611, F.lit(99)).otherwise(
        F.col("meta_quiebre_pct")).cast(targets.schema["meta_quiebre_pct"].dataType))
    before = m.with_table("fact", "metas_operativo", then)
    refresh.store_cube(cells.cells(fact.where(~late & ~wrong).unionByName(mistaken), cells.STOCK), kept)
    build = lambda star: lambda of: cubes.inventory_additive(star.with_fact("inventario", of), of_cells=True)
    refresh.publish(m.spark, kept, cube, cells.STOCK, build(before))

    rows = cells.signed(fact.where(late | wrong), 1).unionByName(cells.signed(mistaken, -1))
    months = set(refresh.refresh_cells(
        m.spark, kept, cells.cells(rows, cells.STOCK), cells.STOCK, token="delivery-1"))
    months |= {r[0] for r in cells.changed_keys(then.drop("id_meta_op"), targets.drop("id_meta_op"), "periodo").collect()}
    refresh.publish(m.spark, kept, cube, cells.STOCK, build(m), months)
    return tables.read_table(m.spark, cube)
