"""All layers from CSV files to models, and loads that are repeated or fail."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from retaloom import layers, schemas
from retaloom.medallion import from_standins
from retaloom.plans import audit, cells, curated
from retaloom.sources import tables
from retaloom.streaming import ingest, refresh

D = dt.date


def put(path, header, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join([header, *rows]) + "\n")


@pytest.fixture(scope="module")
def cfg(spark, folder, tmp_path_factory):
    """Stand-in rows delivered as CSV, in two dates per source, and every layer run once."""
    base = tmp_path_factory.mktemp("layers")
    config = layers.Config(
        landing=f"{base}/landing", root=f"{base}/store", first_day="1995-01-01",
        last_day="2001-12-31", holdout_from="2000-01-01", boosting_iterations=2)
    raw = from_standins(spark, folder).raw
    for source, ddl in schemas.TRANSACTIONAL.items():
        names = [c.split()[0] for c in ddl.replace("(18,4)", "").split(",")]
        rows = raw(source).select(*[n for n in names if n in raw(source).columns])
        assert rows.columns == names, source
        for i, day in enumerate(("20240101", "20240102")):
            rows.where(F.abs(F.xxhash64(*names)) % 2 == i).coalesce(1).write.csv(
                f"{config.landing}/{source}/{day}", header=True)
    for source, ddl in schemas.MASTERS.items():
        names = [c.split()[0] for c in ddl.replace("(18,4)", "").split(",")]
        raw(source).select(*names).coalesce(1).write.csv(f"{config.landing}/{source}", header=True)
    layers.run_all(spark, config)
    return config


def table(spark, cfg, layer, name):
    return tables.read_table(spark, layers.path(cfg, layer, name))


def test_no_step_failed(spark, cfg):
    for layer, steps in {"raw": 24, "trusted": 15, "curated": 11, "kpi": 8, "predictive": 19}.items():
        log = layers.audit_log(spark, cfg, layer)
        assert log.errors().select("tabla_destino", "mensaje_error").collect() == [], layer
        assert log.read().count() == steps, layer
        assert {r.estado: r.pasos for r in log.tally().collect()} == {audit.OK: steps}


def test_audit_counts_equal_table_counts(spark, cfg):
    for layer in ("trusted", "curated", "kpi"):
        for row in layers.audit_log(spark, cfg, layer).read().where("tipo != 'REFRESH'").collect():
            assert table(spark, cfg, layer, row.tabla_destino).count() == row.registros_cargados


def test_layers_agree(spark, cfg):
    count = lambda layer, name: table(spark, cfg, layer, name).count()
    marked = table(spark, cfg, "raw", "ventas").where("estado_linea = 'DUPLICADO'").count()
    assert count("raw", "ventas") - count("trusted", "ventas") == marked > 0
    assert count("curated", "FACT_VENTAS") == count("trusted", "ventas")
    ids = [r.id_venta for r in table(spark, cfg, "curated", "FACT_VENTAS").select("id_venta").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    net = lambda layer, name, c: table(spark, cfg, layer, name).agg(F.sum(c)).first()[0]
    fact = net("curated", "FACT_VENTAS", "ventas_netas_soles")
    assert net("kpi", "CUBO_FACTURAS_TBL", "ventas_netas") == fact
    assert net("kpi", "CUBO_FACTURAS_MV", "ventas_netas") == fact
    assert 0 < net("kpi", "CUBO_COMERCIAL_TBL", "ventas_netas") < fact  # months without target
    assert count("curated", "DIM_TIEMPO") == 2557


def test_stored_layers_equal_the_lazy_chain(spark, folder, cfg):
    lazy = from_standins(spark, folder).commercial.agg(
        F.sum("margen_bruto"), F.count(F.lit(1)), F.sum("unidades_devueltas")).first()
    stored = table(spark, cfg, "kpi", "CUBO_COMERCIAL_TBL").agg(
        F.sum("margen_bruto"), F.count(F.lit(1)), F.sum("unidades_devueltas")).first()
    assert tuple(map(float, lazy)) == tuple(map(float, stored))


def test_new_deliveries_refresh_the_kept_cubes(spark, cfg):
    """Cells and cubes as they were after the first delivery, brought up to the second, twice."""
    star = layers.stored_star(spark, cfg)
    first = F.col("fecha_carga_raw") == F.lit("2024-01-01").cast("date")
    old = {n: star.trusted(n).where(first) for n in ("ventas", "devoluciones", "inventario")}
    sales = curated.fact_ventas(old["ventas"], old["devoluciones"])
    stock = cells.stock_rows(curated.fact_inventario(old["inventario"]))
    whole = {t: sorted(map(tuple, table(spark, cfg, "kpi", t).collect()), key=repr)
             for t in (*layers.OF_CELLS, *layers.BY_MONTH)}
    for name, (rows, shape) in {"CELDAS_VENTAS": (sales, cells.SALES), "CELDAS_INVENTARIO": (stock, cells.STOCK)}.items():
        refresh.store_cube(cells.cells(rows, shape), layers.path(cfg, "kpi", name))
    for name, (kept, build) in layers.OF_CELLS.items():
        refresh.publish(spark, layers.path(cfg, "kpi", kept), layers.path(cfg, "kpi", name), layers.CELLS[kept][0],
                        lambda of: build(star, of))
    refresh.store_cube(layers.BY_MONTH["CUBO_FACTURAS_MV"](star.with_fact("ventas", sales)),
                       layers.path(cfg, "kpi", "CUBO_FACTURAS_MV"))
    for _ in range(2):
        layers.refresh_kpi(spark, cfg, [D(2024, 1, 2)])
        for name, want in whole.items():
            got = sorted(map(tuple, table(spark, cfg, "kpi", name).collect()), key=repr)
            assert got == want, name
    log = layers.audit_log(spark, cfg, "kpi").read().where("tipo = 'REFRESH'")
    assert {r.estado for r in log.collect()} == {audit.OK}


def test_predictions_are_stored(spark, cfg):
    ahead = table(spark, cfg, "predictive", "pred_ventas_forecast_v2")
    channels = table(spark, cfg, "curated", "DIM_CANAL").count()
    assert ahead.count() == 90 * channels
    assert table(spark, cfg, "predictive", "pred_segmentacion_productos_v2").count() == table(
        spark, cfg, "curated", "DIM_PRODUCTO").count()


def test_views_read_the_star(spark, cfg):
    layers.create_views(spark, cfg)
    got = spark.sql("SELECT count(*) AS n FROM CUBO_FACTURAS").first().n
    assert got == table(spark, cfg, "kpi", "CUBO_FACTURAS_TBL").count()


def test_day_range_reaches_the_stored_fact(spark, cfg):
    whole = layers.stored_star(spark, cfg)
    some = whole.between("2000-03-01", "2000-03-31")
    text = spark._jvm.PythonSQLUtils.explainString(
        some.invoices._jdf.queryExecution(), "simple")
    scan = next(line for line in text.splitlines() if "FACT_VENTAS" in line)
    assert "GreaterThanOrEqual(id_fecha,20000301)" in scan
    want = whole.invoices.where("anio_mes = '2000-03'").agg(F.sum("num_facturas")).first()[0]
    assert some.invoices.agg(F.sum("num_facturas")).first()[0] == want > 0


def test_month_layout_prunes_folders(spark, cfg):
    where = layers.path(cfg, "trusted", "ventas")
    df = tables.read_days(spark, where, "fecha_emision", "2000-03-05", "2000-04-02")
    whole = tables.read_table(spark, where).where(
        "fecha_emision between date'2000-03-05' and date'2000-04-02'")
    assert df.count() == whole.count() > 0
    assert {int(f.split(f"{tables.MONTH}=")[1][:6]) for f in df.select(
        F.col("_metadata.file_path").alias("p")).distinct().toPandas()["p"]} == {200003, 200004}


# -- loads ---------------------------------------------------------------------------------

SCHEMA = "id bigint, valor double"


class Box:
    def __init__(self, spark, base):
        self.spark, self.root, self.table = spark, f"{base}/landing", f"{base}/raw/s"
        self.log = audit.AuditLog(spark, f"{base}/etl_control", raw=True)
        self.checkpoint = f"{base}/checkpoint"

    def put(self, folder, name, *rows, header="id,valor"):
        put(f"{self.root}/s/{folder}/{name}", header, *rows)

    def load(self, **kw):
        return ingest.ingest(self.spark, self.root, "s", SCHEMA, self.table, self.log, **kw)

    def watch(self, **kw):
        ingest.watch(self.spark, self.root, "s", SCHEMA, self.table, self.log, self.checkpoint,
                     **kw).awaitTermination()

    def rows(self):
        return sorted((r.id, r.fecha_carga) for r in tables.read_table(self.spark, self.table).collect())

    def audit(self):
        return sorted((str(r.fecha_particion), r.estado, r.registros_cargados)
                      for r in self.log.read().collect())


@pytest.fixture
def box(spark, tmp_path):
    return Box(spark, tmp_path)


def test_only_csv_in_dated_folders(box):
    box.put("20240101", "a.csv", "1,1.5", "2,2.5")
    box.put("20240101", "b.txt", "3,1.0")
    box.put("borrador", "a.csv", "4,1.0")
    box.put("2024", "a.csv", "5,1.0")
    assert box.load() == {"exitosos": 1, "errores": 0, "omitidos": 0}
    assert box.rows() == [(1, D(2024, 1, 1)), (2, D(2024, 1, 1))]
    assert box.audit() == [("2024-01-01", "EXITOSO", 2)]


def test_replay_and_late_files(box):
    box.put("20240101", "a.csv", "1,1.0")
    box.load()
    assert box.load() == {"exitosos": 0, "errores": 0, "omitidos": 1}
    box.put("20240101", "late.csv", "2,1.0")
    box.put("20240102", "a.csv", "3,1.0")
    box.load()
    assert [r[0] for r in box.rows()] == [1, 3]
    box.load(replace=True)
    assert [r[0] for r in box.rows()] == [1, 2, 3]


def test_crash_between_data_and_audit_leaves_no_duplicates(box, monkeypatch):
    box.put("20240101", "a.csv", "1,1.0")
    with monkeypatch.context() as m:
        m.setattr(box.log, "append_files", lambda *rows: (_ for _ in ()).throw(SystemExit()))
        with pytest.raises(SystemExit):
            box.load()
    assert box.rows() == [(1, D(2024, 1, 1))] and box.audit() == []
    box.load()
    assert box.rows() == [(1, D(2024, 1, 1))]
    assert box.audit() == [("2024-01-01", "EXITOSO", 1)]


def test_a_bad_date_does_not_stop_the_others_and_can_be_repaired(box):
    box.put("20240101", "a.csv", "1,1.0")
    box.put("20240102", "a.csv", "x,y")
    assert box.load() == {"exitosos": 1, "errores": 1, "omitidos": 0}
    assert [r[0] for r in box.rows()] == [1]
    assert [(d, s) for d, s, _ in box.audit()] == [("2024-01-01", "EXITOSO"), ("2024-01-02", "ERROR")]
    message = box.log.errors().first().mensaje_error
    assert message and len(message) <= audit.MESSAGE_LENGTH
    box.put("20240102", "a.csv", "2,1.0")
    box.load()
    assert [r[0] for r in box.rows()] == [1, 2]


def test_last_file_of_a_date(box):
    box.put("20240101", "a.csv", "1,1.0")
    box.put("20240101", "b.csv", "2,1.0")
    box.load(last_file_only=True)
    assert [r[0] for r in box.rows()] == [2]


def test_stream_loads_each_date_once(box):
    box.put("20240101", "a.csv", "1,1.0")
    box.watch()
    box.watch()
    box.put("20240101", "late.csv", "2,1.0")
    box.put("20240102", "a.csv", "3,1.0")
    box.watch()
    assert [r[0] for r in box.rows()] == [1, 3]
    assert box.audit() == [("2024-01-01", "EXITOSO", 1), ("2024-01-02", "EXITOSO", 1)]


def test_stream_with_replace_reads_the_whole_date(box):
    box.put("20240101", "a.csv", "1,1.0")
    box.watch(replace=True)
    box.put("20240101", "b.csv", "2,1.0")
    box.watch(replace=True)
    assert [r[0] for r in box.rows()] == [1, 2]


def test_missing_source_loads_nothing(box):
    assert set(box.load().values()) == {0} and box.audit() == []


def test_failing_step_is_recorded(spark, tmp_path):
    log = audit.AuditLog(spark, f"{tmp_path}/etl_control")
    assert not audit.run_step(log, "t", "FULL_REFRESH", lambda: spark.range(3).select("nope"),
                              lambda df: None)
    assert audit.run_step(log, "u", "FULL_REFRESH", lambda: spark.range(3),
                          lambda df: tables.write_table(df, f"{tmp_path}/u"))
    got = {r.tabla_destino: (r.estado, r.registros_cargados) for r in log.latest().collect()}
    assert got == {"t": ("ERROR", None), "u": ("EXITOSO", 3)}


def test_refresh_replaces_changed_months_and_drops_empty_ones(spark, tmp_path):
    where = f"{tmp_path}/cube"
    make = lambda rows: spark.createDataFrame(rows, "periodo bigint, v bigint")
    refresh.store_cube(make([(202401, 1), (202402, 2), (202403, 3)]), where)
    refresh.refresh(spark, where, lambda p: make([(202402, 20)]), [202402, 202403])
    assert sorted((r.periodo, r.v) for r in tables.read_table(spark, where).collect()) == [
        (202401, 1), (202402, 20)]


def test_cube_follows_a_stream_of_changes(spark, tmp_path):
    facts, where = f"{tmp_path}/facts", f"{tmp_path}/cube"
    schema = "fecha date, v bigint"
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(facts)

    def build(periods):
        df = spark.read.parquet(facts).withColumn("periodo", F.year("fecha") * 100 + F.month("fecha"))
        return df.where(F.col("periodo").isin(periods)).groupBy("periodo").agg(F.sum("v").alias("v"))

    def follow():
        changes = spark.readStream.schema(schema).parquet(facts)
        refresh.follow(spark, changes, "fecha", where, build, f"{tmp_path}/cp").awaitTermination()

    add([(D(2024, 1, 5), 1), (D(2024, 2, 5), 2)])
    follow()
    add([(D(2024, 2, 6), 10)])
    follow()
    assert sorted((r.periodo, r.v) for r in tables.read_table(spark, where).collect()) == [
        (202401, 1), (202402, 12)]


def test_a_failing_write_keeps_the_table(spark, tmp_path):
    where = str(tmp_path / "t")
    tables.write_table(spark.range(5), where)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(
        F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, where)
    assert tables.read_table(spark, where).count() == 5
    assert [p.name for p in tmp_path.iterdir() if p.is_dir()] == ["t"]


def test_a_date_delivered_empty_loses_its_rows(spark, tmp_path):
    log = audit.AuditLog(spark, str(tmp_path / "log"), raw=True)
    put(str(tmp_path / "in/s/20240101/a.csv"), "k,v", "1,a", "2,b")
    put(str(tmp_path / "in/s/20240102/a.csv"), "k,v", "3,c")
    load = lambda **kw: ingest.ingest(
        spark, str(tmp_path / "in"), "s", "k bigint, v string", str(tmp_path / "t"), log, **kw)
    load()
    put(str(tmp_path / "in/s/20240101/a.csv"), "k,v")
    load(replace=True)
    assert [r.k for r in tables.read_table(spark, str(tmp_path / "t")).collect()] == [3]
    last = log.read().where("fecha_particion = '2024-01-01'").orderBy(F.desc("fecha_carga")).first()
    assert (last.estado, last.registros_cargados) == (audit.OK, 0)
