"""The layers as jobs that read and write stored tables, each step audited.

Layout under one root: ``<layer>/<table>`` with layers raw, trusted, curated, kpi
and predictive, and ``<layer>/etl_control`` for the audit log. Layers run in
order; within a layer a failing step is recorded and the next one runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom import schemas
from retaloom.medallion import Medallion
from retaloom.plans import audit, calendar, cells, cubes, curated, forecast, panel, segment, series, trusted
from retaloom.sources import tables
from retaloom.streaming import ingest, refresh

XREGS = ("inversion_promo", "es_feriado")


@dataclass(frozen=True)
class Config:
    """Where things are and which days the calendar covers."""

    landing: str  # delivered files: <landing>/<source>/<YYYYMMDD>/*.csv, masters beside them
    root: str  # stored tables
    first_day: str = "2023-01-01"
    last_day: str = "2025-12-31"
    holdout_from: str = "2025-01-01"
    forecast_from: str | None = None  # None: the day after the last one of each series
    horizon: int = 90
    confidence: float = 0.9
    clusters: int = 4
    boosting_iterations: int = 100


# stored name per curated table of the star
STORED = {
    ("dim", "tiempo"): "DIM_TIEMPO", ("dim", "canal"): "DIM_CANAL",
    ("dim", "geografia"): "DIM_GEOGRAFIA", ("dim", "almacen"): "DIM_ALMACEN",
    ("dim", "vendedor"): "DIM_VENDEDOR", ("dim", "cliente"): "DIM_CLIENTE",
    ("dim", "producto"): "DIM_PRODUCTO", ("fact", "ventas"): "FACT_VENTAS",
    ("fact", "inventario"): "FACT_INVENTARIO", ("fact", "metas_comercial"): "FACT_METAS_COMERCIAL",
    ("fact", "metas_operativo"): "FACT_METAS_OPERATIVO",
}


class StoredMedallion(Medallion):
    """A medallion that reads the listed layers from storage and derives the rest."""

    def __init__(self, spark: SparkSession, cfg: Config, stored: Iterable[str]):
        self.cfg, self.stored = cfg, set(stored)
        super().__init__(spark, self._raw_table,
                         calendar.days_between(spark, cfg.first_day, cfg.last_day))

    def _raw_table(self, name: str, tag: bool = False) -> DataFrame:
        return tables.read_table(self.spark, path(self.cfg, "raw", name), tag).drop("archivo_origen")

    def small(self, name: str) -> DataFrame:
        """Stored tables have a known size: Spark decides from their files."""
        if {"dim", "fact"} <= self.stored:
            return self.fact(name) if name.startswith("metas_") else self.dim(name)
        return super().small(name)

    def tagged_sales(self, once: bool = False) -> DataFrame:
        if "trusted" not in self.stored:
            return super().tagged_sales(once)
        sales = tables.read_table(self.spark, path(self.cfg, "trusted", "ventas"), tag=True)
        return curated.fact_ventas(sales, self.trusted("devoluciones"), once)

    def _once(self, layer: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if layer in self.stored and layer == "trusted":
            found = path(self.cfg, "trusted", name)
            return super()._once(layer, name, lambda: tables.read_table(self.spark, found))
        if layer in self.stored and (layer, name) in STORED:
            found = path(self.cfg, "curated", STORED[layer, name])
            return super()._once(layer, name, lambda: tables.read_table(self.spark, found))
        return super()._once(layer, name, make)


def path(cfg: Config, layer: str, table: str) -> str:
    return f"{cfg.root}/{layer}/{table}"


def audit_log(spark: SparkSession, cfg: Config, layer: str) -> audit.AuditLog:
    return audit.AuditLog(spark, path(cfg, layer, "etl_control"), raw=layer == "raw")


def run_raw(spark: SparkSession, cfg: Config, replace: bool = False) -> None:
    """Load new deliveries of the nine dated sources, and all six masters."""
    log = audit_log(spark, cfg, "raw")
    for source, schema in schemas.TRANSACTIONAL.items():
        ingest.ingest(spark, cfg.landing, source, schema, path(cfg, "raw", source), log, replace)
    for source, schema in schemas.MASTERS.items():
        ingest.snapshot(spark, f"{cfg.landing}/{source}/*.csv", source, schema,
                        path(cfg, "raw", source), log)


def run_trusted(spark: SparkSession, cfg: Config) -> None:
    star, log = StoredMedallion(spark, cfg, []), audit_log(spark, cfg, "trusted")
    for name in trusted.RULES:
        audit.run_step(
            log, name, "FULL_REFRESH", lambda: star.trusted(name),
            lambda df: tables.write_table(
                df, path(cfg, "trusted", name), trusted.LAYOUT_DATE.get(name)))


def run_curated(spark: SparkSession, cfg: Config) -> None:
    star, log = StoredMedallion(spark, cfg, ["trusted"]), audit_log(spark, cfg, "curated")
    numbered = {
        "FACT_VENTAS": lambda: curated.numbered_sales(star.tagged_sales()),
        "FACT_INVENTARIO": lambda: curated.numbered_inventory(star.fact("inventario")),
    }
    for (kind, name), table in STORED.items():
        plain = (lambda: star.dim(name)) if kind == "dim" else (lambda: star.fact(name))
        audit.run_step(log, table, "FULL_REFRESH", numbered.get(table, plain),
                       lambda df: tables.write_table(df, path(cfg, "curated", table)))


CUBES: dict[str, Callable[[Medallion], DataFrame]] = {
    "CUBO_COMERCIAL_TBL": cubes.commercial,
    "CUBO_FACTURAS_TBL": cubes.invoices,
    "CUBO_INVENTARIO_TBL": cubes.inventory,
}
# facts added up by their keys, and the cubes that are made of them; additive measures only
CELLS: dict[str, tuple[cells.Shape, Callable[[Medallion], DataFrame]]] = {
    "CELDAS_VENTAS": (cells.SALES, lambda star: star.fact("ventas")),
    "CELDAS_INVENTARIO": (cells.STOCK, lambda star: cells.stock_rows(star.fact("inventario"))),
}
OF_CELLS: dict[str, tuple[str, Callable[[Medallion, DataFrame], DataFrame]]] = {
    "CUBO_COMERCIAL_MV": ("CELDAS_VENTAS", lambda star, of: cubes.commercial(star.with_fact("ventas", of))),
    "CUBO_INVENTARIO_MV": ("CELDAS_INVENTARIO", lambda star, of: cubes.inventory_additive(
        star.with_fact("inventario", of), of_cells=True)),
}
# kept fresh by the months of new sales: an invoice is counted, not added up
BY_MONTH: dict[str, Callable[[Medallion], DataFrame]] = {"CUBO_FACTURAS_MV": cubes.invoices_deduplicated}


def stored_star(spark: SparkSession, cfg: Config) -> StoredMedallion:
    return StoredMedallion(spark, cfg, ["trusted", "dim", "fact"])


def run_kpi(spark: SparkSession, cfg: Config) -> None:
    star, log = stored_star(spark, cfg), audit_log(spark, cfg, "kpi")
    step = lambda table, make: audit.run_step(
        log, table, "FULL_REFRESH", make, lambda df: tables.write_table_by(df, path(cfg, "kpi", table), "periodo"))
    for table, build in {**CUBES, **BY_MONTH}.items():
        step(table, lambda: build(star))
    for table, (shape, rows) in CELLS.items():
        step(table, lambda: cells.cells(rows(star), shape))
    for table, (kept, build) in OF_CELLS.items():
        step(table, lambda: build(star, cells.as_fact(
            tables.read_table(spark, path(cfg, "kpi", kept)), CELLS[kept][0])))


def refresh_kpi(spark: SparkSession, cfg: Config, loaded: Iterable[date], attributes: bool = False) -> None:
    """Brings the kept cubes up to deliveries that are new, after the layers below have taken them in.

    Cells get what the deliveries add: their sales and snapshots, and what their returns change on
    older sales. Only months with a change are read and published, those with new targets too;
    ``attributes`` publishes all months, for deliveries that change masters. Running it again for the
    same dates adds nothing. A date that replaced an earlier delivery needs ``run_kpi``.
    """
    star, log = stored_star(spark, cfg), audit_log(spark, cfg, "kpi")
    days = sorted(set(loaded))
    if not days:
        return
    token = ",".join(d.isoformat() for d in days)
    of = lambda name: star.trusted(name)
    new = F.col("fecha_carga_raw").isin(days)
    sales, returns = of("ventas"), of("devoluciones")
    before = curated.fact_ventas(sales.where(~new), returns.where(~new))
    changes = {
        "CELDAS_VENTAS": lambda: cells.sales_change(
            curated.fact_ventas(sales.where(new), returns), late=cells.returns_change(before, returns.where(new))),
        "CELDAS_INVENTARIO": lambda: cells.cells(
            cells.stock_rows(curated.fact_inventario(of("inventario").where(new))), cells.STOCK),
    }
    targets = {"CELDAS_VENTAS": "metas", "CELDAS_INVENTARIO": "metas_operativas"}
    sold: set[int] = set()
    for table, (kept, build) in OF_CELLS.items():
        shape, where = CELLS[kept][0], path(cfg, "kpi", kept)

        def bring_up():
            months = set(refresh.refresh_cells(spark, where, changes[kept](), shape, token))
            sold.update(months if kept == "CELDAS_VENTAS" else ())
            goals = of(targets[kept]).where(new).select("periodo").distinct()
            months |= {r[0] for r in goals.collect()}  # one per calendar month at most
            refresh.publish(spark, where, path(cfg, "kpi", table), shape, lambda rows: build(star, rows),
                            None if attributes else months)

        audit.run_action(log, table, "REFRESH", bring_up)
    for table, build in BY_MONTH.items():
        fact = star.fact("ventas")
        rows = lambda months: build(star.with_fact("ventas", fact.where(F.expr("id_fecha div 100").isin(months))))
        audit.run_action(log, table, "REFRESH", lambda: refresh.refresh(
            spark, path(cfg, "kpi", table), rows, sorted(sold)))


def create_views(spark: SparkSession, cfg: Config) -> None:
    """The cubes as views over the stored star, computed when queried."""
    views_over(stored_star(spark, cfg))


def views_over(star: Medallion) -> None:
    """The cubes of a star as views; what a question does not use of them is not computed."""
    for table, build in CUBES.items():
        build(star).createOrReplaceTempView(table.removesuffix("_TBL"))


def _writer(cfg: Config, table: str) -> Callable[[DataFrame], None]:
    return lambda df: tables.write_table(df, path(cfg, "predictive", table))


def run_predictive(spark: SparkSession, cfg: Config) -> None:
    """First model version: plain series forecast and stock-out classifier.

    Reads the curated layer, never the cubes, which lack sales without a target.
    """
    star, log = stored_star(spark, cfg), audit_log(spark, cfg, "predictive")
    step = lambda table, kind, make: audit.run_step(log, table, kind, make, _writer(cfg, table))
    stored = lambda table: tables.read_table(spark, path(cfg, "predictive", table))

    step("train_ventas_forecast", "TRAIN", lambda: series.sales_only(
        series.daily_series(star.fact("ventas"), star.dim("tiempo"))))
    step("model_ventas_forecast", "TRAIN", lambda: forecast.fit(stored("train_ventas_forecast")))
    models = lambda: stored("model_ventas_forecast")
    ahead = lambda: forecast.forecast(models(), cfg.horizon, cfg.confidence)
    step("eval_ventas_forecast", "EVALUATE", lambda: forecast.evaluate(models()))
    step("explain_ventas_forecast", "EVALUATE", lambda: forecast.explain(
        series.components(stored("train_ventas_forecast")), ahead()))
    step("pred_ventas_forecast", "PREDICT", ahead)

    step("train_quiebre_stock", "TRAIN", lambda: panel.lag_features(
        star.fact("inventario"), star.dim("producto"), star.dim("almacen"), star.dim("tiempo"),
        cfg.holdout_from))
    rows = lambda: stored("train_quiebre_stock")
    fitted: dict[str, object] = {}

    def fit() -> None:
        fitted["m"] = panel.train(rows(), cfg.boosting_iterations)
        fitted["m"].write().overwrite().save(path(cfg, "predictive", "model_quiebre_stock"))

    audit.run_action(log, "model_quiebre_stock", "TRAIN", fit)
    scored = lambda: panel.predict(fitted["m"], rows())
    step("eval_quiebre_stock", "EVALUATE", lambda: panel.metrics(
        scored().where("split"), "flag_quiebre", "probabilidad"))
    step("explain_quiebre_stock", "EVALUATE", lambda: panel.importances(fitted["m"], rows()))
    step("pred_quiebre_stock", "PREDICT", scored)


def run_predictive_v2(spark: SparkSession, cfg: Config) -> None:
    """Second model version: forecast with regressors and product segments."""
    star, log = stored_star(spark, cfg), audit_log(spark, cfg, "predictive")
    step = lambda table, kind, make: audit.run_step(log, table, kind, make, _writer(cfg, table))
    stored = lambda table: tables.read_table(spark, path(cfg, "predictive", table))

    step("train_ventas_forecast_v2", "TRAIN", lambda: series.daily_series(
        star.fact("ventas"), star.dim("tiempo")))
    train = lambda: stored("train_ventas_forecast_v2")
    step("future_regressors_v2", "TRAIN", lambda: series.future_regressors(
        train(), cfg.horizon, cfg.forecast_from))
    step("model_ventas_forecast_v2", "TRAIN", lambda: forecast.fit(train(), regressors=XREGS))
    models = lambda: stored("model_ventas_forecast_v2")
    step("eval_ventas_forecast_v2", "EVALUATE", lambda: forecast.evaluate(models()))
    step("pred_ventas_forecast_v2", "PREDICT", lambda: forecast.forecast_with(
        models(), stored("future_regressors_v2"), XREGS, cfg.confidence))

    step("train_segmentacion_productos_v2", "TRAIN", lambda: segment.sku_features(
        star.dim("producto"), star.fact("ventas")))
    skus = lambda: stored("train_segmentacion_productos_v2")
    fitted: dict[str, object] = {}

    def fit() -> None:
        fitted["m"] = segment.train(skus(), cfg.clusters)
        fitted["m"].write().overwrite().save(
            path(cfg, "predictive", "model_segmentacion_productos_v2"))

    audit.run_action(log, "model_segmentacion_productos_v2", "TRAIN", fit)
    assigned = lambda: segment.assign(fitted["m"], skus())
    step("eval_segmentacion_productos_v2", "EVALUATE", lambda: segment.cluster_quality(
        assigned(), [f"z_{c}" for c in segment.FEATURES]))
    step("pred_segmentacion_productos_v2", "PREDICT", lambda: segment.ordered_table(assigned()))


def run_all(spark: SparkSession, cfg: Config, replace: bool = False) -> None:
    run_raw(spark, cfg, replace)
    run_trusted(spark, cfg)
    run_curated(spark, cfg)
    run_kpi(spark, cfg)
    run_predictive(spark, cfg)
    run_predictive_v2(spark, cfg)
