"""The stock-out panel and its classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from retaloom.functions.numbers import ratio, rounded

KEYS = ["id_producto", "id_almacen", "id_fecha"]
NUMBERS = [
    "stock_mes_anterior", "reservado_mes_anterior", "cobertura_mes_anterior",
    "demanda_mes_anterior", "tendencia_stock", "quiebres_ultimos_3_meses", "mes",
]
ROWS_PER_TASK = 500_000  # of training
NAMES = ["categoria", "linea_negocio", "tipo_almacen", "macroregion", "trimestre"]


def densify(fact: DataFrame) -> DataFrame:
    """One row per month from the first to the last snapshot of each product and warehouse.

    Months without a snapshot carry NULL measures, so that "previous row" means
    "previous month".
    """
    key = ["id_producto", "id_almacen"]
    day = F.to_date(F.col("id_fecha").cast("string"), "yyyyMMdd")
    spine = (
        fact.groupBy(*key).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
        .select(*key, F.explode(F.expr("sequence(_a, _b, interval 1 month)")).alias("_d"))
        .select(*key, F.date_format("_d", "yyyyMMdd").cast("bigint").alias("id_fecha"))
    )
    return spine.join(fact, [*key, "id_fecha"], "left")


def lag_features(fact: DataFrame, products: DataFrame, stores: DataFrame, days: DataFrame,
                 holdout_from: str, corrected: bool = True) -> DataFrame:
    """Features of the previous snapshot(s) of the same product and warehouse.

    A group is the monthly snapshots of one product in one warehouse, so its size
    is bounded by the calendar. All six measures share one sort. ``corrected``
    uses the past trend (previous minus the one before); without it the trend
    includes the current stock, which gives the label away. The keys stay in the
    result so that scores can be traced, but are no features.
    """
    w = Window.partitionBy("id_producto", "id_almacen").orderBy("id_fecha")
    before = lambda c, n=1: F.lag(c, n).over(w)
    stock = "stock_disponible"
    trend = before(stock) - before(stock, 2) if corrected else F.col(stock) - before(stock)
    lagged = fact.select(
        *KEYS, "flag_quiebre",
        before(stock).alias("stock_mes_anterior"),
        before("stock_reservado").alias("reservado_mes_anterior"),
        before("dias_cobertura").alias("cobertura_mes_anterior"),
        before("demanda_diaria_prom").alias("demanda_mes_anterior"),
        trend.alias("tendencia_stock"),
        F.sum("flag_quiebre").over(w.rowsBetween(-3, -1)).alias("quiebres_ultimos_3_meses"),
    ).where(F.col("stock_mes_anterior").isNotNull())
    return (
        lagged.join(products.select("id_producto", "categoria", "linea_negocio"), "id_producto")
        .join(stores.select("id_almacen", "tipo_almacen", "macroregion"), "id_almacen")
        .join(F.broadcast(days.select("id_fecha", "fecha", "mes", "trimestre")), "id_fecha")
        .withColumn("split", F.col("fecha") >= F.lit(holdout_from).cast("date"))
        .drop("fecha")
    )


def class_weights(rows: DataFrame, label: str = "flag_quiebre") -> DataFrame:
    """n / (2 * n of the class) for each class, from one grouping."""
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("filas"))
    whole = F.sum("filas").over(Window.partitionBy(F.lit(1)))  # one row per class
    return sizes.select(label, "filas", rounded(ratio(whole, F.col("filas") * 2), 8).alias("peso"))


def weighted(rows: DataFrame, label: str = "flag_quiebre") -> DataFrame:
    """Rows with the weight of their class, taken from the training part only."""
    weights = class_weights(rows.where(~F.col("split")), label).select(label, "peso")
    return rows.join(F.broadcast(weights), label, "left").withColumn(
        "peso", F.coalesce("peso", F.lit(1.0)))  # two classes: a fixed size


def prepared(rows: DataFrame) -> DataFrame:
    """Numeric features as doubles; a missing lag counts as 0."""
    made = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMBERS}
    return rows.withColumns({**made, "label": F.col("flag_quiebre").cast("double")})


def train(rows: DataFrame, iterations: int = 100, depth: int = 5, sampling: float = 1.0,
          seed: int = 7) -> PipelineModel:
    """Boosted trees on the training rows, stopping early on the holdout rows.

    A row in training takes four bytes per encoded feature, many times what it takes in a file, and
    every tree reads all of them again. So rows are spread by their number, not by their bytes.
    """
    indexers = StringIndexer(
        inputCols=NAMES, outputCols=[f"{c}_ix" for c in NAMES], handleInvalid="keep")
    encoder = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in NAMES], outputCols=[f"{c}_oh" for c in NAMES])
    assembler = VectorAssembler(inputCols=NUMBERS + [f"{c}_oh" for c in NAMES], outputCol="features")
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="peso", maxIter=iterations,
        maxDepth=depth, subsamplingRate=sampling, seed=seed, validationIndicatorCol="split")
    known = prepared(weighted(rows))
    encoded = Pipeline(stages=[indexers, encoder, assembler]).fit(known)
    model = trees.fit(encoded.transform(spread(known, rows.count())))
    return PipelineModel(stages=[*encoded.stages, model])


def spread(rows: DataFrame, n: int, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``n`` rows in tasks of at most about ``per_task``, by their keys; as they are where one would do."""
    least = rows.sparkSession.sparkContext.defaultParallelism
    return rows if n <= per_task else rows.repartition(max(least, -(-n // per_task)), *KEYS)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = model.transform(prepared(rows))
    return scored.select(
        *KEYS, "flag_quiebre", "split", F.col("prediction").cast("int").alias("predicted_flag_quiebre"),
        F.element_at(vector_to_array("probability"), 2).alias("probabilidad"),
    )


def importances(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Gain share per feature, encoded columns folded back to their source column."""
    shape = model.transform(prepared(rows).limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in shape.values() for a in kind}
    gains = model.stages[-1].featureImportances.toArray()
    source = lambda n: n.split("_oh_")[0]
    listed = [(source(names[i]), float(g)) for i, g in enumerate(gains)]
    frame = rows.sparkSession.createDataFrame(listed, "feature string, gain double")
    return frame.groupBy("feature").agg(F.sum("gain").alias("importancia")).orderBy(
        F.desc("importancia"))


BLOCKS = 256  # of scores, for prefix sums


def metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5,
            weight: str | None = None) -> DataFrame:
    """Precision, recall, F1, accuracy and ROC AUC of a score; one row, one plan.

    The area is the share of pairs of a positive and a negative row that the score puts in the
    right order, ties counting half. Rows are counted per distinct score first. The scores are cut
    into blocks by their quantiles; each block adds up its own pairs and the blocks, a fixed number,
    add the negatives of those below. Where the cuts fall changes the work, not the result.
    ``weight`` weighs the pairs, not the counts. Rows without a score or a label do not count.
    """
    # Exact numbers, wide enough for the product of two counts.
    unit = F.lit(1).cast("decimal(18,0)") if weight is None else F.col(weight).cast("decimal(16,4)")
    s, true = F.col("_s"), F.col(label) == 1
    per_score = (
        scored.withColumn("_s", F.col(score).cast("double"))
        .where(F.col("_s").isNotNull() & F.col(label).isNotNull()).groupBy("_s").agg(
            F.count_if(true).alias("_t"), F.count_if(~true).alias("_f"),
            F.coalesce(F.sum(F.when(true, unit)), F.lit(0)).alias("_p"),
            F.coalesce(F.sum(F.when(~true, unit)), F.lit(0)).alias("_n")))
    shares = [i / BLOCKS for i in range(1, BLOCKS)]
    cuts = per_score.agg(F.percentile_approx("_s", shares, 10 * BLOCKS)).scalar()
    blocked = per_score.withColumn("_cuts", cuts).withColumn(
        "_block", F.size(F.filter("_cuts", lambda c: c < F.col("_s")))).drop("_cuts")
    lower = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pairs = F.col("_p") * (lower(Window.partitionBy("_block").orderBy("_s")) * 2 + F.col("_n"))
    hit = s >= threshold
    blocks = blocked.withColumn("_u", pairs).groupBy("_block").agg(
        F.sum("_u").alias("_u"), F.sum("_p").alias("_p"), F.sum("_n").alias("_n"),
        F.sum(F.when(hit, F.col("_t"))).alias("tp"), F.sum(F.when(hit, F.col("_f"))).alias("fp"),
        F.sum(F.when(~hit, F.col("_t"))).alias("fn"), F.sum(F.when(~hit, F.col("_f"))).alias("tn"))
    # At most BLOCKS rows from here on.
    double = lambda c: c.cast("double")
    total = blocks.withColumn("_u", double(F.col("_u")) + double(F.col("_p")) * 2 * double(
        lower(Window.partitionBy(F.lit(0)).orderBy("_block")))).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "tn")],
        *[F.sum(c).cast("double").alias(c) for c in ("_u", "_p", "_n")])
    tp = F.col("tp")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    precision, recall = ratio(tp, tp + F.col("fp")), ratio(tp, tp + F.col("fn"))
    return total.select(
        "tp", "fp", "fn", "tn",
        zero(rounded(precision, 6)).alias("precision"),
        zero(rounded(recall, 6)).alias("recall"),
        zero(rounded(ratio(tp * 2, tp * 2 + F.col("fp") + F.col("fn")), 6)).alias("f1_score"),
        rounded(ratio(tp + F.col("tn"), tp + F.col("fp") + F.col("fn") + F.col("tn")), 6)
        .alias("accuracy"),
        rounded(ratio("_u", F.col("_p") * F.col("_n") * 2), 6).alias("roc_auc"),
    )
