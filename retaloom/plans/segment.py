"""Product features and segments."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from retaloom.session import as_table
from retaloom.functions.numbers import mean, or_zero, percent, rounded, total

FEATURES = [
    "precio_lista_soles", "margen_pct", "unidades_vendidas", "ventas_netas", "tasa_devolucion_pct",
]
ATTRIBUTES = ["id_producto", "cod_sku", "nombre_sku", "categoria", "linea_negocio"]


def sku_features(products: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per SKU; a SKU without sales has zero units, sales and return rate.

    Sales are summed per product before the join, so a best seller adds one row.
    """
    sold = fact.groupBy("id_producto").agg(
        F.sum("cantidad_vendida").alias("_u"), F.sum("ventas_netas_soles").alias("_v"),
        F.sum("unidades_devueltas").alias("_d"))
    price, cost = F.col("precio_lista_soles"), F.col("costo_estandar_soles")
    return products.join(sold, "id_producto", "left").select(
        *ATTRIBUTES, "precio_lista_soles",
        percent(price - cost, price, 2).alias("margen_pct"),
        F.coalesce("_u", F.lit(0)).alias("unidades_vendidas"),
        or_zero(F.col("_v").cast("double")).alias("ventas_netas"),
        or_zero(percent("_d", "_u", 2)).alias("tasa_devolucion_pct"),
    )


def train(features: DataFrame, k: int = 4, seed: int = 11) -> PipelineModel:
    """K-means on standardised features."""
    rows = features.select(*[F.col(c).cast("double") for c in FEATURES]).na.fill(0.0)
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="prediction"),
    ]).fit(rows)


def assign(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Every SKU with its segment (1 to k), its attributes and its standardised features."""
    rows = features.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})
    scored = model.transform(rows).withColumn("_z", vector_to_array("features"))
    return scored.select(
        (F.col("prediction") + 1).alias("cluster"), *ATTRIBUTES, *FEATURES,
        *[F.col("_z")[i].alias(f"z_{c}") for i, c in enumerate(FEATURES)],
    )


def _squared(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [(p - q) * (p - q) for p, q in zip(a, b)])


def cluster_quality(assigned: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """Davies-Bouldin index and mean squared distance to the centroid; one row.

    Two passes over the points, both with small per-cluster aggregates. The
    comparison of centroids happens inside one row that holds the k of them.
    """
    # One row per cluster; written, so its size is known to the join.
    centroids = as_table(assigned.groupBy(cluster).agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns]), "centroids")
    apart = _squared([F.col(c).cast("double") for c in columns],
                     [F.col(f"m_{c}") for c in columns])
    spread = (
        assigned.join(centroids, cluster).withColumn("_d2", apart)
        .groupBy(cluster)
        .agg(
            F.avg(F.sqrt("_d2")).alias("s"), F.sum("_d2").alias("d2"),
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.first(f"m_{c}") for c in columns]).alias("m"),
        )
    )
    packed = spread.agg(
        F.collect_list(F.struct(F.col(cluster).alias("id"), "s", "m")).alias("all"),
        F.sum("d2").alias("d2"), F.sum("n").alias("n"))
    # worst (s_i + s_j) / |m_i - m_j| over the other clusters, averaged over clusters
    worst = """
        transform(all, i -> array_max(transform(filter(all, j -> j.id != i.id), j ->
            (i.s + j.s) / sqrt(aggregate(zip_with(i.m, j.m, (a, b) -> (a - b) * (a - b)),
                                         0D, (t, x) -> t + x)))))
    """
    index = F.expr(f"aggregate({worst}, 0D, (t, x) -> t + x) / size(all)")
    return packed.select(
        rounded(index, 6).alias("davies_bouldin_index"),
        rounded(F.col("d2") / F.col("n"), 6).alias("mean_squared_distance"),
    )


def profile(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    exact = lambda c: F.col(c).cast("decimal(28,4)")
    return assigned.groupBy(cluster).agg(
        F.count("id_producto").alias("skus"),
        rounded(mean(exact("precio_lista_soles")), 4).alias("precio_medio"),
        rounded(mean(exact("margen_pct")), 4).alias("margen_medio"),
        rounded(mean(exact("ventas_netas")), 4).alias("ventas_medias"),
        total(exact("ventas_netas")).alias("ventas"),
    ).orderBy(cluster)


def overview(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.agg(F.count(F.lit(1)).alias("skus"), F.count_distinct(cluster).alias("clusters"))


def ordered_table(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assigned.select(cluster, *ATTRIBUTES, *FEATURES).orderBy(
        cluster, F.desc("ventas_netas"), "id_producto")
