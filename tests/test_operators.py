"""Numbering, cubes and joins under skew, and the shape of their plans."""

import random

from pyspark.sql import functions as F

from retaloom.medallion import from_standins
from retaloom.operators.numbering import number_rows
from retaloom.operators.star import Dim, star_cube
from retaloom.plans import cubes, panel, segment
from retaloom.plans.curated import FACT_SALES_COLUMNS, fact_ventas
from retaloom.queries import QUERIES
from retaloom.session import settle


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_numbers_are_dense_and_ordered_under_skew(spark):
    # two thirds of the rows share one date
    rows = [(1 if random.Random(i).random() < 0.66 else i % 50, f"k{i % 997}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "d int, k string, i int").repartition(7)
    got = number_rows(df, ["d", "k", "i"], "n", blocks=6).collect()
    by_number = sorted(got, key=lambda r: r.n)
    assert [r.n for r in by_number] == list(range(1, 5001))
    assert [(r.d, r.k, r.i) for r in by_number] == sorted(rows)


def test_identical_copies_are_spread_by_the_tie(spark):
    df = settle(spark.range(4000).select(F.lit(1).alias("d"), F.col("id").alias("_tag")))
    out = number_rows(df, ["d"], "n", tie="_tag", blocks=4)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert "_tag" not in out.columns
    assert {r.n for r in out.collect()} == set(range(1, 4001))
    assert max(sizes) < 2500


def test_numbering_never_sorts_in_one_task(spark, folder):
    fact = from_standins(spark, folder).tagged_sales()
    text = plan(number_rows(fact, ["fecha_emision", "id_linea_venta"], "n", tie="_tag"))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1 and "Window" in text  # only the block sizes


def test_hot_join_key_is_split(spark):
    # a third of the lines belong to one invoice and product
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        one = F.lit(1).cast("decimal(18,2)")
        hot = F.col("id") % 3 == 0
        sales = spark.range(0, 60000, 1, 16).select(
            F.when(hot, -1).otherwise(F.col("id")).alias("num_factura"), F.lit(1).alias("id_producto"),
            F.lit("2024-01-01").cast("date").alias("fecha_emision"),
            F.col("id").cast("string").alias("id_linea_venta"),
            *[one.alias(c) for c in FACT_SALES_COLUMNS if c not in (
                "num_factura", "id_producto", "id_fecha", "unidades_devueltas",
                "monto_devuelto_soles")])
        back = spark.range(-1, 100).select(
            F.col("id").alias("num_factura_origen"), F.lit(1).alias("id_producto"),
            F.lit(2).alias("cantidad_devuelta"), one.alias("monto_devolucion_soles"))
        fact = fact_ventas(sales, back)
        rows = fact.where("num_factura = -1").agg(
            F.count(F.lit(1)).alias("n"), F.sum("unidades_devueltas").alias("u")).first()
        assert (rows.n, rows.u) == (20000, 40000)
        fact.collect()
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_cube_equals_grouping_by_attributes(spark):
    fact = spark.createDataFrame([(i % 5, i % 3, i) for i in range(200)], "a bigint, b bigint, v bigint")
    left = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y"), (3, None), (4, None)],
                                 "a bigint, name string")
    right = spark.createDataFrame([(0, "p"), (1, "q")], "b bigint, place string")  # 2 is unknown
    dims = [Dim(left, "a", ["name"]), Dim(right, "b", ["place"], unique=True)]
    got = star_cube(fact, dims, [F.sum("v").alias("v"), F.count_distinct("a").alias("n")])
    want = fact.join(left, "a").join(right, "b").groupBy("name", "place").agg(
        F.sum("v").alias("v"), F.count_distinct("a").alias("n"))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_cube_shuffles_keys_only(spark, folder):
    m = from_standins(spark, folder)
    text = plan(m.commercial)
    wide = [line for line in text.splitlines()
            if "Exchange hashpartitioning" in line and "nombre_sku" in line]
    assert not wide and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_query_uses_a_cross_join(spark, folder):
    for name in ("kpi_ticket", "kpi_target_status", "rec_cube_vs_fact", "rec_raw_vs_trusted",
                 "series_future_regressors", "sku_davies_bouldin", "dq_promotion_keys_profile"):
        text = plan(QUERIES[name].run(spark, folder))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_scans_read_needed_columns_only(spark, folder):
    text = plan(from_standins(spark, folder).raw("ventas").groupBy("id_canal").agg(
        F.sum("cantidad_vendida")))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    schema = scan.split("ReadSchema: ")[1]
    assert "l_quantity" in schema and "l_extendedprice" not in schema and "l_tax" not in schema
    assert "row_index" not in text


def test_small_side_has_its_own_size_and_no_hint(spark, folder):
    star = from_standins(spark, folder)
    joined = star.fact("ventas").join(star.small("canal"), "id_canal")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert "orders" not in plan(star.small("canal")) and "/canal-" in plan(joined)


def test_nothing_is_kept_between_queries(spark, folder, tmp_path):
    for name in ("region nation customer supplier part orders lineitem events".split()):
        (tmp_path / f"{name}.parquet").symlink_to(f"{folder}/{name}.parquet")
    names = lambda: {r.nombre_canal for r in QUERIES["kpi_channel_month"].run(spark, str(tmp_path)).collect()}
    before = names()
    other = spark.read.parquet(f"{folder}/orders.parquet").withColumn(
        "o_orderpriority", F.concat(F.col("o_orderpriority"), F.lit("-NEW")))
    (tmp_path / "orders.parquet").unlink()
    other.write.parquet(str(tmp_path / "orders.parquet"))
    after = names()
    assert before and after and not before & after


def test_cells_of_products_with_equal_attributes_are_one(spark):
    dim = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, None, "a"), (4, "b", "c")], "k bigint, x string, y string")
    fact = spark.createDataFrame([(1, 5), (2, 7), (3, 1), (4, 2), (4, 3), (9, 9)], "k bigint, v bigint")
    cube = star_cube(fact, [Dim(dim, "k", ["x", "y"])], [F.sum("v").alias("v")])
    assert {tuple(r) for r in cube.collect()} == {("a", None, 12), (None, "a", 1), ("b", "c", 5)}


def test_metrics_match_hand_count(spark):
    rows = [(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (0, 0.4)]
    row = panel.metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 2)
    assert (row.precision, row.recall, row.f1_score, row.accuracy) == (0.5, 0.5, 0.5, 0.6)
    assert row.roc_auc == round((3 + 1.5) / 6, 6)


def test_cluster_quality_matches_hand_count(spark):
    rows = [(1, 0.0), (1, 2.0), (2, 10.0), (2, 14.0)]
    row = segment.cluster_quality(spark.createDataFrame(rows, "cluster int, x double"), ["x"]).first()
    assert row.davies_bouldin_index == round((1 + 2) / 11, 6)
    assert row.mean_squared_distance == (1 + 1 + 4 + 4) / 4


def test_class_weights_and_first_lag(spark):
    fact = spark.createDataFrame(
        [(1, 1, 20240101, 5, 1, 0, 1.0, 1.0), (1, 1, 20240201, 0, 1, 1, 1.0, 1.0),
         (1, 1, 20240401, 7, 1, 0, 1.0, 1.0)],
        "id_producto bigint, id_almacen bigint, id_fecha bigint, stock_disponible bigint, "
        "stock_reservado bigint, flag_quiebre int, demanda_diaria_prom double, dias_cobertura double")
    weights = {r.flag_quiebre: r.peso for r in panel.class_weights(fact).collect()}
    assert weights == {0: 0.75, 1: 1.5}
    dense = {r.id_fecha: r.stock_disponible for r in panel.densify(fact).collect()}
    assert dense == {20240101: 5, 20240201: 0, 20240301: None, 20240401: 7}


def test_digests_that_collide_keep_their_cells(spark):
    dim = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, None, "a"), (4, "b", "c"), (4, "b", "d")], "k bigint, x string, y string")
    fact = spark.createDataFrame([(1, 5), (2, 7), (3, 1), (4, 2), (4, 3), (9, 9)], "k bigint, v bigint")
    one = Dim(dim, "k", ["x", "y"], digest=lambda names: F.lit(7).cast("bigint"))
    cube = star_cube(fact, [one], [F.sum("v").alias("v")])
    assert {tuple(r) for r in cube.collect()} == {("a", None, 12), (None, "a", 1), ("b", "c", 5), ("b", "d", 5)}


def test_cube_of_some_levels_equals_its_roll_up(spark):
    dim = spark.createDataFrame([(1, "a", "p"), (2, "a", "q"), (3, None, "q")], "k bigint, x string, y string")
    other = spark.createDataFrame([(1, "m"), (1, "m"), (2, "n")], "o bigint, z string")  # 1 is there twice
    fact = spark.createDataFrame([(i % 4, i % 3, i) for i in range(100)], "k bigint, o bigint, v bigint")
    dims = [Dim(dim, "k", ["x", "y"]), Dim(other, "o", ["z"])]
    whole = star_cube(fact, dims, [F.sum("v").alias("v")])
    for levels in (["x"], ["y", "z"], []):
        some = star_cube(fact, dims, [F.sum("v").alias("v")], levels)
        want = whole.groupBy(*levels).agg(F.sum("v").alias("v"))
        assert some.columns == [*levels, "v"]
        assert sorted(map(tuple, some.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def _with_goals(spark, names, goals):
    """A small cube with targets, both ways, for the given channels and targets."""
    fact = spark.createDataFrame(
        [(20000100 + i % 3 + (i % 2) * 100, i % 4 or None, i % 5, i) for i in range(60)],
        "id_fecha int, id_canal int, id_producto int, v int")
    days = Dim(fact.select("id_fecha").distinct(), "id_fecha", ["id_fecha"], unique=True)
    days = Dim(days.frame.withColumn("dia", F.col("id_fecha") % 100 + F.col("id_fecha")), "id_fecha", ["dia"], unique=True)
    goods = Dim(spark.createDataFrame([(i, f"p{i // 2}") for i in range(5)], "id_producto int, sku string"),
                "id_producto", ["sku"], large=True)
    channel = Dim(spark.createDataFrame(names, "id_canal int, canal string"), "id_canal", ["canal"])
    targets = spark.createDataFrame(goals, "periodo int, id_canal int, meta_a int")
    out = []
    for dim in (channel, channel.told_apart()):
        for how in ("inner", "left"):
            rows, most, later = cubes._targets(fact, targets, dim, how, {"a": "meta_a"})
            assert ("meta_a" in rows.columns) != dim.unique
            cube = star_cube(rows, [days, dim, goods], [F.sum("v").alias("v"), *most], later=later)
            assert cube.columns == ["dia", "canal", "sku", "v", "a"]
            out.append(sorted(map(tuple, cube.collect()), key=str))
    return out, channel.told_apart().unique


def test_targets_put_on_cells_equal_those_carried_by_rows(spark):
    # a target that comes twice counts its rows twice; one month and one channel have none
    goals = [(200001, 1, 10), (200001, 1, 30), (200001, 2, 20), (200002, 2, 5), (200002, 1, None)]
    (a, b, c, d), unique = _with_goals(spark, [(1, "x"), (2, "y"), (3, None)], goals)
    assert unique and a == c and b == d and len(a) < len(b)
    (a, b, c, d), unique = _with_goals(spark, [(1, "x"), (2, "x"), (3, "z")], goals)
    assert not unique and a == c and b == d
    assert not _with_goals(spark, [(1, "x"), (1, "y"), (2, "z")], goals)[1]


def test_large_dimensions_are_shuffled_without_the_attributes_of_small_ones(spark):
    fact = spark.createDataFrame([(i % 3, i % 7, i) for i in range(50)], "s int, b int, v int")
    small = Dim(spark.createDataFrame([(i, f"s{i}") for i in range(3)], "s int, name string"), "s", ["name"])
    big = Dim(spark.createDataFrame([(i, f"b{i}") for i in range(7)], "b int, sku string"), "b", ["sku"], large=True)
    cube = star_cube(fact, [small, big], [F.sum("v").alias("v")])
    assert cube.columns == ["name", "sku", "v"] and cube.count() == 21
    attached = [line for line in cube._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in line]
    assert "_group_s" in attached[0] and "_group_b" in attached[1]  # the outermost join comes last
