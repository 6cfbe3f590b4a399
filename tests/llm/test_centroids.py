import hashlib
import math

import numpy as np
import pytest

from retaloom.llm import centroids


def plain(rows, k, rounds, dims, scale=1024, seed=3):
    """The same clusters by looking at every pair, in Python's whole numbers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=mark)[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((gap(v, c), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for c in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=repr), cents


@pytest.mark.parametrize("spread", [3, 1 << 40])
@pytest.mark.parametrize("k", [1, 2, 8, 40])
def test_walk_finds_the_nearest_and_the_smaller_number(k, spread):
    rng = np.random.default_rng(k)
    x, c = rng.integers(-spread, spread, (200, 5)), rng.integers(-spread, spread, (k, 5))
    winner, best, probes = centroids.nearest(x, centroids.Lists.of(c))
    gaps = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(axis=2)
    assert [(int(d), int(n)) for d, n in zip(best, winner)] == [
        min((d, n) for n, d in enumerate(row)) for row in gaps.tolist()]
    assert probes.max() <= k


def test_walk_stops_early_where_centroids_are_apart():
    c = np.arange(100)[:, None] * 1000 + np.zeros((1, 4), dtype=np.int64)
    winner, _, probes = centroids.nearest(c + 3, centroids.Lists.of(c))
    assert winner.tolist() == list(range(100)) and probes.max() <= 2


def test_equal_sums_do_not_end_the_walk():
    # Both centroids are equally far; the one reached later has the smaller number.
    c = np.array([[0, 2], [2, 0], [1, 9]])
    winner, best, _ = centroids.nearest(np.array([[1, 1]]), centroids.Lists.of(c))
    assert (winner[0], best[0]) == (0, 2)


def test_odd_vectors_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, 0.25]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, None),
            (6, []), (7, [1.0]), (8, [None, 1.0]), (None, [-3.0, 2.5]), (9, [1.0, 2.0]), (10, [-1e-9, 1e-9]),
            (11, [1e6, -1e6]), (12, [1e300, 0.0]), (13, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id bigint, embedding array<double>, Cluster string, n int")
    want, _ = plain([r for r in rows if r[0] != 12], k=3, rounds=4, dims=2)
    found = centroids.cluster(df.repartition(5), k=3, rounds=4, dims=2)
    assert found.columns == ["vec_id", "embedding", "n", "cluster", "distance", "cluster_inertia", "inertia",
                             "centroid_sha256", "probes"]
    got = found.collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=repr) == want
    assert {r.inertia for r in got} == {sum(d for *_, d in want)}
    for c in {r.cluster for r in got}:
        assert {r.cluster_inertia for r in got if r.cluster == c} == {sum(d for _, n, d in want if n == c)}


def test_few_or_no_vectors(spark):
    two = spark.createDataFrame([(1, [0.0]), (2, [4.0])], "vec_id bigint, embedding array<float>")
    assert {(r.vec_id, r.distance) for r in centroids.cluster(two, k=8, rounds=2, dims=1).collect()} == {(1, 0), (2, 0)}
    assert centroids.cluster(two.where("false"), dims=1).collect() == []
    assert centroids.cluster(two, dims=7).collect() == []


def test_partitions_do_not_matter(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [sorted(map(tuple, centroids.cluster(df.repartition(n), k=5, rounds=3).drop("embedding").collect()))
            for n in (1, 7)]
    assert rows[0] == rows[1]
    want, _ = plain([(r.vec_id, r.embedding) for r in df.collect()], k=5, rounds=3, dims=64)
    at = centroids.cluster(df, k=5, rounds=3).select("vec_id", "cluster", "distance").collect()
    assert sorted(map(tuple, at)) == sorted(want)


def test_cells_on_a_floor(spark):
    """Sums below zero round down, not towards zero."""
    df = spark.createDataFrame([(i, [-1.0 / 1024 * (i % 2)]) for i in range(4)], "vec_id bigint, embedding array<double>")
    vectors = centroids.prepared(df, "embedding", 1, 1024)
    assert centroids.fit(vectors, np.array([[0]]), 1).tolist() == [[-1]]
