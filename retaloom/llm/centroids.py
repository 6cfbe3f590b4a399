"""Clusters of vectors: exact integer rounds, nearest centroids by the threshold algorithm.

Every dimension keeps the centroids sorted by their value in it. A vector walks each of
these lists outward from its own value, one centroid per list and step. A centroid met for
the first time gets its exact distance. What no list has reached yet is at least the squared
frontier distances of all lists away, so the walk ends when their sum strictly exceeds the
best exact distance; on an equal sum a centroid of a smaller number could still tie.

Components are whole numbers floor(scale * x), and so are sums, distances and new centroids:
results do not depend on partitions, batches or retries. Each round is one pass over the stored
vectors; what crosses the network is k rows per task, what reaches the driver k centroids.

Defined cases: vectors that are null, of another length, or hold a null, a NaN, an infinity or
a component beyond 2^53 after scaling are left out, as their distances have no long value.
A distance or a sum of distances beyond a long is null. A vector without an id takes part (as the
empty id in the choice of the first centroids); repeated rows count each. Fewer vectors than
centroids: as many centroids as vectors. No vector: no rows. Other columns are carried along;
one named like a new column gives way to it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from retaloom.llm.common import small_table, stored

WIDE = float(1 << 53)
LONG = (1 << 63) - 1
CELLS = 1 << 22  # of a batch's largest array


def whole_numbers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can take part, and their components as whole numbers."""
    if pa.types.is_large_list(column.type) or pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    fits = np.zeros(len(column), dtype=bool)
    length = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    right = np.nonzero(length == dims)[0]
    flat = column.take(pa.array(right)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(right), dims)  # null: NaN
    with np.errstate(over="ignore", invalid="ignore"):
        floors = np.floor(scale * values)
        good = (np.abs(floors) <= WIDE).all(axis=1)
    fits[right[good]] = True
    return fits, floors[good].astype(np.int64)


@dataclass
class Lists:
    """The centroids, and per dimension their sorted values with a stop at either end."""

    centroids: np.ndarray  # k x dims
    values: np.ndarray  # dims x (k + 2)
    order: np.ndarray  # dims x (k + 2), numbers of the centroids
    far: int

    @staticmethod
    def of(centroids: np.ndarray) -> Lists:
        k, dims = centroids.shape
        far = 1 << 60
        order = np.argsort(centroids, axis=0, kind="stable").T
        values = np.take_along_axis(centroids.T, order, axis=1)
        ends = np.full((dims, 1), far, dtype=np.int64)
        pad = np.zeros((dims, 1), dtype=order.dtype)
        return Lists(centroids, np.hstack([-ends, values, ends]), np.hstack([pad, order, pad]), far)


def nearest(x: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the nearest centroid (ties: the smaller number), its squared distance, and the
    number of exact distances that were worked out."""
    n, dims = x.shape
    k = len(lists.centroids)
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(lists.centroids).max(initial=0)))
    wide = dims * (2 * most) ** 2 > LONG
    number = object if wide else np.int64  # Python's own integers where 64 bits are too few
    best = np.full(n, dims * (2 * most) ** 2 + 1 if wide else LONG, dtype=number)
    winner = np.full(n, k, dtype=np.int64)
    seen = np.zeros((n, k), dtype=bool)
    values, order = lists.values.ravel(), lists.order.ravel()
    start = np.arange(dims) * (k + 2)  # of each dimension's list in these
    below = np.empty((n, dims), dtype=np.int64)
    for d in range(dims):
        below[:, d] = np.searchsorted(lists.values[d], x[:, d], side="left") - 1 + start[d]
    above = below + 1
    rows = np.arange(n)
    while len(rows):
        own, lo, hi = x[rows], below[rows], above[rows]
        down, up = own - values.take(lo), values.take(hi) - own
        left = down <= up
        met = order.take(np.where(left, lo, hi))
        frontier = np.minimum(down, up)
        below[rows], above[rows] = lo - left, hi + ~left
        before = seen[rows]
        now = before.copy()
        now[np.arange(len(rows))[:, None], met] = True
        seen[rows] = now
        now &= ~before
        for c in range(k):  # smaller numbers first
            new = np.nonzero(now[:, c])[0]
            if len(new):
                distance, row = _squares(own[new] - lists.centroids[c], number), rows[new]
                wins = (distance < best[row]) | ((distance == best[row]) & (c < winner[row]))
                best[row[wins]], winner[row[wins]] = distance[wins], c
        over = (_squares(frontier, number) > best[rows]).astype(bool) | seen[rows].all(axis=1)
        rows = rows[~over]
    return winner, best, seen.sum(axis=1)


def _squares(gaps: np.ndarray, number: type) -> np.ndarray:
    if number is object:
        gaps = gaps.astype(object)
        return (gaps * gaps).sum(axis=1)
    return np.einsum("ij,ij->i", gaps, gaps)


def _parts(x: np.ndarray, k: int) -> Iterator[slice]:
    step = max(1, CELLS // max(k, x.shape[1]))
    for start in range(0, len(x), step):
        yield slice(start, start + step)


def sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int], int]]:
    """Per cluster the number of vectors, their sums by component, and their inertia."""
    k, dims = centroids.shape
    exact = T.DecimalType(38, 0)
    schema = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("totals", T.ArrayType(exact))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists.of(centroids)
        counts, totals = [0] * k, [[0] * (dims + 1) for _ in range(k)]
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            whole = flat.reshape(len(batch), dims)
            for part in _parts(whole, k):
                x = whole[part]
                cluster, distance, _ = nearest(x, lists)
                for c in np.unique(cluster).tolist():
                    mine = cluster == c
                    counts[c] += int(mine.sum())
                    high, low = x[mine] >> 24, x[mine] & 0xFFFFFF  # so that sums fit in 64 bits
                    added = [(int(a) << 24) + int(b) for a, b in zip(high.sum(axis=0), low.sum(axis=0))]
                    added.append(sum(distance[mine].tolist()))
                    totals[c] = [a + b for a, b in zip(totals[c], added)]
        used = [c for c in range(k) if counts[c]]
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array([counts[c] for c in used], pa.int64()),
            pa.array([[Decimal(v) for v in totals[c]] for c in used], pa.list_(pa.decimal128(38, 0)))],
            names=["cluster", "n", "totals"])

    found = (
        vectors.select("__whole__").mapInArrow(run, schema)
        .select("cluster", "n", F.posexplode("totals").alias("at", "total"))
        .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect())  # k * (dims + 1) rows
    out = {c: (0, [0] * (dims + 1)) for c in {r["cluster"] for r in found}}
    for r in found:
        out[r["cluster"]][1][r["at"]] = int(r["total"])
        out[r["cluster"]] = (r["n"], out[r["cluster"]][1])
    return {c: (n, values[:dims], values[dims]) for c, (n, values) in out.items()}


def prepared(df: DataFrame, vector: str, dims: int, scale: int, label: str = "vectors") -> DataFrame:
    """The rows that take part, with their whole numbers in ``__whole__``, stored."""
    kept = df.columns
    names = [*kept, "__whole__"]
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, whole = whole_numbers(batch.column(at), dims, scale)
            batch = batch.filter(pa.array(fits))
            ends = pa.array(np.arange(0, whole.size + 1, dims), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(whole.ravel()))], names=names)

    schema = T.StructType([*source.schema.fields, T.StructField("__whole__", T.ArrayType(T.LongType()))])
    return stored(source.mapInArrow(run, schema), label)


def first_centroids(vectors: DataFrame, key: str, dims: int, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:id``, equal ones by their components."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    chosen = vectors.orderBy(mark, "__whole__").select("__whole__").limit(k).collect()
    return np.array([r[0] for r in chosen], dtype=np.int64).reshape(-1, dims)


def fit(vectors: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after so many rounds; a cluster without vectors keeps its centroid."""
    for _ in range(rounds):
        following = centroids.copy()
        for c, (n, totals, _) in sums(vectors, centroids).items():
            following[c] = [t // n for t in totals]
        if (following == centroids).all():
            break  # every further round would give the same
        centroids = following
    return centroids


def cluster(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10,
    dims: int = 64, scale: int = 1024, seed: int = 3,
) -> DataFrame:
    """The rows of usable vectors with ``cluster``, ``distance``, ``cluster_inertia``,
    ``inertia``, ``centroid_sha256`` and ``probes`` (exact distances worked out)."""
    vectors = prepared(df, vector, dims, scale)
    centroids = fit(vectors, first_centroids(vectors, key, dims, k, seed), rounds)
    new = T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
        T.StructField("probes", T.IntegerType())])
    of_clusters = ("cluster_inertia", "inertia", "centroid_sha256")
    taken = {f.name for f in new.fields} | set(of_clusters)
    kept = [c for c in df.columns if c.lower() not in taken]
    names = [*kept, *[f.name for f in new.fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists.of(centroids)
        for batch in batches:
            x = batch.column(len(kept)).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            found = [nearest(x[part], lists) for part in _parts(x, len(centroids))]
            if not found:
                continue
            numbers, distances, probes = (np.concatenate(c) for c in zip(*found))
            longs = [d if d <= LONG else None for d in distances.tolist()]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array(numbers, pa.int32()), pa.array(longs, pa.int64()),
                pa.array(probes, pa.int32())], names=names)

    source = vectors.select(*[F.col(f"`{c}`") for c in kept], "__whole__")
    assigned = source.mapInArrow(run, T.StructType([*[source.schema[c] for c in kept], *new.fields]))
    spread = {c: s[2] for c, s in sums(vectors, centroids).items()} if len(centroids) else {}
    whole = sum(spread.values())
    rows = [{
        "cluster": c, "cluster_inertia": spread.get(c, 0) if spread.get(c, 0) <= LONG else None,
        "inertia": whole if whole <= LONG else None,
        "centroid_sha256": hashlib.sha256(",".join(map(str, row)).encode()).hexdigest(),
    } for c, row in enumerate(centroids.tolist())]
    of = small_table(df.sparkSession, json.dumps(rows),
                     "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select(
        *[F.col(f"`{c}`") for c in kept], "cluster", "distance", *of_clusters, "probes")
