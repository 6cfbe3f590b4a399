"""Uniform shuffle into exact shards by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, functions as F

from retaloom.llm.common import small_table, stored
from retaloom.operators.numbering import number_rows

_IN_TASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: row within its task


def hypergeometric(rng: random.Random, good: int, bad: int, sample: int) -> int:
    """Draw how many of ``sample`` rows taken from good + bad are good.

    Inversion of the distribution, walked outwards from its mode: a few standard
    deviations of steps, whatever the population.
    """
    low, high = max(0, sample - bad), min(good, sample)
    if low == high:
        return low
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))
    log = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    at = math.exp(log(good, mode) + log(bad, sample - mode) - log(good + bad, sample))
    left = rng.random() - at
    up, down, p_up, p_down = mode, mode, at, at
    while left >= 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (sample - up) / ((up + 1) * (bad - sample + up + 1))
            up, left = up + 1, left - p_up
            if left < 0:
                return up
        if down > low:
            p_down *= down * (bad - sample + down) / ((good - down + 1) * (sample - down + 1))
            down, left = down - 1, left - p_down
            if left < 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each source sends to each shard under a uniform random permutation.

    Row sums are the sources' sizes, column sums the shards'. Source by source, a
    multivariate hypergeometric draw from the places that are still free.
    """
    rng, free, matrix = random.Random(seed), list(shards), []
    for size in sources:
        rest, todo, row = sum(free), size, []
        for k, places in enumerate(free):
            taken = hypergeometric(rng, places, rest - places, todo)
            rest, todo = rest - places, todo - taken
            free[k] -= taken
            row.append(taken)
        matrix.append(row)
    return matrix


def shuffle_into_shards(
    df: DataFrame, shards: int = 24, seed: int = 2024, max_sources: int = 4096
) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard).

    1. Every input partition permutes its own rows; the order is settled in the shared
       folder, so counts and places come from the same rows also after a lost executor.
    2. The driver draws the matrix (partition, shard) -> rows; shard sizes are exact and
       at most one apart. It sees one count per partition; ``max_sources`` bounds their
       number, and with it the matrix, which is why the matrix may be broadcast.
    3. A row's place in its partition says its shard; rows are exchanged.
    4. Within the shard rows are permuted again: they are range-partitioned on (shard,
       random key), so a shard may span many tasks, and numbered without gaps.

    Cases: rows are dealt as they are, whatever they hold; equal rows and NULLs are
    rows like any other. With fewer rows than shards, the last shards stay empty.
    Columns of ``df`` called shard or slot are replaced; its other names are kept in a
    struct on the way, so none can clash.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("whole")
    placed = stored(
        df.coalesce(max_sources)
        .select(whole, F.spark_partition_id().alias("source"), F.rand(seed).alias("key"))
        .sortWithinPartitions("key")
        .select("whole", "source",
                F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)).alias("place")),
        "sources")
    sizes = {r.source: r.n for r in
             placed.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, names = sum(sizes.values()), sorted(sizes)
    quota = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = communication_matrix([sizes[s] for s in names], quota, seed)
    ends = []
    for source, row in zip(names, matrix):
        reached, cuts = 0, []
        for n in row:
            reached += n
            cuts.append(reached)
        ends.append({"source": source, "ends": cuts})
    table = small_table(spark, json.dumps(ends), "source:int,ends:array<bigint>")
    dealt = placed.join(F.broadcast(table), "source").select(
        "whole",
        F.size(F.filter("ends", lambda end: end <= F.col("place"))).alias("shard"),
        F.rand(seed + 1).alias("key"))
    starts = F.array(*[F.lit(sum(quota[:k])).cast("bigint") for k in range(shards)])
    numbered = number_rows(dealt, ["shard", "key"], "position")
    return numbered.select(
        "whole.*", "shard",
        (F.col("position") - 1 - F.element_at(starts, F.col("shard") + 1)).alias("slot"))
