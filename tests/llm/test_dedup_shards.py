import random
from collections import Counter

from retaloom.llm import dedup, sharding


def test_odd_rows(odd, none):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup.assign(odd).collect()}
    assert (1, 1, 3, True) in rows and (2, 1, 3, False) in rows
    assert (3, 3, 2, True) in rows and (4, 3, 2, False) in rows and (5, 5, 1, True) in rows
    assert (6, 6, 2, True) in rows and (7, 6, 2, False) in rows and (None, None, 1, True) in rows
    assert dedup.assign(odd).count() == odd.count() and dedup.assign(none).count() == 0


def test_rows_that_stay_are_whole(odd, none):
    kept = dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id or 0) for r in kept.collect())
    assert ids == [0, 1, 3, 5, 6, 8, 9, 10]
    assert dedup.deduplicate(none).count() == 0


def test_a_hot_text_is_folded_before_the_exchange(spark):
    rows = spark.range(30_000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'hot text' else concat('t', id) end as text")
    found = dedup.winners(rows).where("group_size > 1").collect()
    assert [(r.keep_id, r.group_size) for r in found] == [(0, 10_000)]


def test_draws_have_the_mean_and_variance_of_the_distribution():
    rng = random.Random(1)
    good, bad, sample, n = 300, 700, 100, 4000
    drawn = [sharding.hypergeometric(rng, good, bad, sample) for _ in range(n)]
    mean = sum(drawn) / n
    var = sum((d - mean) ** 2 for d in drawn) / n
    assert abs(mean - 30) < 0.3
    assert abs(var - 100 * 0.3 * 0.7 * 900 / 999) < 1.5
    assert 0 <= sharding.hypergeometric(rng, 10 ** 11, 10 ** 11, 10 ** 6) <= 10 ** 6


def test_matrix_has_exact_margins():
    sources, shards = [5, 0, 17, 100, 3], [32, 31, 31, 31]
    matrix = sharding.communication_matrix(sources, shards, 3)
    assert [sum(r) for r in matrix] == sources and [sum(c) for c in zip(*matrix)] == shards


def test_shards_are_exact_gapless_and_mixed(spark):
    rows = spark.range(0, 6000, 1, 7).selectExpr("id as doc_id", "'s' as shard", "id * 2 as slot")
    found = sharding.shuffle_into_shards(rows, shards=24).collect()
    assert sorted(r.doc_id for r in found) == list(range(6000))
    sizes = Counter(r.shard for r in found)
    assert set(sizes.values()) == {250} and len(sizes) == 24
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(250)) for s in (0, 11, 23))
    # Halves of the input spread evenly, and order within a shard is not the input's.
    low = Counter(r.shard for r in found if r.doc_id < 3000)
    chi = sum((low[s] - 125) ** 2 / 62.5 for s in range(24))
    assert chi < 60
    first = [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot)) if r.shard == 3]
    rising = sum(a < b for a, b in zip(first, first[1:]))
    assert 90 < rising < 160


def test_shards_of_few_odd_or_no_rows(odd, none):
    found = sharding.shuffle_into_shards(odd, shards=24)
    assert set(found.columns) == set(odd.columns) | {"slot"}
    assert sorted(Counter(r.shard for r in found.collect()).values()) == [1] * 12
    assert sharding.shuffle_into_shards(none, shards=24).count() == 0
