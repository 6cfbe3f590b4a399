import random

import pytest

from retaloom.llm import graph, jaccard


def brute(rows, n, num, den):
    """doc_id -> (size, smallest linked doc_id), by comparing all pairs."""
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc_id] = frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset(
            [tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets, key=lambda i: len(sets[i]))
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if not sets[a] or len(sets[a]) * den < len(sets[b]) * num:
                if sets[a]:
                    break
                continue
            common = len(sets[a] & sets[b])
            if common * den >= num * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed):
    """Chains of ever more changed copies: many pairs just above and just below the limits."""
    rng, rows = random.Random(seed), []
    for base in range(25):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([2, 3, 6, 9, 12, 20, 60, 200, 700]))]
        for _ in range(rng.choice([1, 2, 4, 12])):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10 ** 6)}"
            if rng.random() < 0.3:
                words.append(f"y{rng.randint(0, 10 ** 6)}")
    return rows


@pytest.mark.parametrize("seed,n,num", [(1, 3, 90), (2, 3, 90), (3, 5, 80), (4, 1, 50)])
def test_all_links_are_found(spark, seed, n, num):
    rows = near_copies(seed)
    found = jaccard.join(spark.createDataFrame(rows, "doc_id bigint, text string"), n, num, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == brute(rows, n, num, 100)


def test_tables_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = jaccard.join(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 3, 90, 100)


def test_a_hot_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(1500):
        words = list(base)
        words[k % 300] = f"c{k}"
        rows.append((k, " ".join(words)))
    found = jaccard.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in found} == {0}


def test_linked_sets_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(3)
    for num in (90, 80):
        plan = jaccard.Segments(num, 100)
        for size in [1, 5, 9, 10, 19, 40, 77, 300, 2000, 20000]:
            for _ in range(20):
                whole = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)
                drop = rng.integers(0, size // 10 + 1)
                a, b = np.unique(whole[:size]), np.unique(whole[drop:size + rng.integers(0, size // 10 + 1)])
                common = len(np.intersect1d(a, b))
                if common * 100 >= num * (len(a) + len(b) - common) and not np.array_equal(a, b):
                    (x, need), (y, _) = plan.signatures(a), plan.signatures(b)
                    assert len(np.intersect1d(x, y)) >= need.min()


def test_odd_rows(odd, none):
    found = {(r.doc_id, r.component_id) for r in jaccard.join(odd).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (None, None)} <= found
    assert jaccard.join(odd).count() == odd.count() and jaccard.join(none).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 10]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}


def test_rows_are_kept_by_row_and_alike_under_any_partitioning(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base, "a"), (5, base + " tail", "b"), (5, "a text of its own that nothing is like", "c"),
            (None, base + " more", "d"), (None, other, "e"), (None, other + " x", "f"), (7, "  ", "g"), (7, "  ", "h"),
            (8, "twice the same row but one column", "j"), (8, "twice the same row but one column", "i")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = [sorted((r.doc_id or 0, r.source) for r in jaccard.keep_one(docs.repartition(k, *by)).collect())
             for k, by in ((1, []), (4, ["source"]), (7, ["text"]))]
    assert found[0] == found[1] == found[2]
    ids = [i for i, _ in found[0]]
    assert ids == [0, 1, 5, 7, 8] and (5, "c") in found[0] and found[0][0][1] in "ef"


def test_exact_copies_that_differ_elsewhere_leave_the_same_row(spark):
    from retaloom.llm import dedup

    docs = spark.createDataFrame([(3, "same text", c) for c in "hgfed"], "doc_id bigint, text string, source string")
    assert len({dedup.deduplicate(docs.repartition(k, "source")).first().source for k in (1, 3, 5)}) == 1
