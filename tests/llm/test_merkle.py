import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from retaloom.llm import merkle, queries

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def build(leaves):
    """Levels of nodes from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, rank):
    """(left, right) siblings at each level."""
    out = []
    for nodes in levels[:-1]:
        at = rank // 8 * 8
        out.append(("".join(nodes[at:rank]), "".join(nodes[rank + 1:at + 8])))
        rank //= 8
    return out


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of every row."""
    fields = lambda r, text: leaf_of((r.doc_id, r.source, r.lang, r.n_chars, text))
    order = lambda v: (v is not None, v)
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, members = {}, {}
    for g in names:
        members[g] = sorted(groups[g], key=lambda r: (order(r.doc_id), fields(r, r.text)))
        trees[g] = build([fields(r, r.text) for r in members[g]])
    above = build([trees[g][-1][0] for g in names])
    out = []
    for n, g in enumerate(names):
        for i, r in enumerate(members[g]):
            path = way(trees[g], i) + way(above, n)
            text = r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = fields(r, text)
            for left, right in path:
                at = H(left, at, right)
            root = above[-1][0]
            out.append((r.doc_id, trees[g][0][i], trees[g][-1][0], root, H(*(a + b for a, b in path)), at, at == root))
    return sorted(out, key=repr)


def check(docs):
    hit = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    text = F.when(hit, merkle.lower_az(F.col("text"))).otherwise(F.col("text"))
    return sorted(map(tuple, merkle.verify(docs, changed={"text": text}).collect()), key=repr)


def test_odd_rows_match_a_plain_tree(odd, none):
    assert check(odd) == plain(odd.collect())
    assert check(none) == []


@pytest.mark.parametrize("sizes", [(1,), (8,), (9,), (1, 1), (64, 65, 1, 8, 7, 2, 3, 1, 1, 520)])
def test_sizes_around_the_runs(spark, sizes):
    rows = [(g * 1000 + i, f"T{i}", None if g == 1 else f"l{g}", "s", 3) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").repartition(3)
    assert check(docs) == plain(docs.collect())


def test_equal_rows_are_one_record(spark):
    """A third of the rows are copies without an id: equal subtrees, one record each."""
    docs = spark.range(300).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text",
        "'en' as lang", "'s' as source", "1 as n_chars")
    assert check(docs) == plain(docs.collect())


def test_only_wanted_leaves_are_descended(spark):
    docs = spark.range(200).selectExpr(
        "id as key", "concat('g', id % 3) as group", "unhex(sha2(cast(id as string), 256)) as leaf")
    tree = merkle.Manifest(docs, "group", "key", "leaf")
    rows = lambda df: {r.key: (r.path, r.root, r.subroot) for r in df.collect()}
    every, some = rows(tree.descend()), rows(tree.descend(F.col("key").isin(5, 77, 78)))
    assert set(some) == {5, 77, 78} and all(every[k] == v for k, v in some.items())
    proven = tree.descend().select((merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    assert proven.where("ok").count() == 200


def test_query_finds_the_changed_texts(spark, folder):
    found = queries.QUERIES["op13_merkle_descent"](spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in found:
        text = docs[r.doc_id].text or ""
        hit = zlib.crc32(str(r.doc_id).encode()) % 3 == 0
        assert r.verified == (not hit or not any("A" <= c <= "Z" for c in text))
