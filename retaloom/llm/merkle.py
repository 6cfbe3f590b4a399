"""Merkle manifest of a table as a content-addressed graph, and proofs by descending it.

Rows hash to leaves. The leaves of a group, in key order, are folded eight at a time until one
node is left, the group's subroot; the subroots, in group order, are folded likewise into the
root. Every fold writes a record from the digest to its children, and nothing else is needed to
prove a leaf: its rank in base eight says which child to take at each step down from the root.

All leaves descend together: a step holds one row per node of the level instead of one per leaf,
looks the node's record up by digest, and hands each child its siblings, split at its digit.
Only the last step, where eight leaves share a row, meets the leaves themselves. The segments
gathered from the root down are then reversed, as a proof starts at the leaf. A level's
records and its steps are an eighth of those of the level below, so all that is moved is a small
multiple of the digests; texts are read once, when they are hashed.

Defined cases: a null value hashes as ``-``. Rows of one key are ordered by their digests, null
keys come first, so does the null group. Repeated rows are leaves each; equal subtrees are one
record. A group of one leaf has that leaf as its subroot, one group's subroot is the root. An empty
table has no root and no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retaloom.llm.common import stored
from retaloom.operators.numbering import number_rows

BITS = 3  # of a rank for a level: runs of eight
RUN = 1 << BITS
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# Digests are kept as 32 bytes; their hex text, which they are combined by, is made where needed.

def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_hash(digests: Column) -> Column:
    """Hash of the hex texts of an array of digests, one after the other."""
    return F.unhex(F.sha2(F.array_join(F.transform(digests, hexed), ""), 256))


def leaf_hash(fields: list[Column]) -> Column:
    """Hash of the fields' lengths and values."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def levels_of(size: Column) -> Column:
    """How often so many nodes are folded until one is left: the octal digits of size - 1."""
    return F.when(size > 1, F.length(F.conv((size - 1).cast("string"), 10, RUN))).otherwise(0)


def fold(nodes: DataFrame, most: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Folds the nodes (grp, idx, height, digest) of every group. Returns the records
    (digest, children) of each level from 1 up, and the top node of each group."""
    records, tops = [], nodes.where("height = 0")
    for level in range(1, most + 1):
        grown = (
            nodes.where(F.col("height") >= level)
            .groupBy("grp", F.shiftright("idx", BITS).alias("idx"), "height")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))),
                             lambda c: c.digest).alias("children")))
        made = stored(grown.withColumn("digest", joined_hash(F.col("children"))), f"{label}-{level}")
        records.append(made.select("digest", "children"))
        nodes = made.select("grp", "idx", "height", "digest")
        tops = tops.unionByName(nodes.where(F.col("height") == level))
    return records, tops


def _segment(children: Column, digit: Column) -> Column:
    """What stands left and right of a child among its siblings."""
    joined = lambda part: F.aggregate(part, F.unhex(F.lit("")), lambda a, b: F.concat(a, b))
    return F.struct(
        joined(F.slice(children, F.lit(1), digit)).alias("l"),
        joined(F.slice(children, digit + 2, F.lit(RUN))).alias("r"))


def _looked_up(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The frontier with the children of its nodes, found by digest; equal nodes are one record."""
    once = records.groupBy("digest").agg(F.first("children").alias("children"))
    return frontier.join(once, "digest")


def _step(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """One level down: a row per child, with its siblings at the end of its path."""
    carried = [c for c in frontier.columns if c not in ("digest", "idx", "path")]
    return _looked_up(frontier, records).select(
        *carried, "idx", "path", "children", F.posexplode("children").alias("digit", "digest")
    ).select(
        *carried, (F.shiftleft("idx", BITS) + F.col("digit")).alias("idx"), "digest",
        F.array_append("path", _segment(F.col("children"), F.col("digit"))).alias("path"))


def _most(df: DataFrame) -> int | None:
    return df.agg(F.max("height")).first()[0]


class Manifest:
    """The graph over a table: ``leaves`` (grp, rank and the given columns), records per level."""

    def __init__(self, rows: DataFrame, group: str, key: str, digest: str):
        """``rows`` hold the group, the key, the leaf digest and whatever is carried along."""
        numbered = number_rows(
            rows.withColumn("__tie__", F.monotonically_increasing_id()),
            [F.col(f"`{group}`"), F.col(f"`{key}`"), F.col(f"`{digest}`")], "__n__", tie="__tie__")
        sizes = stored(numbered.groupBy(F.col(f"`{group}`").alias("__group__")).agg(
            F.min("__n__").alias("__first__"), F.count(F.lit(1)).alias("size")), "merkle-groups")
        groups = number_rows(sizes, ["__group__"], "grp").withColumn("grp", F.col("grp") - 1)
        self.groups = stored(groups.withColumn("height", levels_of(F.col("size"))), "merkle-groups")
        self.leaves = stored(
            numbered.join(self.groups, F.col(f"`{group}`").eqNullSafe(F.col("__group__")))
            .withColumn("rank", F.col("__n__") - F.col("__first__"))
            .drop("__n__", "__first__", "__group__", "size"), "merkle-leaves")
        self.digest = digest
        self.most = _most(self.groups)
        if self.most is None:
            return
        nodes = self.leaves.select("grp", F.col("rank").alias("idx"), "height", F.col(f"`{digest}`").alias("digest"))
        self.records, subroots = fold(nodes, self.most, "merkle-nodes")
        height = levels_of(F.lit(self.groups.count()))
        above = stored(subroots.select(
            F.lit(0).alias("grp"), F.col("grp").alias("idx"), height.alias("height"), "digest"), "merkle-subroots")
        self.most_above = _most(above)
        self.records_above, top = fold(above, self.most_above, "merkle-above")
        self.root = stored(top.select("digest"), "merkle-root")

    def descend(self, wanted: Column | None = None) -> DataFrame:
        """The leaves (or those wanted) with ``subroot``, ``root`` and ``path``: from the leaf up,
        what stands left and right of the way at each level."""
        asked = self.leaves if wanted is None else self.leaves.where(wanted)
        if self.most is None:
            return asked.select(
                "*", *[F.lit(None).cast("binary").alias(c) for c in ("subroot", "root")],
                F.lit(None).cast("array<struct<l:binary,r:binary>>").alias("path"))
        no_path = F.array().cast("array<struct<l:binary,r:binary>>")
        frontier = self.root.select(
            F.lit(0).cast("bigint").alias("idx"), "digest", F.col("digest").alias("root"), no_path.alias("path"))

        def only(rows: DataFrame, keys: Column) -> DataFrame:
            if wanted is None:
                return rows
            return rows.join(asked.select(*keys).distinct(), ["grp", "idx"], "left_semi")

        for records in reversed(self.records_above):
            frontier = _step(frontier, records)  # read once a level
        frontier = only(
            frontier.withColumnRenamed("idx", "grp").withColumn("idx", F.lit(0).cast("bigint")),
            ["grp", F.lit(0).cast("bigint").alias("idx")],
        ).join(self.groups.select("grp", "height"), "grp").withColumn("subroot", F.col("digest"))
        frontier = stored(frontier, "merkle-frontier")
        for level in range(self.most, 1, -1):
            ready = F.col("height") >= level
            down = _step(frontier.where(ready), self.records[level - 1])
            kept = only(down, ["grp", F.shiftright("rank", BITS * (level - 1)).alias("idx")])
            # Written, as it is read twice a level: a plan would double with every level.
            frontier = stored(kept.unionByName(frontier.where(~ready)), f"merkle-frontier-{level}")
        last = frontier.where("height = 0").withColumn("children", F.lit(None).cast("array<binary>"))
        if self.most:
            last = last.unionByName(_looked_up(frontier.where("height > 0"), self.records[0]))
        met = asked.withColumn("idx", F.shiftright("rank", BITS)).join(
            last.select("grp", "idx", "children", "path", "subroot", "root"), ["grp", "idx"])
        digit = F.col("rank").bitwiseAND(F.lit(RUN - 1)).cast("int")
        whole = F.when(F.col("children").isNull(), F.col("path")).otherwise(
            F.array_append("path", _segment(F.col("children"), digit)))
        return met.withColumn("path", F.reverse(whole)).drop("idx", "children")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda at, s: F.unhex(F.sha2(hexed(F.concat(s.l, at, s.r)), 256)))


def proof_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: hexed(F.concat(s.l, s.r))), ""), 256)


def verify(
    docs: DataFrame, fields: tuple[str, ...] = LEAF_FIELDS, group: str = "lang", key: str = "doc_id",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row its key, leaf, subroot, root, the digest of its proof, and whether the row as it
    is now (``changed`` replaces columns) still leads to the root."""
    column = lambda f: F.col(f"`{f}`")
    now = {f: (changed or {}).get(f, column(f)) for f in fields}
    rows = docs.select(
        column(key).alias("key"), column(group).alias("group"),
        leaf_hash([column(f) for f in fields]).alias("leaf"),
        leaf_hash([now[f] for f in fields]).alias("seen"))
    proven = Manifest(rows, "group", "key", "leaf").descend()
    root = folded(F.col("seen"), F.col("path"))
    return proven.select(
        F.col("key").alias(key), *[hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        proof_hash(F.col("path")).alias("proof_sha256"), hexed(root).alias("folded_root"),
        (root == F.col("root")).alias("verified"))


def lower_az(text: Column) -> Column:
    return F.translate(text, AZ, AZ.lower())
