"""Exact Jaccard join of word n-gram sets by a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, Window

from retaloom.llm.common import hash_words, HashCache, row_order, space_words, stored, texts
from retaloom.llm.graph import components

_A = np.uint64(0x9E3779B97F4A7C15)  # fixed values: odd 64-bit multipliers of mixing steps
_B = np.uint64(0xBF58476D1CE4E5B9)
_R = np.uint64(31)

GROUP_MEMBERS = 1024  # members of a group in the matrix, about
GROUP_QUERIES = 512  # queries that one task compares with a group, about
MATRIX_CELLS = 8_000_000  # cells of a group's matrix that are in memory at a time
FILTER_BITS = 24  # log2 of the bits in the filter over texts that are needed


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _R)) * _B
    return x ^ (x >> _R)


def shingle_set(text: bytes, n: int, cache: HashCache) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct n-word shingles.

    Fewer than n words count as one shingle, no words as the empty set.
    """
    words = hash_words(space_words(text), cache)
    if len(words) == 0:
        return words
    if len(words) < n:
        value = np.array([len(words)], np.uint64)
        for w in words:
            value = _mix(value * _A + w)
        return value
    value = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        value = _mix(value * _A + words[k:len(words) - n + 1 + k])
    return np.unique(value)


def node_of(s: np.ndarray) -> int:
    """A signed 64-bit name of the set, from its size and members."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s))).view(np.int64))


class Segments:
    """Signatures of which linked sets share some.

    Hash space is cut into m equal ranges. Linked sets differ in at most k shingles, so at
    least m - k = slack of their ranges hold the very same shingles; a signature is the
    content of one range. Of those ranges some may be empty: linked sets share at least
    slack less the number of a set's empty ranges, which is what the set ``needs``. The
    rare set with as many empty ranges as that also carries a signature that says so.
    Sizes fall into bands that grow at least as 1 / threshold, so linked sets are in one
    band or in neighbours; each band has its own m, and a set that can be linked into
    the band below carries that band's signatures too.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        grow = max(1.25, den / num)
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:
            self.bounds.append(max(self.bounds[-1] + 1, ceil(self.bounds[-1] * grow)))
        self.edges = np.array(self.bounds)

    def ranges(self, band: int) -> tuple[int, int]:
        """m and slack of a band; m = 0 where only equal sets can be linked."""
        top = self.bounds[band + 1] - 1
        k = (top + top * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        slack = 3 + k // 8
        return (k + slack, slack) if k else (0, slack)

    def signatures(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures, and for each how many of its band a linked set shares at least."""
        band = int(np.searchsorted(self.edges, len(s), side="right")) - 1
        out, needs = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for b in (band, band - 1):
            if b < 0 or b < band and -(-self.num * len(s) // self.den) >= self.bounds[band]:
                continue
            m, slack = self.ranges(b)
            if m:
                made, need = self._of_band(s, b, m, slack)
                out.append(made)
                needs.append(np.full(len(made), need, np.int32))
        return np.concatenate(out), np.concatenate(needs)

    @staticmethod
    def _of_band(s: np.ndarray, band: int, m: int, slack: int) -> tuple[np.ndarray, int]:
        place = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # grows with s
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        total = np.add.reduceat(_mix(s * _A), starts)
        tag = place[starts] * np.uint64(4096) + np.uint64(band + 1)
        made = _mix(total + tag * _A)
        need = slack - (m - len(starts))
        if need <= 0:
            made = np.append(made, _mix(np.array([band + 1], np.uint64) * _B))
        return made, max(1, need)


def _batches(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[k for k, _ in kinds])


def set_names(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, node (NULL for the empty set) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for batch in batches:
            sets = [shingle_set(t, n, cache) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())],
                names=["doc_id", "text_hash", "n_shingles", "node"])

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint")


def signature_rows(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """sig, node, need; a set that a task has met before is not listed again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, plan, met = HashCache(), Segments(num, den), set()
        for batch in batches:
            sigs, nodes, needs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for text in texts(batch):
                s = shingle_set(text, n, cache)
                if len(s) and (node := node_of(s)) not in met:
                    met.add(node)
                    made, need = plan.signatures(s)
                    sigs.append(made)
                    needs.append(need)
                    nodes.append(np.full(len(made), node))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(nodes)),
                 pa.array(np.concatenate(needs))], names=["sig", "node", "need"])

    return docs.select("text").mapInArrow(run, "sig bigint, node bigint, need int")


def _meeting(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """sig, node, need, degree of the nodes that share as many signatures as a link takes.

    A node needs that many with one other node, so with all others together; most nodes,
    which share a passage or a few phrases only, end here. ``degree`` counts whom it meets.
    """
    at = Window.partitionBy("sig")
    shared = stored(
        signature_rows(docs, n, num, den)
        .select("sig", "node", "need", F.min("node").over(at).alias("low"),
                F.max("node").over(at).alias("high"), F.count(F.lit(1)).over(at).alias("met"))
        .where("low <> high").select("sig", "node", "need", "met"), "shared").distinct()
    able = shared.groupBy("node").agg(
        F.count_distinct("sig").alias("sigs"), F.min("need").alias("least"),
        F.sum("met").alias("degree")).where("sigs >= least").select("node", "degree")
    kept = shared.select("sig", "node", "need").distinct().join(able, "node")
    return stored(
        kept.withColumn("low", F.min("node").over(at)).withColumn("high", F.max("node").over(at))
        .where("low <> high").select("sig", "node", "need", "degree"), "meeting")


def _needed(nodes: DataFrame) -> np.ndarray:
    """A bit for the top bits of every node; at most 2 ** (FILTER_BITS - 6) rows of 64."""
    rows = nodes.select(F.shiftrightunsigned("node", 64 - FILTER_BITS).alias("p")).select(
        F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        words[r.word] = r.bits
    return words


def sets_of(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """node, size, members (sorted hashes as bytes) of the given nodes, from the texts.

    A filter of fixed size keeps most other texts from being sent; the join makes it exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_needed(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, words, met = HashCache(), shared.value, set()
        for batch in batches:
            rows = []
            for text in texts(batch):
                s = shingle_set(text, n, cache)
                if not len(s) or (node := node_of(s)) in met:
                    continue
                p = (node & (1 << 64) - 1) >> (64 - FILTER_BITS)
                if int(words[p >> 6]) >> (p & 63) & 1:
                    met.add(node)
                    rows.append((node, len(s), s.tobytes()))
            yield _batches(rows, [("node", pa.int64()), ("size", pa.int64()), ("members", pa.binary())])

    found = docs.select("text").mapInArrow(run, "node bigint, size bigint, members binary")
    kept = found.join(nodes.select("node").distinct(), "node", "left_semi")
    return kept.groupBy("node").agg(F.first("size").alias("size"), F.first("members").alias("members"))


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if min(len(x), len(y)) * den < num * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common * den >= num * (len(x) + len(y) - common)


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their whole sets; sizes are compared first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            passed = [i for i, (x, y) in enumerate(zip(left, right)) if _linked(
                np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)]
            yield batch.select(["a", "b"]).take(pa.array(passed, pa.int64()))

    left = sets.select(F.col("node").alias("a"), F.col("size").alias("n"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("size").alias("m"), F.col("members").alias("right"))
    sizes = pairs.join(left.select("a", "n"), "a").join(right.select("b", "m"), "b")
    fit = sizes.where(F.least("n", "m") * den >= F.greatest("n", "m") * num).select("a", "b")
    return fit.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a bigint, b bigint")


def _positions(sets: list[np.ndarray], union: np.ndarray) -> list[np.ndarray]:
    """Places in the union of each set's members that are in it."""
    out = []
    for x in sets:
        at = np.searchsorted(union, x)
        at[at == len(union)] = 0
        out.append(at[union[at] == x] if len(union) else at[:0])
    return out


def _common(left: list[np.ndarray], right: list[np.ndarray], width: int) -> np.ndarray:
    """Numbers of common places of all pairs, as a product of 0-1 matrices, in column blocks."""
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(256, MATRIX_CELLS // (len(left) + len(right) + 1))
    for start in range(0, width, step):
        size = min(step, width - start)
        blocks = []
        for rows in (left, right):
            block = np.zeros((len(rows), size), np.float32)
            for k, at in enumerate(rows):
                low, high = np.searchsorted(at, (start, start + size))
                block[k, at[low:high] - start] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def _open_groups(queries: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between queries and members of the groups they can be linked to.

    ``queries``: grp, part, q, q_component, q_set; ``members``: grp, part, node, component, set.
    The group's row of the matrix is the union of its members' shingles. A query with fewer
    shingles in it than a link takes has no link there; for the others the group is
    opened: their numbers of common shingles with all members are one matrix product.
    Of the links between components only as many are given as it takes to join them.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        read = lambda t, c: [np.frombuffer(b, np.uint64) for b in t.column(c).to_pylist()]
        inside, asked = read(right, "set"), read(left, "q_set")
        union = np.unique(np.concatenate(inside)) if inside else np.empty(0, np.uint64)
        sizes = np.array([len(x) for x in asked], np.int64)
        places = _positions(asked, union)
        bound = np.array([len(at) for at in places], np.int64) * den >= num * sizes
        open_for, edges = np.flatnonzero(bound), []
        if len(open_for) and inside:
            common = _common([places[k] for k in open_for], _positions(inside, union), len(union))
            n, m = sizes[open_for][:, None], np.array([len(x) for x in inside], np.int64)[None, :]
            a = left.column("q").to_numpy()[open_for]
            b = right.column("node").to_numpy()
            ca = left.column("q_component").to_numpy()[open_for]
            cb = right.column("component").to_numpy()
            linked = common * den >= num * (n + m - common)
            linked &= (a[:, None] > b[None, :]) & (ca[:, None] != cb[None, :])
            root: dict[int, int] = {}

            def find(c: int) -> int:
                while root.get(c, c) != c:
                    c = root[c]
                return c

            for i, k in np.argwhere(linked):
                x, y = find(int(ca[i])), find(int(cb[k]))
                if x != y:
                    root[max(x, y)] = min(x, y)
                    edges.append((int(a[i]), int(b[k])))
        columns = list(zip(*edges)) or [(), ()]
        return pa.table({"a": pa.array(columns[0], pa.int64()), "b": pa.array(columns[1], pa.int64())})

    key = ["grp", "part"]
    return queries.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(run, "a bigint, b bigint")


def _mixed(meeting: DataFrame, groups: DataFrame) -> DataFrame:
    """sig, node, need, component, degree where several components share a signature."""
    at = Window.partitionBy("sig")
    labelled = meeting.join(groups, "node", "left").select(
        "sig", "node", "need", "degree", F.coalesce("component", "node").alias("component"))
    return labelled.withColumn("low", F.min("component").over(at)).withColumn(
        "high", F.max("component").over(at)).where("low <> high").select(
        "sig", "node", "need", "component", "degree")


def _towards(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b): each node with the best-connected node of another component it meets.

    The best of a signature, and the best of its other components: one pair per row. Pairs
    that share fewer signatures than a link takes are none.
    """
    at = Window.partitionBy("sig")
    first = mixed.withColumn("best", F.max(F.struct("degree", "node", "component")).over(at))
    other = first.withColumn("next", F.max(F.when(
        F.col("component") != F.col("best.component"), F.struct("degree", "node"))).over(at))
    pairs = other.select(F.col("node").alias("a"), "need", F.when(
        F.col("component") != F.col("best.component"), F.col("best.node")).otherwise(
        F.col("next.node")).alias("b")).where("b is not null")
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    return counted.where("n >= need").select("a", "b")


def _matrix_links(mixed: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between components that share signatures, by the token-group matrix.

    Groups are made by the best-connected node that a node meets, linked to it or not, and
    cut into parts of about GROUP_MEMBERS.
    """
    at = Window.partitionBy("sig")
    hubs = mixed.withColumn("hub", F.max(F.struct("degree", "node")).over(at)).groupBy(
        "node", "component").agg(F.max("hub").alias("hub")).select("node", "component", F.col("hub.node").alias("hub"))
    sizes = hubs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / GROUP_MEMBERS).alias("cuts"))
    in_group = stored(
        hubs.join(sizes, "hub").select("node", "component", F.concat_ws(
            "/", "hub", F.pmod(F.xxhash64("node"), F.col("cuts"))).alias("grp")), "groups")
    targets = mixed.select("sig", "node").join(in_group, "node").groupBy("sig", "grp").agg(
        F.min("node").alias("lowest"), F.min("component").alias("c1"), F.max("component").alias("c2"))
    met = (F.col("node") > F.col("lowest")) & ((F.col("c1") != F.col("c2")) | (F.col("c1") != F.col("component")))
    candidates = stored(
        mixed.select("sig", "node", "need", "component").join(targets, "sig").where(met)
        .groupBy("node", "component", "grp")
        .agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
        .where("n >= need").select("node", "component", "grp"), "queries")
    # A group with very many queries is opened in several tasks.
    parts = candidates.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).alias("parts"))
    queries = candidates.join(parts, "grp").join(sets, "node").select(
        "grp", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), F.col("node").alias("q"),
        F.col("component").alias("q_component"), F.col("members").alias("q_set"))
    members = in_group.join(parts, "grp").join(sets, "node").select(
        "grp", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        "node", "component", F.col("members").alias("set"))
    return _open_groups(queries, members, num, den)


def join(
    docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, rounds: int = 3
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; linked if den * common >= num * union.

    1. Equal sets are one node; only nodes are compared.
    2. Partition: nodes that share a signature (see Segments) meet, if they share as many
       as a link takes. Each is tested against
       the best-connected node it meets, which tends to be the text that the others are
       copies of. Links make components; then nodes that meet other components are
       tested against the best-connected node of those, ``rounds`` times. So similar documents
       come to be together, also a third of all rows, and pairs within are not made.
    3. Matrix: nodes that still meet other components are put into groups of about 1024 by
       the best-connected node they meet; a group's row is the union of its members'
       shingles. A query is a node that meets another component in the group. If fewer of its
       shingles are in the union than a link takes, no member can be linked; else the
       group is opened, and the query compared with its members.
    4. Components of all links; the id is the smallest doc_id of each.

    Every link joins two nodes with a common signature, so either they were in one group
    already or the query met the group: no link between components is lost.

    Cases: NULL, empty and blank texts have no set (n_shingles 0) and their own doc_id as
    component_id; repeated rows and ids are linked as any equal texts (a NULL id is
    ignored by the minimum); an empty table gives an empty result; further columns are not
    read. Shingles are compared by 64-bit hashes, nodes by a 64-bit hash of the set.
    """
    grouped = _grouped(docs, n, num, den, rounds)
    lowest = grouped.where("node is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(lowest, "component", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _grouped(docs: DataFrame, n: int, num: int, den: int, rounds: int = 3) -> DataFrame:
    """doc_id, text_hash, n_shingles, node, component (a node; NULL without words) of every row."""
    docs = docs.select("doc_id", "text")
    names = stored(set_names(docs, n), "names")
    meeting = _meeting(docs, n, num, den)
    sets = stored(sets_of(docs, meeting.select("node"), n), "sets")

    none = meeting.select("node", F.col("node").alias("component")).where("false")
    mixed, links, groups = stored(_mixed(meeting, none), "mixed"), None, none
    tested = None
    for _ in range(rounds):
        pairs = _towards(mixed)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(_links(pairs, sets, num, den), "links")
        if links is not None and not found.take(1):
            break
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        groups = stored(components(links), "groups")
        mixed = stored(_mixed(meeting, groups), "mixed")

    if mixed.take(1):
        more = stored(_matrix_links(mixed, sets, num, den), "links")
        if more.take(1):
            groups = stored(components(links.union(more)), "groups")

    return names.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group of linked ones, with all its columns.

    It is the row with the smallest id, a row without an id only where none of the group has
    one; among rows of one id, that of the smallest set name and text hash. Rows are chosen, not
    ids: of two texts under one id each stands or falls by itself. A document without words is
    a group of its own. Of rows with the same id and text one stays, whichever comes
    first by all columns, so the result does not depend on the partitions.
    """
    grouped = _grouped(docs, n, num, den)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "text_hash")
    own = ["doc_id", "text_hash"]
    # Combined before the exchange: a group of a third of all rows is one row per task.
    won = grouped.where("node is not null").groupBy("component").agg(F.min(place).alias("w")).select("w.doc_id", "w.text_hash")
    kept = won.unionByName(grouped.where("node is null").select(*own)).distinct().select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
        F.col("`doc_id`").cast("bigint").alias("own"), F.xxhash64("`text`").alias("h"))
    one = Window.partitionBy("own", "h").orderBy(row_order("whole", rows))
    return rows.join(kept, F.col("own").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")), "left_semi").withColumn(
        "r", F.row_number().over(one)).where("r = 1").select("whole.*")
