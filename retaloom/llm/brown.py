"""Language-model scores by Brown class bigrams, classes found by exchange over the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from retaloom.llm.common import space_words, stored, texts

CLASSES = 32
FREQUENT = 1 << 14  # a word with at least 1 / FREQUENT of the training tokens is a unit of its own
CELLS = 1 << 14  # until they get a class of their own, the other words are units by hash
UNITS = 1 + FREQUENT + CELLS  # unit 0 is the end of a text
LINES = 1  # rows of kind LINES hold texts, of kind WORDS the words of their block
WORDS = 2
BLOCK_BYTES = 32 << 20
TABLES = {"compression": "zstd"}


def blocks(docs: DataFrame, train: Column) -> DataFrame:
    """Texts as numbers of words within their block, and the words of every block.

    A block is what one task reads, up to BLOCK_BYTES. Of each block's words the training
    count is given: the corpus's word counts are combined per block before any shuffle.
    """
    kinds = [("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()),
             ("train", pa.bool_()), ("n", pa.int64()), ("words", pa.binary()),
             ("number", pa.int32()), ("word", pa.binary())]

    def batch_of(**given) -> pa.RecordBatch:
        size = len(next(iter(given.values())))
        return pa.RecordBatch.from_arrays(
            [pa.array(given[k], t) if k in given else pa.nulls(size, t) for k, t in kinds],
            names=[k for k, _ in kinds])

    def close(block: int, numbers: dict[bytes, int], seen: list[np.ndarray]) -> pa.RecordBatch:
        counts = np.bincount(np.concatenate(seen or [np.empty(0, np.int32)]), minlength=len(numbers))
        size = len(numbers)
        return batch_of(kind=np.full(size, WORDS, np.int32), block=np.full(size, block),
                        n=counts, number=np.arange(size, dtype=np.int32), word=list(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block, size = TaskContext.get().partitionId(), 0, 0
        numbers: dict[bytes, int] = {b"": 0}  # the empty word is the end
        seen: list[np.ndarray] = []
        for batch in batches:
            ids, trains = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for text in texts(batch):
                words = space_words(text)
                words.append(b"")
                for w in set(words).difference(numbers):
                    numbers[w] = len(numbers)
                rows.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                size += len(text)
            seen += [r for r, t in zip(rows, trains) if t]
            if rows:
                yield batch_of(
                    kind=np.full(len(rows), LINES, np.int32), block=[task << 32 | block] * len(rows),
                    doc_id=ids, train=trains, n=[len(r) for r in rows],
                    words=[r.tobytes() for r in rows])
            if size >= BLOCK_BYTES:
                yield close(task << 32 | block, numbers, seen)
                block, size, numbers, seen = block + 1, 0, {b"": 0}, []
        if size or not block:
            yield close(task << 32 | block, numbers, seen)

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), train.alias("train"), "text"
    ).mapInArrow(run, "kind int, block bigint, doc_id bigint, train boolean, n bigint, "
                      "words binary, number int, word binary")


class Counts:
    """What the corpus says about words: token and type totals, and the frequent words."""

    def __init__(self, lines: DataFrame, words: DataFrame):
        found = lines.where("train").agg(F.sum("n")).first()[0]
        self.tokens = int(found or 0)
        same = Window.partitionBy("word")
        counted = words.select(
            "block", "number", "word", F.sum("n").over(same).alias("c"),
            (F.min("block").over(same) == F.col("block")).alias("first"),
            F.min(F.struct(F.col("block").alias("home"), F.col("number").alias("at"))).over(same).alias("key"))
        # The end, number 0 everywhere, is a unit however few texts there are.
        frequent = (F.col("number") == 0) | (F.col("c") > 0) & (F.col("c") * FREQUENT >= self.tokens)
        # block, number: the word there; unit words by name, others by the place where they
        # come first (home, at), which is the word's key, and by cell.
        self.table = stored(counted.select(
            "block", "number", "c", "first", "key.*",
            F.when(frequent, F.col("word")).alias("word"),
            F.pmod(F.xxhash64("word"), F.lit(CELLS)).cast("int").alias("cell")), "counts", TABLES)
        known = self.table.where("first and c > 0")
        self.types = known.count()
        # At most FREQUENT words have 1 / FREQUENT of the tokens or more; the end is unit 0.
        top = sorted(known.where("word is not null").select("word", "c").collect(),
                     key=lambda r: (-r.c, bytes(r.word)))
        self.names = [bytes(r.word) for r in top if len(r.word)]
        self.unit_tokens = np.zeros(UNITS)
        self.unit_types = np.zeros(UNITS)
        place = {w: 1 + k for k, w in enumerate(self.names)}
        self.units = {b"": 0, **place}
        for r in top:
            self.unit_tokens[self.units[bytes(r.word)]] = r.c
            self.unit_types[self.units[bytes(r.word)]] = 1

    @property
    def mass(self) -> float:
        """Denominator of the add-half unigram: tokens, and a half for each type and the unknown."""
        return self.tokens + 0.5 * (self.types + 1)


def _units_of(right: pa.Table, names: dict[bytes, int]) -> np.ndarray:
    """The units of a block's words, by their number there."""
    number = right.column("number").to_numpy()
    unit = np.zeros(int(number.max(initial=0)) + 1, np.uint16)
    unit[number] = right.column("cell").to_numpy() + (1 + FREQUENT)
    for k, w in zip(number, right.column("word").to_pylist()):
        if w is not None:
            unit[k] = names[w]
    unit[0] = 0  # the end has number 0 in every block
    return unit


def encode(train: DataFrame, counts: Counts) -> DataFrame:
    """The units of every text of ``train``.

    Texts meet the counts of their block's words, so each text's words are looked up in an
    array; a block is bounded by BLOCK_BYTES, whatever a word's share of the corpus.
    """
    names = counts.units

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        unit = _units_of(right, names)
        return pa.table({"units": pa.array(
            [unit[np.frombuffer(w, np.int32)].tobytes() for w in left.column("words").to_pylist()],
            pa.binary())})

    table = counts.table.select("block", "number", "word", "cell")
    return train.select("block", "words").groupBy("block").cogroup(
        table.groupBy("block")).applyInArrow(look_up, "units binary")


def contexts(train: DataFrame, counts: Counts, classes: np.ndarray) -> DataFrame:
    """block, number, c, home, at, cell and around of every word that is no unit by name.

    ``around`` has two bytes for each time the word occurs in the block's training texts:
    the class before it, and CLASSES + the class after it.
    """
    names = counts.units

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        cls = classes[_units_of(right, names)]
        rare = right.filter(right.column("word").is_null())
        number = rare.column("number").to_numpy()
        place = np.full(len(cls), -1, np.int32)
        place[number] = np.arange(len(number))
        line = np.concatenate([np.zeros(1, np.int32), *(
            np.frombuffer(w, np.int32) for w in left.column("words").to_pylist())])
        rows, c = place[line], cls[line]  # a text ends in number 0, which is a unit
        found = np.flatnonzero(rows >= 0)
        found = found[np.argsort(rows[found], kind="stable")]
        around = np.stack([c[found - 1], c[found + 1] + np.uint8(CLASSES)], axis=1)
        ends = np.zeros(len(number) + 1, np.int64)
        np.cumsum(2 * np.bincount(rows[found], minlength=len(number)), out=ends[1:])
        packed = pa.Array.from_buffers(pa.binary(), len(number), [
            None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(around.tobytes())])
        return pa.table({k: rare.column(k) for k in ("block", "number", "c", "home", "at", "cell")}
                        | {"around": packed})

    table = counts.table.select("block", "number", "c", "home", "at", "word", "cell")
    return train.select("block", "words").groupBy("block").cogroup(table.groupBy("block")).applyInArrow(
        look, "block bigint, number int, c bigint, home bigint, at int, cell int, around binary")


def own_classes(seen: DataFrame, grid: np.ndarray, classes: np.ndarray, half: float = 0.5) -> DataFrame:
    """block, number, c, first, class of every word that is no unit by name.

    All places of a word come together, and the word gets the class in which its own
    neighbours are likeliest under the class bigrams ``grid``. A word without training
    occurrences has the class of its cell. State is one batch and one word's rows.
    """
    size = grid.sum(axis=0) + half * CLASSES
    fit = np.concatenate([np.log(grid + half), np.log(grid.T + half)]) - np.log(size)  # around, class
    fit[:, 0] = -np.inf  # the end is alone

    def placed(rows: pa.Table) -> pa.RecordBatch:
        home, at = rows.column("home").to_numpy(), rows.column("at").to_numpy()
        new = np.append(True, (home[1:] != home[:-1]) | (at[1:] != at[:-1]))
        word = np.cumsum(new) - 1
        around = rows.column("around").to_pylist()
        codes = np.frombuffer(b"".join(around), np.uint8)
        times = np.fromiter(map(len, around), np.int64, len(around))
        n = np.bincount(np.repeat(word, times) * (2 * CLASSES) + codes,
                        minlength=(word[-1] + 1) * 2 * CLASSES).reshape(-1, 2 * CLASSES)
        best = 1 + (n @ fit[:, 1:]).argmax(axis=1)
        best = best[word]
        unseen = rows.column("c").to_numpy() == 0
        best[unseen] = classes[rows.column("cell").to_numpy()[unseen] + (1 + FREQUENT)]
        block, number = rows.column("block").to_numpy(), rows.column("number").to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(block), pa.array(number), pa.array(rows.column("c").to_numpy()),
             pa.array((home == block) & (at == number)), pa.array(best.astype(np.int32))],
            names=["block", "number", "c", "first", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([kept, rows]) if kept is not None else rows
            if not rows.num_rows:
                continue
            home, at = rows.column("home").to_numpy(), rows.column("at").to_numpy()
            before = np.flatnonzero((home != home[-1]) | (at != at[-1]))
            cut = int(before[-1]) + 1 if len(before) else 0  # the last word may go on
            if cut:
                yield placed(rows.slice(0, cut))
            kept = rows.slice(cut)
        if kept is not None and kept.num_rows:
            yield placed(kept)

    return seen.repartition("home", "at").sortWithinPartitions("home", "at").mapInArrow(
        run, "block bigint, number int, c bigint, first boolean, class int")


def in_classes(lines: DataFrame, counts: Counts, own: DataFrame, classes: np.ndarray) -> DataFrame:
    """doc_id, train, n_tokens, n_known, mass (sum of log10(c + 0.5)), classes of every text."""
    names = counts.units

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        number = right.column("number").to_numpy()
        size = int(number.max(initial=0)) + 1
        c, cls = np.zeros(size, np.int64), np.zeros(size, np.uint8)
        c[number] = right.column("c").to_numpy()
        cls[number] = right.column("class").to_numpy()
        named = right.filter(right.column("word").is_valid())
        for k, w in zip(named.column("number").to_pylist(), named.column("word").to_pylist()):
            cls[k] = classes[names[w]]
        cls[0] = 0
        logs = np.log10(c + 0.5)
        rows = [np.frombuffer(w, np.int32) for w in left.column("words").to_pylist()]
        return pa.table({
            "doc_id": left.column("doc_id"), "train": left.column("train"), "n_tokens": left.column("n"),
            "n_known": pa.array([int((c[r] > 0).sum()) for r in rows], pa.int64()),
            "mass": pa.array([float(logs[r].sum()) for r in rows], pa.float64()),
            "classes": pa.array([cls[r].tobytes() for r in rows], pa.binary())})

    named = counts.table.where("word is not null").select(
        "block", "number", "c", F.lit(0).alias("class"), "word")
    table = named.union(own.select("block", "number", "c", "class", F.lit(None).cast("binary")))
    return lines.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(
        look_up, "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, mass double, classes binary")


def _unit_rows(batches: Iterator[pa.RecordBatch], kind: type = np.uint16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Previous and next units of all bigrams of a batch; texts begin after an end."""
    for batch in batches:
        cells = [np.frombuffer(u, kind) for u in batch.column(0).to_pylist()]
        if cells:
            line = np.concatenate([np.zeros(1, kind), *cells])  # each text ends in unit 0
            yield line[:-1], line[1:]


def neighbours(train: DataFrame, classes: np.ndarray) -> np.ndarray:
    """counts[unit, 0 or 1, class]: how often the class comes before, after the unit.

    Tasks add up dense arrays of UNITS x 2 x CLASSES, whatever they read; the rows
    meet by unit. The sum has that size too.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, UNITS * CLASSES), np.int64)
        for before, after in _unit_rows(batches):
            for side, unit, other in ((0, after, before), (1, before, after)):
                total[side] += np.bincount(
                    unit.astype(np.int64) * CLASSES + classes[other], minlength=UNITS * CLASSES)
        both = total.reshape(2, UNITS, CLASSES).transpose(1, 0, 2).astype("<i4")
        used = np.flatnonzero(both.any(axis=(1, 2)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([both[u].tobytes() for u in used], pa.binary())],
            names=["unit", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for unit, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = np.frombuffer(c, "<i4").astype(np.int64)
                total[unit] = total[unit] + row if unit in total else row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()),
             pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["unit", "counts"])

    kind = "unit bigint, counts binary"
    parts = train.mapInArrow(count, kind)
    out = np.zeros((UNITS, 2, CLASSES))
    for r in parts.repartition("unit").mapInArrow(add, kind).toLocalIterator():
        out[r.unit] = np.frombuffer(r.counts, np.int64).reshape(2, CLASSES)
    return out


def transitions(train: DataFrame, classes: np.ndarray | None = None) -> np.ndarray:
    """counts[class, class] of all bigrams of units, or of texts given in classes."""
    kind = np.uint8 if classes is None else np.uint16
    classes = np.arange(CLASSES) if classes is None else classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for before, after in _unit_rows(batches, kind):
            total += np.bincount(classes[before].astype(np.int64) * CLASSES + classes[after],
                                 minlength=CLASSES * CLASSES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array(total)], names=["pair", "n"])

    rows = train.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(
        F.sum("n").alias("n")).collect()
    out = np.zeros(CLASSES * CLASSES)
    for r in rows:
        out[r.pair] = r.n
    return out.reshape(CLASSES, CLASSES)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def first_classes() -> np.ndarray:
    """The end alone in class 0, the most frequent words in one class each, others by hash."""
    units = np.arange(UNITS, dtype=np.uint64)
    out = ((units * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(CLASSES - 1) + np.uint64(1)).astype(np.uint8)
    out[1:CLASSES] = np.arange(1, CLASSES)
    out[0] = 0
    return out


def exchange(classes: np.ndarray, around: np.ndarray, sweeps: int = 3) -> np.ndarray:
    """Move units, the most frequent first, to the class where the bigram likelihood gains most.

    ``around`` are the units' neighbours by class; within a round the classes of the
    neighbours stay as they were counted, so a move changes the rows of two classes alone.
    Frequent units move one by one, rarer ones in steps of some, on rows kept up to date.
    """
    classes, sides = classes.copy(), (around[:, 0], around[:, 1])
    weight = around.sum(axis=(1, 2))
    order = np.argsort(-weight, kind="stable")
    order = order[(order != 0) & (weight[order] > 0)]
    tables = []
    for counts in sides:
        rows = np.zeros((CLASSES, CLASSES))
        np.add.at(rows, classes, counts)
        tables.append(rows)
    steps = [order[k:k + 1] for k in range(min(1024, len(order)))]
    steps += [order[k:k + 32] for k in range(1024, len(order), 32)]
    for _ in range(sweeps):
        moves = 0
        for units in steps:
            own, at = classes[units], np.arange(len(units))
            gain = np.zeros((len(units), CLASSES))
            for counts, rows in zip(sides, tables):
                c, size, sums = counts[units], counts[units].sum(axis=1), rows.sum(axis=1)
                gain += (_xlogx(rows[None] + c[:, None, :]) - _xlogx(rows)[None]).sum(axis=2)
                gain -= _xlogx(sums[None] + size[:, None]) - _xlogx(sums)[None]
                # In its own class the unit is counted already: what it would gain if it came back.
                rest, left = np.maximum(rows[own] - c, 0), np.maximum(sums[own] - size, 0)
                back = (_xlogx(rows[own]) - _xlogx(rest)).sum(axis=1) - _xlogx(sums[own]) + _xlogx(left)
                wrong = (_xlogx(rows[own] + c) - _xlogx(rows[own])).sum(axis=1) \
                    - _xlogx(sums[own] + size) + _xlogx(sums[own])
                gain[at, own] += back - wrong
            gain[:, 0] = -np.inf
            best = gain.argmax(axis=1)
            moved = best != own
            moves += int(moved.sum())
            for counts, rows in zip(sides, tables):
                np.add.at(rows, own[moved], -counts[units[moved]])
                np.add.at(rows, best[moved], counts[units[moved]])
            classes[units] = best
        if not moves:
            break
    return classes


class Model:
    """Class transitions, class masses and the mixture with the unigram."""

    def __init__(self, classes: np.ndarray, grid: np.ndarray, counts: Counts,
                 weight: float = 0.9, half: float = 0.1, rest: np.ndarray | float = 0.0):
        by_class = lambda x: np.bincount(classes, weights=x, minlength=CLASSES)
        # ``rest`` is the mass of the words that are no units by name, by class.
        mass = by_class(counts.unit_tokens) + 0.5 * by_class(counts.unit_types) + 0.5 + rest
        follow = (grid + half) / (grid.sum(axis=1, keepdims=True) + half * CLASSES)
        # log10 of P(word | previous) / P(word): emission and unigram have the same numerator
        # c + 0.5, so the ratio depends on the classes alone.
        self.ratio = np.log10(weight * follow * counts.mass / mass[None, :] + (1 - weight))


def score(docs: DataFrame, train: Column, rounds: int = 4) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    P(word | previous) = 0.9 P(class | previous class) P(word | class) + 0.1 P(word), with
    add-half word emissions within the class and add-half unigrams; log10, summed over the words
    and the end of the text.

    1. One pass numbers words per block; counts of all words meet in one shuffle.
    2. Words with 1/16384 of the tokens or more are units; until step 4 the others share units
       by hash of the word, so what is collected or sent to tasks has a fixed bound.
    3. ``rounds`` times: a pass counts every unit's neighbours by class, then the units are
       exchanged between classes. A pass counts class transitions.
    4. Every other word of the training texts, however rare, gets the class in which its own
       neighbours are likeliest: the classes around it are shuffled by word, and executors
       assign each word against the CLASSES x CLASSES transitions. Only words that no training
       text has keep the class of their hash.
    5. Texts are turned into classes, a byte a word; a pass counts the transitions anew, and a
       pass scores.

    Cases: NULL and empty texts are the end alone; repeated rows count as often as they occur;
    without training rows all words are unknown; an empty table gives an empty result;
    further columns are not read.
    """
    made = stored(blocks(docs, train), "blocks", TABLES, ["kind"])
    lines = made.where(F.col("kind") == LINES).select("block", "doc_id", "train", "n", "words")
    words = made.where(F.col("kind") == WORDS).select("block", "number", "word", "n")
    counts = Counts(lines, words)
    learned = stored(encode(lines.where("train"), counts), "units", TABLES)
    classes = first_classes()
    for _ in range(rounds):
        classes = exchange(classes, neighbours(learned, classes))
    own = stored(own_classes(contexts(lines.where("train"), counts, classes),
                             transitions(learned, classes), classes), "own", TABLES)
    rest = np.zeros(CLASSES)
    for r in own.where("first and c > 0").groupBy("class").agg(
            (F.sum("c") + 0.5 * F.count(F.lit(1))).alias("mass")).collect():
        rest[r["class"]] = r["mass"]
    coded = stored(in_classes(lines, counts, own, classes), "classes", TABLES)
    model = Model(classes, transitions(coded.where("train").select("classes")), counts, rest=rest)
    tokens, mass = counts.tokens, counts.mass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gains = []
            for u in batch.column(5).to_pylist():
                c = np.frombuffer(u, np.uint8)
                before = np.concatenate([np.zeros(1, np.uint8), c[:-1]])
                gains.append(float(model.ratio[before, c].sum()))
            n = batch.column(2).to_numpy()
            base = batch.column(4).to_numpy() - n * np.log10(mass)
            total = base + np.array(gains)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.full(len(n), tokens)), pa.array(base), pa.array(total),
                 pa.array(10.0 ** np.minimum(-total / np.maximum(n, 1), 300))],
                names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score",
                       "score", "perplexity"])

    return coded.select("doc_id", "train", "n_tokens", "n_known", "mass", "classes").mapInArrow(
        run, "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double, perplexity double")
