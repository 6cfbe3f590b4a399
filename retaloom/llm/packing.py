"""Best-fit-decreasing packing of tokenised documents into sequences."""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retaloom.llm.common import small_table, stored, texts
from retaloom.operators.numbering import number_rows

# ASCII that is neither letter, digit nor white space: where a chunk ends in these, the
# part before them and the part of them are tokenised apart from each other.
_PUNCTUATION = bytes(
    b for b in range(0x21, 0x7F) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
# Byte-level alphabet: printable bytes stand for themselves, the rest, in order, for the
# characters from 0x100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LETTERS = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_SPECIAL = b"<|"  # a text with this may hold a special token's string


GROUP = 2 << 20  # bytes of text taken at a time; their words and numbers take some forty times that


class _Numbers(dict):
    """Numbers for keys in the order they are first asked for; ``new`` lists the latest."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class ChunkTokens:
    """Token ids of texts, computed once per distinct part of the chunks between white space.

    The tokenizer lowers case, drops white space and never joins tokens over it, so a
    text's ids are those of its chunks in a row; a chunk is a core and the ASCII marks
    at its end. Known chunks come back from a cache, and so do known parts. A text that may hold the
    string of a special token goes through the tokenizer whole. Texts are taken some megabytes at a
    time: their chunks are numbered in one pass, and all their ids gathered at once.
    """

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self._reset()

    def _reset(self) -> None:
        self.chunks = _Numbers()
        self.core_tail = np.empty((0, 2), np.int64)  # part numbers by chunk number
        self.parts: dict[bytes, int] = {b"": 0}
        self.starts, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn_parts(self, new: list[bytes]) -> None:
        """Words of letters that normalising would leave as they are go to the model alone,
        spelled in its alphabet for bytes; other parts through the whole tokenizer."""
        model, found = self.tokenizer.model.tokenize, []
        for part in new:
            text = part.decode()
            if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
                spelled = text if text.isascii() else part.decode("latin-1").translate(_BYTE_LETTERS)
                found.append([t.id for t in model(spelled)])
            else:
                found.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
        added = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.parts)
        self.parts.update(zip(new, range(first, first + len(new))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(added) - added])
        self.lengths = np.concatenate([self.lengths, added])
        self.flat = np.concatenate([self.flat, np.array(list(chain.from_iterable(found)), np.uint32)])

    @staticmethod
    def _core(chunk: bytes) -> bytes:
        """The chunk without the ASCII marks at its end, if what is left ends in a letter or
        digit: only there the tokenizer always parts them."""
        core = chunk.rstrip(_PUNCTUATION)
        if len(core) == len(chunk) or not core or core[-1:].isalnum():
            return core
        return core if core[-1] >= 0x80 and core.decode()[-1].lower()[-1].isalpha() else chunk

    def _learn(self) -> None:
        """Looks up the chunks that were numbered since the last time."""
        new, self.chunks.new = self.chunks.new, []
        cores = list(map(self._core, new))
        tails = [c[len(core):] for c, core in zip(new, cores)]
        missing = set(cores).union(tails).difference(self.parts)
        if missing:
            self._learn_parts(list(missing))
        part = self.parts.__getitem__
        pairs = np.array([list(map(part, cores)), list(map(part, tails))], np.int64).T
        self.core_tail = np.concatenate([self.core_tail, pairs])

    def groups(self, batch: list[bytes], end_id: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts after another: their ids in a row, each with the end id behind it, and
        how many each text has."""
        at = 0
        while at < len(batch):
            size, end = 0, at
            while end < len(batch) and (end == at or size + len(batch[end]) < GROUP):
                size += len(batch[end])
                end += 1
            yield self._group(batch[at:end], end_id)
            at = end

    def _group(self, batch: list[bytes], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        if len(self.chunks) > self.most:
            self._reset()
        cut = [[] if _SPECIAL in t else t.lower().split() for t in batch]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        chunks = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        if self.chunks.new:
            self._learn()
        # Chunk by chunk: where the ids of its two parts begin, and how many there are.
        parts = self.core_tail[chunks].ravel()
        starts, lengths = self.starts[parts], self.lengths[parts]
        so_far = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.arange(so_far[-1]) + np.repeat(starts - so_far[:-1], lengths)]
        bounds = so_far[2 * np.concatenate([[0], np.cumsum(counts)])]
        sizes = np.diff(bounds)
        special = [i for i, t in enumerate(batch) if _SPECIAL in t]
        if special:
            whole = {i: self._ids(batch[i].decode()) for i in special}
            ids = np.concatenate([whole.get(i, ids[a:b]) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))])
            sizes[special] = [len(whole[i]) for i in special]
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
        return ids.astype("<u4", copy=False), sizes

    def __call__(self, batch: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for ids, sizes in self.groups(batch, None):
            yield from np.split(ids, np.cumsum(sizes)[:-1])

    def rows(self, batch: list[bytes], capacity: int, end_id: int) -> Iterator[tuple[np.ndarray, ...]]:
        """text number, piece, start, length and checksum of every piece of the texts."""
        first = 0
        for ids, sizes in self.groups(batch, end_id):
            count = -(-sizes // capacity)
            text = np.repeat(np.arange(len(sizes)), count)
            piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, sizes[text] - start)
            place = 4 * ((np.cumsum(sizes) - sizes)[text] + start)
            held = memoryview(np.ascontiguousarray(ids)).cast("B")
            sums = [zlib.crc32(held[a:b]) for a, b in zip(place.tolist(), (place + 4 * length).tolist())]
            yield text + first, piece.astype(np.int32), start, length, np.array(sums, np.int64)
            first += len(sizes)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and an end id, cut
    only where it is longer than ``capacity``.

    NULL and empty texts give one piece with the end id alone. Further columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ChunkTokens(tokenizer)
        for batch in batches:
            for text, *made in encode.rows(texts(batch), capacity, end_id):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text)), *map(pa.array, made)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


class CapacityTree:
    """Segment tree over remaining capacities: how many open bins have each of them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, remaining: int, n: int) -> None:
        node = remaining + self.leaves
        while node:
            self.counts[node] += n
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity >= need of any open bin, in logarithmic time."""
        node = need + self.leaves
        if self.counts[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> dict[int, list[tuple]]:
    """Best-fit decreasing over a histogram of lengths.

    Pieces of one length are interchangeable, and so are open bins of one remaining
    capacity. Best fit puts equal pieces into the tightest bin until it takes no more,
    then into the next one; k such bins are filled in one step. The work depends on
    the number of lengths, not on the number of documents.

    Returns moves by length: (first rank, first bin, pieces per bin, offset), by rank:
    the piece of rank r goes to bin ``first bin + (r - first rank) // per``.
    """
    tree, open_bins = CapacityTree(capacity), defaultdict(list)  # remaining -> [(bin, n)]
    moves: dict[int, list[tuple]] = {}
    bins = 0
    for length in sorted(histogram, reverse=True):
        left, rank, out = histogram[length], 0, []
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                n = -(-left // (capacity // length))
                open_bins[room].append((bins, n))
                tree.add(room, n)
                bins += n
            per = room // length
            first, n = open_bins[room].pop()
            full = min(n, left // per)
            if full:
                used, each = full, per
            else:
                used, each = 1, left
            out.append((rank, first, each, capacity - room))
            rank, left = rank + used * each, left - used * each
            tree.add(room, -used)
            if used < n:
                open_bins[room].append((first + used, n - used))
            rest = room - each * length
            if rest:
                open_bins[rest].append((first, used))
                tree.add(rest, used)
        moves[length] = out
    return moves


def pack(rows: DataFrame, capacity: int = 4096) -> DataFrame:
    """``rows`` (with a column ``length`` of 1 to ``capacity``) plus sequence_id, offset.

    The driver gets the histogram of lengths, ``capacity`` counts at most, and makes the
    moves of a global best-fit-decreasing run from it; the rows are numbered within
    their length in Spark and look their move up. The moves, at most a few per pair
    of length and remaining capacity, are bounded by ``capacity`` too, so they
    are broadcast. No row passes through the driver.

    Cases: an empty table gives no sequences; repeated rows are packed one by one;
    which of equally long rows gets which place is decided by doc_id and piece, and
    between equal ones by chance. A column of ``rows`` called sequence_id or offset is replaced.
    """
    kept = [c for c in rows.columns if c.lower() not in ("sequence_id", "offset")]
    whole = stored(rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("whole")), "pieces")
    counts = {r.length: r.n for r in whole.groupBy(F.col("whole.length").alias("length"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    moves = best_fit_decreasing(counts, capacity)
    table, before = [], 0
    for length in sorted(counts, reverse=True):
        table.append({"length": length, "before": before, "moves": [
            {"rank": r, "bin": b, "per": p, "at": o} for r, b, p, o in moves[length]]})
        before += counts[length]
    plan = small_table(
        rows.sparkSession, json.dumps(table), "length:bigint,before:bigint,"
        "moves:array<struct<rank:bigint,bin:bigint,per:bigint,at:bigint>>")
    order = [-F.col("whole.length")] + [F.col(f"whole.{c}") for c in ("doc_id", "piece") if c in kept]
    numbered = number_rows(whole, order, "position").withColumn("length", F.col("whole.length"))
    ranked = numbered.join(F.broadcast(plan), "length").withColumn(
        "r", F.col("position") - 1 - F.col("before"))
    move = F.element_at(F.filter("moves", lambda m: m.rank <= F.col("r")), -1)
    found = ranked.select("whole", "length", "r", move.alias("m"))
    nth = F.col("r") - F.col("m.rank")
    return found.select(
        "whole.*",
        (F.col("m.bin") + F.floor(nth / F.col("m.per"))).cast("bigint").alias("sequence_id"),
        (F.col("m.at") + F.pmod(nth, F.col("m.per")) * F.col("length")).alias("offset"))
