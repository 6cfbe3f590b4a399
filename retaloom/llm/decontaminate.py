"""Benchmark decontamination with a generalised suffix automaton of the items' words."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from retaloom.llm.common import alnum_words, appended, slices

_WORD = regex.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lowering


class SuffixAutomaton:
    """All substrings (in words) of a set of items, with the items each window is in.

    A window is ``n`` consecutive words of an item; an item with fewer words is one
    window. ``scan`` walks a text's words once, keeping the state of the longest suffix
    read so far that occurs in some item, and that suffix's length.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], n: int):
        self.n, self.vocabulary = n, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [
            (k, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for k, words in items if words]
        for _, words in numbered:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.members: list[set[int]] = [set() for _ in self.next]
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.next]
        self.shortest = n
        for k, words in numbered:
            self._mark(k, words)
        # A state knows whether it or a shorter suffix is a whole short item.
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.short = [False] * len(self.next)
        for v in order:
            self.short[v] = bool(self.whole[v]) or (v > 0 and self.short[self.link[v]])

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q for the strings that reach it over p alone, of length(p) + 1."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        known = self.next[last].get(w)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, w, known)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def _mark(self, k: int, words: list[int]) -> None:
        """Note item k at the states of its windows."""
        v = 0
        for i, w in enumerate(words):
            v = self.next[v][w]
            if i + 1 >= self.n:
                v = self._window(v)
                self.members[v].add(k)
        if len(words) < self.n:
            self.whole[v].append((len(words), k))
            self.shortest = min(self.shortest, len(words))

    def _window(self, v: int) -> int:
        """The state of the last n words, v being a state of at least n."""
        while self.length[self.link[v]] >= self.n:
            v = self.link[v]
        return v

    def scan(self, words: list[bytes], hit: np.ndarray, found: set[int]) -> None:
        """Set ``hit`` at the words inside any window; add the windows' items to ``found``."""
        if len(words) < self.shortest:
            return
        ids = np.fromiter(
            map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        # A word that no item has ends every match: only runs between such words,
        # long enough for a window, are walked.
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).view(np.int8), [0]])))
        for start, end in edges.reshape(-1, 2):
            if end - start >= self.shortest:
                self._walk(ids[start:end].tolist(), int(start), hit, found)

    def _walk(self, ids: list[int], start: int, hit: np.ndarray, found: set[int]) -> None:
        follow, link, length, n = self.next, self.link, self.length, self.n
        v = matched = 0
        for i, w in enumerate(ids, start + 1):
            to = follow[v].get(w)
            while to is None and v:
                v = link[v]
                matched = length[v]
                to = follow[v].get(w)
            if to is None:
                continue
            v, matched = to, matched + 1
            if matched >= n:
                v = self._window(v)
                matched = n
                hit[i - n:i] = True
                found |= self.members[v]
            if self.short[v]:
                u = v
                while u:
                    for size, k in self.whole[u]:
                        if size <= matched:
                            hit[i - size:i] = True
                            found.add(k)
                    u = link[u]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[list]:
    """The items in blocks of about ``block_bytes``, so that one automaton stays small."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    blocks, size = [[]], 0
    for row in rows.toLocalIterator():
        text = (row.t or "").encode()
        if size and size + len(text) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((row.id or "", alnum_words(text)))
        size += len(text)
    return blocks


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = 8 << 20,
    clean: bool = False, max_coverage: float = 0.0,
) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items (their ids, sorted) and, with
    ``clean``, clean_text.

    The benchmark is a stated set of queries: it is broadcast in blocks of
    ``block_bytes``, one automaton is held at a time, and every block sees every text.
    Texts are streamed once through each automaton; their state is one node and one
    length. With ``clean``, each maximal run of hit words is cut out; where more than
    ``max_coverage`` of a document's words are hit, clean_text is NULL: the document is
    to be dropped.

    Cases: NULL and empty texts have no words and no hits; items without words match
    nothing; an item whose id is NULL is named by the empty text; items with one id count
    once; an empty benchmark hits nothing. Result columns replace columns of docs that
    have their names.
    """
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(b)
              for b in _blocks(benchmark, item_id, item_text, block_bytes)]
    fields = ["n_words bigint", "n_hit bigint", "n_items bigint", "items array<string>"]

    def setup():
        one = [None]  # the automaton of the only block

        def automaton(block):
            named = sorted({name for name, _ in block.value})
            place = {name: k for k, name in enumerate(named)}
            made = SuffixAutomaton([(place[name], words) for name, words in block.value], n)
            return made, named

        def work(batch: list[bytes]) -> dict[str, pa.Array]:
            hits: list[np.ndarray] = []
            names: list[set[str]] = [set() for _ in batch]
            for block in shared:
                made, named = one[0] or automaton(block)
                if len(shared) == 1:
                    one[0] = (made, named)
                # Words take many times the bytes of their text: those of some texts at a time.
                for start, end in slices(batch):
                    words = [alnum_words(t) for t in batch[start:end]]
                    if len(hits) < end:
                        hits += [np.zeros(len(w), dtype=bool) for w in words]
                    for w, hit, name in zip(words, hits[start:end], names[start:end]):
                        found: set[int] = set()
                        made.scan(w, hit, found)
                        name.update(named[k] for k in found)
            out = {
                "n_words": pa.array([len(h) for h in hits], pa.int64()),
                "n_hit": pa.array([int(h.sum()) for h in hits], pa.int64()),
                "n_items": pa.array([len(s) for s in names], pa.int64()),
                "items": pa.array([sorted(s) for s in names], pa.list_(pa.string())),
            }
            if clean:
                out["clean_text"] = pa.array([
                    cut_spans(t, h, max_coverage) for t, h in zip(batch, hits)], pa.string())
            return out

        return work

    if clean:
        fields.append("clean_text string")
    return appended(docs, text_col, None, ", ".join(fields), setup)


def cut_spans(text: bytes, hit: np.ndarray, max_coverage: float) -> str | None:
    """The text without its runs of hit words; None if too many of its words are hit."""
    if not hit.any():
        return text.decode()
    if hit.mean() > max_coverage:
        return None
    spans = [m.span() for m in _WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    kept, at = [], 0
    for first, end in edges.reshape(-1, 2):
        kept.append(text[at:spans[first][0]])
        at = spans[end - 1][1]
    return (b"".join(kept) + text[at:]).decode()
