"""Language identification by a convolutional network over bytes, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retaloom.llm.common import appended, fraction, texts

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def windows(text: bytes) -> np.ndarray:
    """The whole text, A-Z lowered, in rows of WINDOW bytes; the last one is filled up with spaces."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    count = -(-len(data) // WINDOW)
    out = np.full(count * WINDOW, 0x20, np.uint8)
    out[:len(data)] = data
    return out.reshape(count, WINDOW)


@dataclass
class Network:
    """One-hot bytes, filters of several widths, ReLU, maximum over the window, softmax.

    A filter of width k on one-hot bytes is a sum of k table rows, so ``tables`` holds for
    each width an array (k, 256, FILTERS).
    """

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of each filter over each window, and where it is."""
        best, where = [], []
        for table in self.tables:
            width = len(table)
            span = x.shape[1] - width + 1
            sums = sum(table[j][x[:, j:j + span]] for j in range(width))
            best.append(sums.max(axis=1))
            where.append(sums.argmax(axis=1))
        return np.concatenate(best, axis=1) + self.bias, np.concatenate(where, axis=1)

    def fast(self):
        """A function x -> class scores that reads two bytes per table lookup."""
        a, b, c = (t.astype(np.float32) for t in self.tables)
        pair = lambda p, q: (p[:, None, :] + q[None, :, :]).reshape(65536, -1)
        two = pair(a[0], a[1])
        three, third = pair(b[0], b[1]), b[2]
        four, tail = pair(c[0], c[1]), pair(c[2], c[3])
        bias, out, out_bias = self.bias, self.out, self.out_bias

        def scores(x: np.ndarray) -> np.ndarray:
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            sums = three.take(pairs[:, :-1], axis=0)
            sums += third.take(x[:, 2:], axis=0)
            more = four.take(pairs[:, :-2], axis=0)
            more += tail.take(pairs[:, 2:], axis=0)
            best = [two.take(pairs, axis=0).max(axis=1), sums.max(axis=1), more.max(axis=1)]
            return np.maximum(np.concatenate(best, axis=1) + bias, 0) @ out + out_bias

        return scores


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int, seed: int) -> Network:
    """Back-propagation with Adagrad on windows ``x`` and language numbers ``y``."""
    rng = np.random.default_rng(seed)
    n = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.5 / k, (k, 256, FILTERS)) for k in WIDTHS],
        np.zeros(n), rng.normal(0, 0.3, (n, len(languages))), np.zeros(len(languages)))
    params = [*net.tables, net.bias, net.out, net.out_bias]
    seen = [np.full(p.shape, 1e-8) for p in params]
    filters = np.arange(FILTERS)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            xs, rows = x[part], np.arange(len(part))
            raw, where = net.pooled(xs)
            hidden = np.maximum(raw, 0)
            delta = _softmax(hidden @ net.out + net.out_bias)
            delta[rows, y[part]] -= 1
            delta /= len(part)
            back = (delta @ net.out.T) * (raw > 0)
            grads = []
            for k, width in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                grad, at = np.zeros_like(net.tables[k]), where[:, own]
                for j in range(width):
                    np.add.at(grad[j], (xs[rows[:, None], at + j], filters), back[:, own])
                grads.append(grad)
            grads += [back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
            for p, g, s in zip(params, grads, seen):
                s += g * g
                p -= 0.08 * g / np.sqrt(s)
    return net


def train(
    docs: DataFrame, where: Column | None = None, per_language: int = 1200,
    per_document: int = 4, max_languages: int = 200, max_documents: int = 40_000,
    epochs: int = 6, seed: int = 11,
) -> Network | None:
    """Fit on a bounded sample of the documents that satisfy ``where`` and have a lang.

    Of each language about ``per_language`` documents are taken by the hash of their
    id, and of each document ``per_document`` windows by chance; ``max_documents`` bounds them
    over all languages, ``max_languages`` the languages, commonest first. So at most
    max_documents * per_document windows of 256 bytes reach the driver. None if no
    document has a language and a text.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(where) if where is not None else known
    counts = (known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(max_languages).collect())
    if not counts:
        return None
    each = min(per_language, max_documents // len(counts))
    shares = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, min(1.0, each / r.n))])
    chosen = known.where(fraction("doc_id", seed) < F.coalesce(shares[F.col("lang")], F.lit(0.0)))

    def cut(batches):
        for batch in batches:
            ids, langs, found = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for doc_id, lang, text in zip(ids, langs, texts(batch)):
                rows = windows(text)
                rng = np.random.default_rng(abs(hash((doc_id or 0, len(text)))))
                for k in sorted(rng.permutation(len(rows))[:per_document]):
                    found.append((doc_id, lang, int(k), rows[k].tobytes()))
            columns = list(zip(*found)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["id", "lang", "k", "window"])

    sample = chosen.select(F.col("doc_id").cast("bigint"), "lang", "text").mapInArrow(
        cut, "id bigint, lang string, k bigint, window binary")
    rows = sorted(sample.limit(2 * max_documents * per_document).collect(),
                  key=lambda r: (r.id is None, r.id or 0, r.k, bytes(r.window)))
    if not rows:
        return None
    languages = sorted({r.lang for r in rows})
    place = {name: k for k, name in enumerate(languages)}
    x = np.frombuffer(b"".join(bytes(r.window) for r in rows), np.uint8).reshape(-1, WINDOW)
    return fit(x, np.array([place[r.lang] for r in rows]), languages, epochs, seed)


def predict(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the probability of that language.

    Every window of the whole text is scored, many texts' windows at a time; a document's
    probabilities are the mean of its windows', weighted by their bytes.

    Cases: a text that is NULL, empty or without any letter is ``und`` with score 0, as
    is every text if there is no network. Columns of docs with the new names are replaced.
    """
    def setup():
        scores = network.fast() if network else None

        def work(batch: list[bytes]) -> dict[str, pa.Array]:
            lettered = [i for i, t in enumerate(batch)
                        if network and any(map(str.isalpha, t.decode()))]
            names, found = ["und"] * len(batch), np.zeros(len(batch))
            at = 0
            while at < len(lettered):
                # About four megabytes of windows at a time; a longer text goes alone.
                group, size = [], 0
                while at < len(lettered) and (not group or size + len(batch[lettered[at]]) < 4 << 20):
                    group.append(lettered[at])
                    size += len(batch[lettered[at]])
                    at += 1
                cut = [windows(batch[i]) for i in group]
                x = np.concatenate(cut)
                p = np.concatenate([_softmax(scores(x[k:k + 512])) for k in range(0, len(x), 512)])
                weight = np.full(len(x), float(WINDOW))
                ends = np.cumsum([len(c) for c in cut])
                weight[ends - 1] = [(len(batch[i]) - 1) % WINDOW + 1 for i in group]
                starts = ends - [len(c) for c in cut]
                total = np.add.reduceat(p * weight[:, None], starts, axis=0)
                total /= np.add.reduceat(weight, starts)[:, None]
                best = total.argmax(axis=1)
                for i, b, q in zip(group, best, total.max(axis=1)):
                    names[i], found[i] = network.languages[b], min(1.0, float(q))
            return {"lang_pred": pa.array(names, pa.string()), "score": pa.array(found)}

        return work

    return appended(docs, text_col, None, "lang_pred string, score double", setup)
