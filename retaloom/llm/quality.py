"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from retaloom.llm.common import HashCache, appended, fraction, hash_words, space_words, texts

_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: the golden ratio in 64 bits
SCALE = 16.0  # a text's n-gram shares are multiplied by this


def ngram_slots(text: bytes, cache: HashCache, bits: int) -> np.ndarray:
    """Hash slots of the text's words and word pairs, one per occurrence."""
    words = hash_words(space_words(text), cache)
    pairs = (words[:-1] * _MIX) ^ (words[1:] + (words[:-1] >> np.uint64(31)))
    both = np.concatenate([words, pairs]) * _MIX
    return (both >> np.uint64(64 - bits)).astype(np.int64)


class FollowTheLeader:
    """Per-coordinate FTRL-proximal for logistic loss; slot 0 of ``extra`` is the bias."""

    def __init__(self, bits: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, slots: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(slots)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
        g = weight * (p - label) * values
        grown = self.n[slots] + g * g
        self.z[slots] += g - (np.sqrt(grown) - np.sqrt(self.n[slots])) / self.alpha * w
        self.n[slots] = grown


def _vector(text: bytes, cache: HashCache, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and values, the bias last; the sparse form of a training text."""
    slots, counts = np.unique(ngram_slots(text, cache, bits), return_counts=True)
    values = counts * (SCALE / max(1, counts.sum()))
    return np.append(slots, 1 << bits), np.append(values, 1.0)


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", where: Column | None = None,
    bits: int = 18, most: int = 16_000, alpha: float = 0.5, beta: float = 0.1,
    l1: float = 0.0, l2: float = 1e-3, seed: int = 7,
) -> np.ndarray:
    """Weights by slot, the bias last, learned from at most ``most`` labelled documents.

    The sample is those labelled ids (of rows that satisfy ``where``) whose hash is
    smallest; it is bounded by the parameter, so it may be broadcast, and the documents
    are not shuffled. Their texts reach one task, in hash order, as a stream of sparse vectors.
    A document labelled more than once takes the mean label, from 0.5 on 1. Classes
    are weighted to equal shares. Without labels of both kinds all weights are 0.
    """
    rows = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(where) if where is not None else rows
    chosen = (
        rows.groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
        .withColumn("place", fraction("doc_id", seed)).orderBy("place", "doc_id").limit(most))
    texts_of = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ordered = texts_of.select("place", "doc_id", "label", "text").repartition(1) \
        .sortWithinPartitions("place", "doc_id", "text")
    share = {r.label: r.n for r in chosen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(share.values())
    weight = {k: total / (2.0 * n) for k, n in share.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = FollowTheLeader(bits, alpha, beta, l1, l2), HashCache()
        for batch in batches:
            for text, label in zip(texts(batch), batch.column(2).to_pylist()):
                if len(weight) == 2:
                    model.learn(*_vector(text, cache, bits), label, weight[label])
        learned = model.weights().astype("<f4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([learned], pa.binary())], names=["w"])

    made = ordered.mapInArrow(run, "w binary").collect()
    return np.frombuffer(made[0].w, "<f4") if made else np.zeros((1 << bits) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``score``, the probability of label 1, from the whole text.

    Cases: NULL and empty texts have no n-grams and get the bias's score. A column of docs
    called score is replaced.
    """
    bits = (len(weights) - 1).bit_length() - 1

    def setup():
        cache, w, bias = HashCache(), weights, float(weights[-1])

        def one(text: bytes) -> float:
            slots = ngram_slots(text, cache, bits)
            total = bias + (SCALE * float(w[slots].mean(dtype=np.float64)) if len(slots) else 0.0)
            return float(1 / (1 + np.exp(-max(-30.0, min(30.0, total)))))

        return lambda batch: {"score": pa.array([one(t) for t in batch], pa.float64())}

    return appended(docs, text_col, None, "score double", setup)
