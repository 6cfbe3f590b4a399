"""Trained operators: held-out accuracy, sums of probabilities, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retaloom.llm import brown, langid, quality, queries
from retaloom.llm.common import HashCache, crc_mod


def test_language_on_held_out_documents(spark, folder):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.QUERIES["op3_byte_cnn_language"](spark, folder).collect()
    held = [r for r in found if r.held_out and truth[r.doc_id]]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(truth)


def test_language_of_odd_rows(odd, none, small):
    network = langid.train(small)
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, network).collect()}
    assert all(found[i] == ("und", 0.0) for i in (3, 4, 5, 9))
    assert found[1][0] == found[2][0] and set(network.languages) >= {found[6][0]}
    assert langid.predict(none, network).count() == 0
    assert langid.train(none) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_pair_tables_equal_the_plain_network():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (20, langid.WINDOW), dtype=np.uint8)
    net = langid.fit(x, rng.integers(0, 3, 20), ["a", "b", "c"], 2, 1)
    plain = np.maximum(net.pooled(x)[0], 0) @ net.out + net.out_bias
    assert np.allclose(net.fast()(x), plain, atol=1e-3)


def test_windows_hold_the_whole_text():
    data = bytes(range(256)) * 5 + b"tail"
    rows = langid.windows(data)
    assert rows.tobytes().rstrip(b" ") == data.lower() and rows.shape == (6, 256)
    assert langid.windows(b"").shape == (0, 256)


def test_quality_on_held_out_documents(spark, folder):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = queries.QUERIES["op7_ftrl_quality"](spark, folder).collect()
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (1, 1), (6, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    weights = quality.train(odd, labels)
    found = {r.doc_id: r.score for r in quality.score(odd, weights).collect()}
    assert found[1] > 0.5 > found[6] and found[3] == found[4]
    for no_labels in (labels.where("false"), labels.where("quality = 1")):
        assert {r.score for r in quality.score(odd, quality.train(odd, no_labels)).collect()} == {0.5}
    assert quality.score(none, weights).count() == 0


def test_slots_depend_on_words_and_their_order():
    slots = lambda t: quality.ngram_slots(t, HashCache(), 18).tolist()
    assert slots(b"A b") == slots(b"a  B") and slots(b"a b") != slots(b"b a")
    assert slots(b"") == [] and len(slots(b"a b c")) == 5


def test_base_scores_match_plain_counts_and_the_model_is_better(spark, folder):
    words = {r.doc_id: (r.text or "").encode().lower().split() + [b""]
             for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    total, types = sum(counts.values()), len(counts)
    mass = total + 0.5 * (types + 1)
    found = queries.QUERIES["op1_brown_classes"](spark, folder).collect()
    assert len(found) == len(words)
    for r in found:
        ws = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / mass) for w in ws), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
    assert sum(r.score - r.base_score for r in found) > 0


def test_classes_part_two_vocabularies(spark):
    rows, rng = [], np.random.default_rng(4)
    for i in range(600):
        side = "ab"[i % 2]
        rows.append((i, " ".join(f"{side}{k}" for k in rng.zipf(1.5, 80) % 60)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = brown.score(docs, crc_mod("doc_id", 5) != 1).collect()
    held = [r for r in found if not r.train]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.15  # knowing the vocabulary is worth log10(2) at most


@pytest.mark.parametrize("train", [True, False])
def test_brown_on_odd_rows(odd, none, train):
    train = F.lit(train)
    found = {r.doc_id: r for r in brown.score(odd, train).collect()}
    assert all(math.isfinite(r.score) and math.isfinite(r.perplexity) for r in found.values())
    assert found[3].n_tokens == found[4].n_tokens == found[5].n_tokens == 1
    assert found[3].score == found[4].score and found[6].score == found[7].score
    assert brown.score(none, train).count() == 0


def test_mixture_is_a_distribution():
    class Told:
        unit_tokens, unit_types = np.zeros(brown.UNITS), np.zeros(brown.UNITS)

    Told.unit_tokens[:40] = np.arange(40) + 1
    Told.unit_types[:40] = 1
    Told.mass = Told.unit_tokens.sum() + 0.5 * 41
    classes = brown.first_classes()
    grid = np.random.default_rng(1).integers(0, 9, (brown.CLASSES, brown.CLASSES)).astype(float)
    model = brown.Model(classes, grid, Told)
    # One unknown event of the unigram is split over the classes: it counts once there.
    emission = (Told.unit_tokens[:40] + 0.5) / Told.mass
    for before in range(brown.CLASSES):
        known = (emission * 10 ** model.ratio[before, classes[:40]]).sum()
        assert 0.8 < known < 1


def test_rare_words_have_classes_of_their_own(spark, monkeypatch):
    # Eight cells for 1,200 words of two vocabularies: by cell no rare word tells its side.
    for name, value in (("FREQUENT", 64), ("CELLS", 8), ("UNITS", 73)):
        monkeypatch.setattr(brown, name, value)
    rows, rng = [], np.random.default_rng(4)
    for i in range(800):
        side = "ab"[i % 2]
        rows.append((i, " ".join(f"{side}{k % 8}" if k % 2 else f"{side}rare{rng.integers(600)}" for k in range(80))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = [r for r in brown.score(docs, crc_mod("doc_id", 5) != 1).collect() if not r.train]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.45
