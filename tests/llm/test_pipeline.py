"""Every stage against a plain version, on its own input."""

import re

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from test_jaccard import brute
from test_text import plain_hits
from tokenizers import Tokenizer

from retaloom.llm.common import alnum_words, stored


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        made = stored(stage(spark, docs, folder), name)
        seen.append((docs, made))
        docs = made
    return seen


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(spark, folder, stages):
    columns = spark.read.parquet(f"{folder}/documents.parquet").dtypes
    assert all(made.dtypes == columns for _, made in stages[:-1])
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_duplicates", "decontamination", "packing"]


def test_language_stage_keeps_clean_documents(stages):
    before, after = map(rows, stages[0])
    assert len(after) > 0.98 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_exact_stage(stages):
    before, after = map(rows, stages[1])
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i].text), i)
    assert after == {i: before[i] for i in first.values()}


def test_near_stage(stages):
    before, after = map(rows, stages[2])
    linked = brute([(i, r.text) for i, r in before.items()], 5, 80, 100)
    assert after == {i: r for i, r in before.items() if linked[i][1] == i}


def test_decontamination_stage(spark, folder, stages):
    before, after = map(rows, stages[3])
    items = [(r.item_id, alnum_words((r.text or "").encode()))
             for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    index = {tuple(w[j:j + 10]) for _, w in items for j in range(len(w) - 9)}
    short = [(k, w) for k, w in items if 0 < len(w) < 10]
    for i, r in before.items():
        words = alnum_words(r.text.encode())
        dirty = any(tuple(words[j:j + 10]) in index for j in range(len(words) - 9)) \
            or bool(plain_hits(words, short, 10)[0])
        assert (i in after) == (not dirty)


def test_packing_stage(stages):
    docs, packed = stages[4]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    total = {i: len(encode(r.text, add_special_tokens=False).ids) + 1 for i, r in rows(docs).items()}
    found: dict = {}
    for r in packed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == total


def test_stages_take_odd_and_no_rows(spark, folder, odd, none):
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
        made = stage(spark, odd, folder)
        assert made.count() > 0
        if name != "packing":
            assert made.columns == odd.columns
