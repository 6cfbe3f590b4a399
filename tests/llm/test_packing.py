import random
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from retaloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    """Number of bins of per-document best-fit decreasing."""
    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms.pop(k)
        else:
            room, bins = capacity, bins + 1
        if room > n:
            insort(rooms, room - n)
    return bins


def test_moves_are_a_best_fit_decreasing_run():
    rng = random.Random(5)
    for capacity in (10, 64, 100):
        for _ in range(20):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
            counts = defaultdict(int)
            for n in lengths:
                counts[n] += 1
            moves = packing.best_fit_decreasing(dict(counts), capacity)
            bins = defaultdict(list)
            for n, k in counts.items():
                for r in range(k):
                    first, b, per, at = [m for m in moves[n] if m[0] <= r][-1]
                    bins[b + (r - first) // per].append((at + (r - first) % per * n, n))
            for placed in bins.values():
                at = 0
                for offset, n in sorted(placed):
                    assert offset == at
                    at += n
                assert at <= capacity
            assert len(bins) == plain_best_fit(lengths, capacity)


def test_tree_finds_the_tightest():
    tree, rng, have = packing.CapacityTree(50), random.Random(2), defaultdict(int)
    for _ in range(500):
        room = rng.randint(0, 50)
        step = -1 if have[room] and rng.random() < 0.5 else 1
        tree.add(room, step)
        have[room] += step
        need = rng.randint(1, 50)
        assert tree.tightest(need) == min((r for r in have if r >= need and have[r]), default=None)


def test_ids_are_the_tokenizers(small):
    whole = Tokenizer.from_file(PATH)
    texts = [r.text or "" for r in small.limit(150).collect()] + [
        "don't stop 'S's!'", "a—%%% b", "é% x", "<|endoftext|> hi", "<|ENDOFTEXT|>", "x́! y",
        "12ab34!!", "", " \n", "KK s", "\xa0a b", "ß?ẞ! İ!", "日本語 привет 한글", "≠"]
    found = list(packing.ChunkTokens(PATH, most=500)([t.encode() for t in texts]))
    assert [f.tolist() for f in found] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_round_trip_and_fill_sequences(odd, none):
    rows = packing.pack(packing.pieces(odd, PATH, 4096, 1)).collect()
    encode = Tokenizer.from_file(PATH).encode
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts) and len(by_doc[3]) == len(by_doc[4]) == 1
    for doc_id, parts in by_doc.items():
        ids = np.array(encode(texts[doc_id], add_special_tokens=False).ids + [1], "<u4")
        copies = 2 if doc_id == 1 else 1
        assert sum(p.length for p in parts) == copies * len(ids)
        for p in parts:
            part = ids[p.start:p.start + p.length]
            assert zlib.crc32(part.tobytes()) == p.ids_crc32 and p.start == 4096 * p.piece
    for placed in by_bin.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(by_bin) == plain_best_fit([r.length for r in rows], 4096)
    assert packing.pack(packing.pieces(none, PATH)).count() == 0


def test_marks_after_control_characters_stay_with_them():
    texts = ["abc\x01!", "abc\x7f!? x", "a\x02", "abc!", "9?", "\x01!!", "é\x01."]
    plain = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, packing.ChunkTokens(PATH)([t.encode() for t in texts])):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts_are_the_tokenizers():
    """60,000 made-up texts of marks, control characters, odd Unicode and special strings."""
    rng = random.Random(9)
    bits = ["a", "B", "word", "Été", "ß", "é", "İ", "日本", "привет", "\x01", "\x7f", "​", "\xa0", " ", "  ", "\n",
            "\t", "!", "?!", "...", "--", "_", "'s", "12", "3.5", "<|", "|>", "<|endoftext|>", "<unk>", "€", "🙂", "́",
            "ﬁ", "Ⅷ", "\r\n", "%", "http://x.y/z"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(9))) for _ in range(60_000)]
    plain = Tokenizer.from_file(PATH)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    found = packing.ChunkTokens(PATH, most=20_000)([t.encode() for t in texts])
    assert [f.tolist() for f in found] == want


def test_groups_of_texts_give_the_pieces_of_each_alone():
    encode = packing.ChunkTokens(PATH)
    texts = [b"", b"one two", b"word " * 5000, b"<|endoftext|> x", b"", b"a! b? c", b"long " * 4096]
    together = [tuple(int(v) for v in row) for made in encode.rows(texts, 4096, 1) for row in zip(*made)]
    alone = [(i, *(int(v) for v in row[1:])) for i, t in enumerate(texts)
             for made in packing.ChunkTokens(PATH).rows([t], 4096, 1) for row in zip(*made)]
    assert together == alone
    assert [r[3] for r in together if r[0] in (0, 4)] == [1, 1]
