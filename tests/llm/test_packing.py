import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from latemark.llm import packing, word_codes

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_combinations():
    found = packing.combinations(12, 3)
    want = {c for d in (1, 2, 3) for c in itertools.combinations_with_replacement(range(12, 0, -1), d) if sum(c) == 12}
    assert set(found) == want and len(found) == len(want)


def test_least_squares_conditions():
    draw = np.random.default_rng(1)
    for _ in range(20):
        matrix, wanted = draw.integers(0, 3, (8, 25)).astype(float), draw.uniform(0, 9, 8)
        x = packing.least_squares(matrix, wanted)
        slope = matrix.T @ (matrix @ x - wanted)
        assert (x >= 0).all() and (slope > -1e-5).all() and np.abs(slope[x > 1e-7]).max() < 1e-5


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_count_once(seed):
    draw = random.Random(seed)
    histogram = {draw.randint(1, 64): draw.randint(1, 3000) for _ in range(draw.randint(1, 60))}
    used = defaultdict(int)
    for shape, times in packing.plan(histogram, 64):
        assert sum(shape) <= 64 and times > 0
        for step in shape:
            used[step] += times
    assert used == histogram


def test_plan_fills_windows():
    histogram = {step: 500 for step in range(1, 65)}
    windows = sum(times for _, times in packing.plan(histogram, 64))
    assert windows <= 1.02 * sum(s * n for s, n in histogram.items()) / 64


def test_word_codes_are_those_of_the_library(prose):
    ranks, pairs = word_codes.ranks_of(PATH)
    assert len(pairs) > 48_000 and word_codes.agrees(ranks, pairs)
    # a token that neighbours other than its listed pair make first
    assert not word_codes.agrees({b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"ab": 4, b"abc": 5}, [(b"b", b"c"), (b"a", b"b"), (b"ab", b"c")])
    words = prose(11, 3000).split() + [
        "it's", "I'LL<|endoftext|>", "x\x01y", "\x02", "漢字", "a\xa0b", "ﬁ", "²³", "don't!!", "É'S", "''s", "a1b2", "ÿþ", "\xad-", "İI", "e\u0301",
    ]
    encoder = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.encode_batch(words, add_special_tokens=False)]
    for fast in (True, False):
        assert word_codes.WordCoder(PATH, fast).codes([w.encode() for w in words]) == want


def test_round_trip(documents, awkward):
    rows = [(i, text) for i, (_, text) in enumerate(awkward)] + [(50, "<|endoftext|> It's A\u00a0B c\u0301a\u2028x I'LL 漢字 don't"), (51, "x" * 20_000)]
    encoder = Tokenizer.from_file(PATH)
    want = {i: [*encoder.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    found = packing.packed(documents(rows), PATH, ids=True).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and r["doc_tokens"] == len(want[r["doc_id"]])
        docs[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: sum((ids for _, ids in sorted(p)), []) for i, p in docs.items()} == want
    for parts in docs.values():
        assert [s for s, _ in sorted(parts)] == [sum(len(x) for _, x in sorted(parts)[:k]) for k in range(len(parts))]
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_repeated_null_and_empty(documents, awkward):
    found = packing.packed(documents([(*a, 1) for a in awkward], "length int"), PATH).collect()
    assert sum(r["length"] for r in found) == sum(r["doc_tokens"] for r in found if r["start"] == 0)
    assert sum(r["start"] == 0 for r in found) == len(awkward)
    assert packing.packed(documents([]), PATH).count() == 0
