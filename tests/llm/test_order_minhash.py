import hashlib
import random

import pytest
from pyspark.sql import functions as F

from latemark.llm import order_minhash as omh


def brute_numbered(text):
    words = (text or "").split()
    if not words:
        return []
    seen, out = {}, []
    for i in range(max(len(words) - omh.K, 0) + 1):
        gram = tuple(words[i:i + omh.K])
        out.append((gram, seen.get(gram, 0), i))
        seen[gram] = seen.get(gram, 0) + 1
    return out


def test_occurrence_numbers(spark, documents):
    texts = ["a b c a b c a b c", "a b", "", "x", "p q r s", "w w w w w w", " a\tb \n c  d "]
    rows = documents(list(enumerate(texts))).select("doc_id", F.expr(omh.numbered_kmers("text")).alias("k")).collect()
    for r in rows:
        want = brute_numbered(texts[r["doc_id"]])
        found = sorted((k["p"], k["g"]) for k in r["k"])
        assert [p for p, _ in found] == [p for _, _, p in want]
        names = {}
        for (_, g), (gram, number, _) in zip(found, want):
            assert names.setdefault((gram, number), g) == g
        assert len(set(names.values())) == len(names)


def test_sketches_against_brute_force(spark, documents, prose):
    """The drawn pairs, from the hashes of Spark itself but by plain loops."""
    texts = [prose(1, 40), "a b c a b c a b c d", prose(1, 40) + " end"]
    rows = documents(list(enumerate(texts)))
    grams = rows.select("doc_id", F.explode(F.expr(omh.numbered_kmers("text"))).alias("k")).select("doc_id", "k.g", "k.p")
    hashed = grams.select("doc_id", "g", "p", *[F.expr(f"xxhash64(g, {i})").alias(f"h{i}") for i in range(omh.SKETCHES)]).collect()
    prints = {r["doc_id"]: bytes(r["fingerprint"]) for r in omh.fingerprints(rows.select("doc_id", "text"), "doc_id").collect()}
    drawn = {}
    for doc in prints:
        for i in range(omh.SKETCHES):
            pair = []
            for half in (True, False):
                own = [((r[f"h{i}"] & ((1 << 62) - 1)) >> omh.PLACE_BITS, r["p"]) for r in hashed if r["doc_id"] == doc and (r[f"h{i}"] >= 0) == half]
                pair.append(min(own, default=(None, None)))
            first, second = sorted(pair, key=lambda x: (x[1] is None, x[1]))
            drawn[doc, i] = (first[0], second[0], first == pair[0])
    for a in prints:
        for b in prints:
            for i in range(omh.SKETCHES):
                assert (prints[a][4 * i:4 * i + 4] == prints[b][4 * i:4 * i + 4]) == (drawn[a, i] == drawn[b, i])


def _likeness(rows, a, b):
    one, other = rows[a], rows[b]
    return sum(one[i:i + 4] == other[i:i + 4] for i in range(0, len(one), 4)) / omh.SKETCHES


def test_likeness_follows_edits_and_order(documents, prose):
    words = prose(5, 600).split()
    draw = random.Random(6)
    few, many = list(words), list(words)
    for at in draw.sample(range(600), 6):
        few[at] = "new"
    for at in draw.sample(range(600), 120):
        many[at] = "new"
    blocks = [words[i:i + 30] for i in range(0, 600, 30)]
    draw.shuffle(blocks)
    texts = [words, few, many, sum(blocks, []), prose(8, 600).split()]
    rows = {r["doc_id"]: bytes(r["fingerprint"]) for r in omh.fingerprints(
        documents([(i, " ".join(t)) for i, t in enumerate(texts)]).select("doc_id", "text"), "doc_id").collect()}
    assert _likeness(rows, 0, 0) == 1
    assert _likeness(rows, 0, 1) > 0.7 > _likeness(rows, 0, 2) > _likeness(rows, 0, 4) == 0
    assert _likeness(rows, 0, 3) < _likeness(rows, 0, 1)  # nearly the same k-mers, but moved


def brute_edited(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[i] = (len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest())
    return out


def test_edited_texts(documents, awkward):
    rows = [a for a in awkward if a[0] not in (6, 7)]
    rows = rows[:3] + [r for r in rows[3:] if r[0] is not None]
    docs = documents([(*a, "x") for a in rows], "fingerprint string")
    found = omh.edit_fingerprints(docs).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in found} == brute_edited(rows)


def test_repeats_nulls_and_empty(documents, awkward):
    found = omh.edit_fingerprints(documents(awkward)).collect()
    assert len(found) == len(awkward)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert omh.edit_fingerprints(documents([])).count() == 0
    single = omh.edit_fingerprints(documents([(1, "a b c d e f")])).first()
    assert single["edited_sha256"] == hashlib.sha256(b"a b c a b c").hexdigest() and single["near_next"] == 1
    alike = omh.edit_fingerprints(documents([(1, "a b c d e f")] * 5 + [(2, "q r s t u v w")])).collect()
    assert sorted(r["near_next"] for r in alike) == [0, 0, 1, 1, 1, 1]
    assert len({r["fingerprint"] for r in alike if r["doc_id"] == 1}) == 1
