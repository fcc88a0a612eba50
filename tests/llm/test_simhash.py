import itertools
import random

import numpy as np
import pytest
import xxhash

from latemark.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 3:
            root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints(documents, awkward):
    rows = simhash.with_fingerprints(documents(awkward).select("doc_id", "text")).collect()
    for r in rows:
        assert r["fingerprint"] % 2**64 == brute_print(r["text"])


def test_every_linked_pair_meets_at_a_home():
    draw = random.Random(3)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 3)):
            b ^= 1 << bit
        keys, owners, lives = simhash.stations(np.array([a, b], np.uint64))
        of = [{(int(k), bool(l)) for k, o, l in zip(keys, owners, lives) if o == i} for i in (0, 1)]
        assert any((k, True) in of[0] and k in {x for x, _ in of[1]} for k, _ in of[0])
        assert len(of[0]) <= 2 * 18


@pytest.mark.parametrize("crowd", [1000, 3])
def test_links_and_components(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    draw = random.Random(crowd)
    prints = [draw.getrandbits(64) for _ in range(40)] + [0]
    for base in prints[:4]:
        now = base
        for _ in range(40):  # chains and dense groups
            now ^= 1 << draw.randrange(64)
            prints.append(now)
            prints.append(base ^ 1 << draw.randrange(64))
    prints += prints[:7]
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fingerprint long")
    from latemark.llm.frames import kept

    found = {r["fingerprint"]: r["component_id"] for r in simhash.print_components(kept(rows, "prints")).collect()}
    roots = brute_components(prints)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    assert [found[p] for p in signed] == [least[r] for r in roots]


def test_awkward_rows(documents, awkward):
    rows = simhash.near_duplicates(documents([(*a, "x") for a in awkward], "fingerprint string")).collect()
    assert len(rows) == len(awkward)
    assert {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 4)} == {2}
    kept = simhash.without_near_duplicates(documents([(*a, i, "y") for i, a in enumerate(awkward)], "__hash int, fingerprint string"))
    assert kept.columns[-2:] == ["__hash", "fingerprint"]
    texts = kept.collect()
    prints = [brute_print(r["text"]) for r in texts]
    assert len(set(prints)) == len(prints)
    assert {brute_print(t) for _, t in awkward} == set(prints)


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.without_near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_dense_groups_are_split_twice(spark, monkeypatch, broadcast):
    """A ball of fingerprints around one, more than a part may hold under every byte."""
    monkeypatch.setattr(simhash, "CROWD", 20)
    monkeypatch.setattr(simhash, "BROADCAST", broadcast)
    seen = []
    split = simhash._by_five_bytes
    monkeypatch.setattr(simhash, "_by_five_bytes", lambda prints: seen.append(prints.count()) or split(prints))
    draw = random.Random(11)
    prints = set()
    while len(prints) < 500:
        p = 0xF00DF00DF00DF00D
        for bit in draw.sample(range(64), draw.randint(2, 6)):
            p ^= 1 << bit
        prints.add(p)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(8)
    links = {(min(r), max(r)) for r in simhash.linked_prints(rows).collect()}
    assert seen and seen[0] > 100
    near = [(a, b) for a, b in itertools.combinations(range(500), 2) if bin(prints[a] ^ prints[b]).count("1") <= 3]
    known = {tuple(sorted((signed[a], signed[b]))) for a, b in near}
    assert links <= known
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a, b in known)
    assert len({find(p) for p in signed}) > 1


def test_linked_texts_without_ids_are_one(documents, prose):
    """Rows of null ids stay once for a group of different but linked fingerprints."""
    base = prose(5, 400)
    texts = [base]
    for k in range(60):
        words = base.split()
        words[k * 6 + 3] = "changed"
        texts.append(" ".join(words))
    prints = [brute_print(t) for t in texts]
    roots = brute_components(prints)
    assert len(set(roots)) < len(set(prints)) - 1
    left = simhash.without_near_duplicates(documents([(None, t) for t in texts])).collect()
    assert len(left) == len(set(roots))


def test_components_of_a_hub(spark):
    """A star and a path: one node holds most edges."""
    from latemark.llm.components import components
    from latemark.session import scratch_made, shared_dir
    import os

    star = [(7, i) for i in range(100, 1100)]
    path = [(i, i + 1) for i in range(2000, 2040)]
    with scratch_made() as paths:
        found = components(spark.createDataFrame(star + path + [(5, 5)], "a long, b long"))
        rows = {r["a"]: r["b"] for r in found.collect()}
        assert rows == {i: 7 for i in range(100, 1100)} | {i: 2000 for i in range(2001, 2041)}
        assert [p for p in paths if os.path.exists(p.removeprefix("file:"))] == [found.scratch]
    assert shared_dir(spark)
