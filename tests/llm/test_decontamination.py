import random

import numpy as np
import pytest

from latemark.llm import decontamination as dec


def brute_align(item, part):
    table = [[0] * (len(part) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(part) + 1):
            same = dec.MATCH if item[i - 1] == part[j - 1] else dec.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] + dec.GAP, table[i][j - 1] + dec.GAP)
    return max(map(max, table))


def test_alignment_scores():
    draw = random.Random(1)
    for _ in range(200):
        item, part = ([draw.randint(0, 4) for _ in range(draw.randint(1, 12))] for _ in range(2))
        score, equal, first, end = dec.align(np.array(item), np.array(part))
        assert score == brute_align(item, part)
        assert 0 <= first <= end <= len(part) and equal <= min(len(item), end - first)
        assert brute_align(item, part[first:end]) == score


@pytest.fixture(scope="module")
def case(prose):
    items = [prose(900 + i, 40) for i in range(12)] + ["the of"]
    draw = random.Random(8)
    rows, want = [], set()
    for i in range(120):
        text = "the of and in to " + prose(i, 120) + " the of and in to"
        if i % 6 == 0:
            item = i // 6 % 12
            words = items[item].split()
            if i % 12 == 0:  # edited: words changed, one left out, one added
                for at in draw.sample(range(40), 4):
                    words[at] = "changed"
                del words[20]
                words.insert(7, "added")
            text = prose(i, 70) + "\n" + " ".join(words).upper() + ". " + prose(i + 500, 60)
            want.add((i, item))
        elif i % 6 == 1:  # half of an item is no copy
            text += " " + " ".join(items[i % 12].split()[:20])
        rows.append((i, text))
    return items, rows, want


def test_planted_copies(spark, documents, case, monkeypatch):
    items, rows, want = case
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items[:12])], "item_id long, text string, doc_id string")
    for words in (500_000, 200):  # one block and several
        monkeypatch.setattr(dec, "BLOCK_WORDS", words)
        found = dec.contaminations(documents(rows), benchmark).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
        assert all(r["similarity"] >= 0.8 and r["item_words"] == 40 for r in found)
        clean = dec.without_benchmark(documents(rows), benchmark).collect()
        assert {r["doc_id"] for r in clean} == {i for i, _ in rows} - {d for d, _ in want}


def test_item_that_leaked_everywhere(spark, documents, prose):
    item = prose(77, 30)
    rows = [(i, prose(i, 30) + " " + item + " " + prose(i + 99, 30)) for i in range(60)] + [(60, prose(1000, 60))]
    benchmark = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert {r["doc_id"] for r in dec.contaminations(documents(rows), benchmark).collect()} == set(range(60))


def test_edited_copy_in_a_thousand_documents(spark, documents, prose):
    item, five = prose(78, 40), "alpha beta gamma delta epsilon"
    words = item.split()
    for at in (4, 14, 24, 34):
        words[at] = "changed"
    copy = " ".join(words)
    rows = [(i, prose(i, 12) + " " + copy + " " + prose(i + 5000, 12)) for i in range(1000)]
    rows += [(1000, prose(1, 60)), (1001, "so alpha beta changed delta epsilon it was")]
    benchmark = spark.createDataFrame([(5, item), (6, five)], "item_id long, text string")
    found = dec.contaminations(documents(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["equal_words"]) for r in found} == {*((i, 5, 36) for i in range(1000)), (1001, 6, 4)}
    assert {r["doc_id"] for r in dec.without_benchmark(documents(rows), benchmark).collect()} == {1000}


def test_word_counts_leave_out_no_copy():
    draw = random.Random(3)
    items = [[draw.choice("abcdefgh") for _ in range(draw.randint(1, 14))] for _ in range(40)]
    counts = {w: draw.randint(0, 9) for w in "abcdefgh"}
    seeds, bags = dec.seeds_of(items, counts), dec.bags_of(items, counts)
    met = 0
    for _ in range(60):
        own = draw.choice(items)
        words = ["x", *own, "y"]
        for _ in range(len(own) - dec.needed(len(own))):
            words[draw.randrange(1, len(own) + 1)] = "z"
        found = {m[0] for m in dec.matches_in(words, items, seeds, bags)}
        want = {i for i, it in enumerate(items) if dec.align(*coded(it, words))[1] >= dec.SIMILARITY * len(it)}
        # words changed near an end may leave the best local alignment too short
        assert found <= want and want & {items.index(own)} <= found
        met += items.index(own) in want
    assert met > 40


def coded(*texts):
    code = {}
    return [np.array([code.setdefault(w, len(code)) for w in t]) for t in texts]


def test_awkward_rows(spark, documents, awkward):
    docs = documents([(*a, i, "y") for i, a in enumerate(awkward)], "row int, __clean string")
    items = spark.createDataFrame([(1, None), (None, ""), (2, "one"), (2, "one"), (None, awkward[0][1])], "item_id long, text string")
    found = dec.contaminations(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found if r["item_id"]) == [(6, 2)] * 4
    assert {r["doc_id"] for r in found if r["item_id"] is None} == {1, 7}
    clean = dec.without_benchmark(docs, items)
    assert clean.columns == docs.columns
    assert {r["row"] for r in clean.collect()} == {i for i, a in enumerate(awkward) if a[0] not in (1, 6) and a[1] != awkward[0][1]}
    assert dec.contaminations(documents([]), items).count() == 0
    assert dec.without_benchmark(docs, items.limit(0)).count() == len(awkward)


def test_seeds_lose_nothing_to_unseeded_alignment(spark, documents, prose):
    """Copies with words put in, left out and replaced at random, against every item with every document."""
    draw = random.Random(31)
    items = [prose(3000 + i, draw.choice([6, 15, 40])) for i in range(8)]
    rows = [(0, prose(1, 60)), (1, " ".join(f"{w} foreign" for w in items[0].split())), (2, " ".join(f"{w} so" for w in prose(3002, 40).split()))]
    for i in range(3, 90):
        words = draw.choice(items).split()
        for _ in range(draw.randint(0, len(words) // 4)):
            kind, at = draw.randrange(3), draw.randrange(len(words))
            words[at:at + 1] = [[], ["new"], [words[at], "more", "words"]][kind]
        if i % 3 == 0:  # a foreign word after every second one
            words = [x for k, w in enumerate(words) for x in ([w, f"f{k}"] if k % 2 else [w])]
        rows.append((i, f"{prose(i, 30)} {' '.join(words)} {prose(i + 400, 30)}"))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for i, text in rows:
        for n, item in enumerate(items):
            one, many = coded(item.split(), text.split())
            if dec.align(one, many)[1] >= dec.SIMILARITY * len(one):
                want.add((i, n))
    found = {(r["doc_id"], r["item_id"]) for r in dec.contaminations(documents(rows), benchmark).collect()}
    assert len(want) > 50 and found >= want
    assert all(dec.needed(len(items[n].split())) <= len(set(items[n].split()) & set(rows[i][1].split())) for i, n in found - want)


def test_other_scripts_come_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_WORDS", 60)
    items = [" ".join(chr(0x430 + (i * 7 + k * k) % 32) * (1 + k % 3) for k in range(20)) for i in range(12)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    blocks = list(dec._blocks(benchmark))
    assert len(blocks) > 4 and max(sum(len(w) for _, w in b) for b in blocks) < 240
    found = dec.contaminations(documents([(i, f"so {t} на") for i, t in enumerate(items)]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} >= {(i, i) for i in range(12)}


def test_one_table_empty(spark, documents):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = documents([(1, "one two three"), (2, "four")])
    assert dec.contaminations(documents([]), items).count() == 0 and dec.without_benchmark(documents([]), items).count() == 0
    assert dec.contaminations(docs, items.limit(0)).count() == 0 and dec.without_benchmark(docs, items.limit(0)).count() == 2
