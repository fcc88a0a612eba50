import random
import re
import zlib
from collections import Counter

from latemark.llm.spellings import neighbours, spelling_groups, spelling_variants, word_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_counts(rows):
    counts = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_groups(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[w] = (n, len(near), best if best and counts[best] >= 5 * n else None)
    return out


def root(groups, word):
    while groups[word][2]:
        word = groups[word][2]
    return word


def invented(seed, count, letters="abé"):
    draw = random.Random(seed)
    return sorted({"".join(draw.choice(letters) for _ in range(draw.randint(6, 9))) for _ in range(count)})


def test_neighbours_equal_brute_force(spark):
    # few letters: runs of one letter, edits at both ends and in the middle
    words = invented(1, 250) + ["aaaaaa", "aaaaaaa", "baaaaaa", "aaaaaab", "x" * 30, "x" * 31, "y" + "x" * 30, "z"]
    found = {(r["word"], r["other"]) for r in neighbours(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)} and len(found) > 200


def test_groups_equal_brute_force(spark):
    draw = random.Random(2)
    counts = {w: draw.choice([5, 6, 30, 200, 1500]) for w in invented(3, 300, "abcd")}
    counts |= {"chain" + "abcdefgh"[:k]: 5 ** (8 - k) * 6 for k in range(1, 8)}
    rows = spark.createDataFrame(list(counts.items()) + [(None, 9)], "word string, n int")
    expected = brute_groups(counts)
    found = {r["word"]: r for r in spelling_groups(rows).collect()}
    assert {w: (r["n"], r["n_near"], r["form"]) for w, r in found.items()} == expected
    assert all(r["root"] == root(expected, w) and r["form_n"] == (counts[r["form"]] if r["form"] else None) for w, r in found.items())
    assert root(expected, "chainabcdefg") == "chaina"


def test_one_word_is_the_form_of_very_many(spark):
    counts = {"abcdefghij": 1000} | {"abcdefghij"[:i] + c + "abcdefghij"[i + 1:]: 5 for i in range(10) for c in "klmnopqrst"}
    found = spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(found) == 101 and {r["root"] for r in found} == {"abcdefghij"}


def test_texts(spark, documents, awkward, prose):
    draw = random.Random(9)
    pool = invented(4, 60, "abcdefÀé") + ["Straße", "ÉTUDES", "naïvely", "plain-words", "Longer÷word", "漢字abcdef"]
    rows = [(i, " ".join(draw.choice(pool) for _ in range(200))) for i in range(40)]
    rows += awkward + [(i, prose(7, 500)) for i in range(50, 60)] + [(None, "nullness " * 3), (None, "nullness " * 3)]
    counts = brute_counts(rows)
    docs = documents([(*r, "x", 1) for r in rows], "word string, n int")
    assert {r["word"]: r["n"] for r in word_counts(docs).collect()} == counts and "nullness" in counts
    expected = brute_groups(counts)
    assert {r["word"]: (r["n"], r["n_near"], r["form"]) for r in spelling_variants(docs).collect()} == expected


def test_empty_tables(spark, documents):
    assert spelling_variants(documents([])).count() == 0
    assert spelling_variants(documents([(1, None), (2, "")])).count() == 0
    assert neighbours(spark.createDataFrame([], "word string")).count() == 0
