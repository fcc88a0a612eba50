import random
import re

import pytest

from latemark.llm.licenses import NOTICES, PHRASES, Template, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [
        (i, t.label) for t in PHRASES for i in range(len(words)) if words[i:i + len(t.text.split())] == t.text.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({l for _, l in places}))


def told(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_base_equals_brute_force(spark, documents, awkward):
    draw = random.Random(5)
    pool = "gnu general public license apache mit cc by GNU License, MIT É漢 x-y the of".split()
    rows = [(100 + i, " ".join(draw.choice(pool) for _ in range(draw.randint(0, 40)))) for i in range(400)]
    rows += awkward + [(600, "MIT" + chr(0) + "License. mitlicense mit  \n license"), (601, "cc by cc by cc"), (None, "mit license"), (None, "mit license")]
    docs = documents([(*r, "x") for r in rows], "key string")
    found = license_scan(docs).collect()
    assert sorted(((r["doc_id"], *told(r)) for r in found), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
    for r in found:
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_notices_with_edits(spark, documents, prose):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    rows = [
        (1, f"{prose(1, 200)} {mit} {prose(2, 300)}"),
        # a word put in, one left out and one replaced
        (2, f"{prose(3, 50)} Permission is hereby freely granted, free of charge, to any person getting a copy of software {prose(4, 9)}"),
        # the same words in another order
        (3, " ".join(random.Random(1).sample(mit.split(), len(mit.split())))),
        # the words of the notice, each far from the next
        (4, " ".join(f"{w} {prose(i, 12)}" for i, w in enumerate(mit.split()))),
        (5, prose(5, 3000)),
        (6, "Licensed under CC BY-NC 4.0."), (7, "Licensed under the Apache License, Version 2.0."),
        (8, "This work is licensed under the GNU General Public License, version 3."),
    ]
    labels = {r["doc_id"]: r["labels"] for r in license_scan(documents(rows)).collect()}
    assert labels == {1: "mit", 2: "mit", 3: "", 4: "", 5: "", 6: "cc-by,cc-by-nc-4.0", 7: "apache,apache-2.0", 8: "gpl,gpl-3.0"}


def test_every_notice_is_found(spark, documents, prose):
    found = license_scan(documents([(i, f"{prose(i, 30)}; {t.text}; {prose(i + 50, 30)}") for i, t in enumerate(NOTICES)])).collect()
    assert all(NOTICES[r["doc_id"]].label in r["labels"].split(",") and r["score"] == 1.0 for r in found)


def test_empty_table_short_template_and_shuffled_templates(spark, documents, monkeypatch):
    assert license_scan(documents([])).count() == 0
    with pytest.raises(ValueError):
        license_scan(documents([(1, "x")]), [Template("one", "word", True)])
    monkeypatch.setattr("latemark.llm.licenses.BROADCAST_GRAMS", 0)
    assert license_scan(documents([(1, "the mit license")])).first()["base_labels"] == "mit"


def test_no_python_workers(spark, documents):
    plan = license_scan(documents([(1, "the mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
