import math
import random
import re
import zlib

import numpy as np
import pytest

from latemark.llm import quality, toxicity
from latemark.llm.labelled import held_out


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def marked(prose):
    """(documents, toxic labels, quality labels): insults in single sentences, junk in single passages."""
    draw = random.Random(4)
    rows, toxic, good = [], {}, {}
    for i in range(700):
        sentences = [prose(1000 * i + k, draw.randint(5, 15)) for k in range(draw.randint(3, 9))]
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            sentences.insert(draw.randrange(len(sentences)), f"some {draw.choice(['dolt', 'knave', 'blockhead'])} {prose(i, 4)}")
        good[i] = int(i % 4 != 0)
        text = ". ".join(sentences)
        if not good[i]:
            text += " " + " ".join(w.upper() + "!!" for w in prose(i + 5, 60).split())
        rows.append((i, text))
    return rows, toxic, good


def _auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    labels = np.array(labels)
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_held_out_fold(spark):
    from pyspark.sql import functions as F

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert [r["h"] for r in rows] == [_held(r["id"]) for r in rows]
    assert spark.sql("select cast(null as bigint) id").select(held_out(F.col("id"))).first()[0] is False


def test_toxicity_on_held_out(spark, documents, marked):
    rows, toxic, _ = marked
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    model = toxicity.learn(documents(rows), labels)
    found = {r["doc_id"]: r for r in toxicity.scored(documents(rows), model).collect()}
    out = [i for i in toxic if _held(i)]
    assert _auc([found[i]["score"] for i in out], [toxic[i] for i in out]) > 0.99
    texts = dict(rows)
    hits = [i for i in out if toxic[i]]
    caught = [i for i in hits if any(w in texts[i][s["start"]:s["end"]] for s in found[i]["spans"] for w in ("dolt", "knave", "blockhead"))]
    assert len(caught) >= 0.9 * len(hits)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_quality_on_held_out(spark, documents, marked):
    rows, _, good = marked
    labels = spark.createDataFrame([(i, q, 0) for i, q in good.items()], "doc_id long, quality int, toxic int")
    model = quality.learn(documents(rows), labels)
    found = {r["doc_id"]: r["score"] for r in quality.scored(documents(rows), model).collect()}
    out = [i for i in good if _held(i)]
    assert _auc([found[i] for i in out], [good[i] for i in out]) > 0.99


def test_attention_slopes_match_differences():
    draw = np.random.default_rng(0)
    model = quality.AttentionModel()
    model.parts["score"] = draw.normal(size=quality.HIDDEN)
    passages, heads = draw.normal(size=(9, quality.WIDTH)), np.array([0, 2, 3])
    labels, share = np.array([1, 0, 1]), np.array([0.2, 0.5, 0.3])

    def loss():
        s = model.forward(passages, heads)["score"]
        return -(share * np.where(labels == 1, np.log(s), np.log(1 - s))).sum()

    slopes = model.slopes(model.forward(passages, heads), heads, labels, share)
    for name, values in model.parts.items():
        spot = tuple(draw.integers(n) for n in values.shape)
        before, step = values[spot], 1e-5
        values[spot] = before + step
        above = loss()
        values[spot] = before - step
        below = loss()
        values[spot] = before
        assert slopes[name][spot] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def test_awkward_rows_and_names(spark, documents, awkward):
    docs = documents([(*a, i, "y") for i, a in enumerate(awkward)], "row int, __text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (2, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for module, last in ((toxicity, "spans"), (quality, "best_passage")):
        found = module.scored(docs, module.learn(docs, labels))
        assert found.columns == [*docs.columns, "score", last]
        rows = found.collect()
        assert len(rows) == len(awkward) and all(0 <= r["score"] <= 1 for r in rows)
        assert {r["row"]: r["text"] for r in rows} == {i: a[1] for i, a in enumerate(awkward)}


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        assert module.scored(documents([]), module.learn(documents([]), labels)).count() == 0
    assert toxicity.scored(documents([(1, "a")]), toxicity.learn(documents([(1, "a")]), labels)).first()["score"] < 0.01


def test_toxicity_scores_are_noisy_or_of_sentences(documents, awkward, marked):
    """Scores and spans against their definition, a product over all sentences of whole texts."""
    draw = np.random.default_rng(8)
    # weights are sent as 32-bit numbers; sums of 64ths have no rounding
    model = toxicity.SentenceModel(np.round(draw.normal(0, 0.7, toxicity.BUCKETS) * 64) / 64, -4.0)
    pairs = awkward + marked[0][:60]
    docs = documents([(*p, i) for i, p in enumerate(pairs)], "row int")
    found = {r["row"]: r for r in toxicity.scored(docs, model).collect()}
    for row, (_, text) in enumerate(pairs):
        clean, spans, at = 1.0, [], 0
        for part in re.split(r"([.!?\n]+)", text or ""):
            words = set(re.findall(r"\w+", part.lower()))
            if words:
                z = model.bias
                for word in words:
                    names = [word] + [f"{n} {word[:n]}" for n in (3, 4, 5) if len(word) > n]
                    z += sum(model.weights[zlib.crc32(n.encode()) % toxicity.BUCKETS] for n in names)
                chance = 1 / (1 + math.exp(-max(min(z, 700), -700)))
                clean *= 1 - chance
                if chance >= 0.3:
                    spans.append((at, at + len(part), pytest.approx(chance, abs=1e-9)))
            at += len(part)
        assert found[row]["score"] == pytest.approx(1 - clean, abs=1e-9)
        assert [tuple(s) for s in found[row]["spans"]] == spans


def _passage_numbers(words):
    """What a passage of words (bytes) is encoded by, counted one by one."""
    letters = b" ".join(words)
    kinds = [
        lambda c: 65 <= c <= 90, lambda c: 97 <= c <= 122, lambda c: 48 <= c <= 57, lambda c: 128 <= c < 192,
        lambda c: c >= 192, lambda c: c in b" \t\r\n", *[lambda c, s=s: c == s for s in quality.SIGNS],
    ]
    n, lengths = len(words), [len(w) for w in words]
    return [math.sqrt(sum(map(kind, letters)) / len(letters)) for kind in kinds] + [
        n / 40, sum(lengths) / n / 10, len(set(words)) / n, max(lengths) / 30,
        sum(a == b for a, b in zip(words, words[1:])) / n, sum(w.isupper() for w in words) / n,
        sum(w.isalpha() for w in words) / n, sum(k <= 3 for k in lengths) / n,
    ]


def test_quality_scores_are_attention_over_all_passages(documents, awkward, marked):
    """Scores and strongest passages against their definition, passage by passage over whole texts."""
    draw = np.random.default_rng(9)
    model = quality.AttentionModel(3)
    model.parts["score"] = draw.normal(size=quality.HIDDEN)
    model.mean, model.spread = draw.uniform(0, 0.3, quality.WIDTH), draw.uniform(0.2, 1, quality.WIDTH)
    pairs = [p for p in awkward if len(p[1] or "") < 50_000] + marked[0][:40] + [(99, " ".join(t for _, t in marked[0][:150]))]
    docs = documents([(*p, i) for i, p in enumerate(pairs)], "row int")
    found = {r["row"]: r for r in quality.scored(docs, model).collect()}
    p = model.parts
    for row, (_, text) in enumerate(pairs):
        words = (text or "").encode().split()
        passages = [_passage_numbers(words[i:i + 40]) for i in range(0, len(words), 40)] or [[0.0] * quality.WIDTH]
        hidden, strength = [], []
        for x in passages:
            x = np.clip((np.array(x) - model.mean) / model.spread, -8, 8)
            h = np.tanh(x @ p["encode"] + p["encode0"])
            gate = 1 / (1 + np.exp(-(h @ p["gate"])))
            hidden.append(h)
            strength.append(math.exp(float((np.tanh(h @ p["tanh"]) * gate) @ p["attend"])))
        z = sum(s * h for s, h in zip(strength, hidden)) / sum(strength)
        assert found[row]["score"] == pytest.approx(1 / (1 + math.exp(-float(z @ p["score"] + p["score0"][0]))), abs=1e-9)
        assert strength[found[row]["best_passage"]] == pytest.approx(max(strength))
