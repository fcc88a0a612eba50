import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from latemark.llm import hard_negatives as module
from latemark.llm.hard_negatives import hard_negatives, scan

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=10):
    part = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64), l) for i, v, l in rows]
    out = set()
    for i, v, l in part:
        if i % every:
            continue
        scored = sorted((-int(v @ w), j, m) for j, w, m in part if j != i)
        for s, j, _ in [x for x in scored if x[2] == l][:positives]:
            inside = [x for x in scored if x[2] != l and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out |= {(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(inside[:negatives])}
    return out


def told(frame):
    return {(r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in frame.collect()}


def vectors(count, dims, hot=0.0, seed=1):
    draw = np.random.default_rng(seed)
    keep = random.Random(seed)
    whole = draw.normal(0, 0.2, (count, dims)).astype(np.float32)
    # many ties: half of the vectors repeat another one
    for i in range(0, count, 2):
        whole[i] = whole[keep.randrange(count)]
    return [(i, [float(x) for x in whole[i]], 0 if keep.random() < hot else keep.randrange(4)) for i in range(count)]


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(module, "CELL", 64)
    monkeypatch.setattr(module, "GROUP", 7)
    rows = vectors(600, 20, hot)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute(rows, every=20)
    assert len(expected) > 300
    assert told(hard_negatives(frame, F.col("vec_id") % 20 == 0)) == expected


def test_scan_keeps_all_that_may_count():
    draw = np.random.default_rng(3)
    columns = draw.integers(-60, 60, (24, 500)).astype(np.float64)
    for n in range(40):
        anchor = draw.integers(-60, 60, 24).astype(np.float64)
        exact = anchor @ columns
        low, high = sorted(draw.integers(-20_000, 20_000, 2))
        alive, score = scan(columns, columns.min(1), columns.max(1), anchor, [(low, high)], 10)
        assert (score == exact[alive]).all()
        inside = np.sort(exact[(exact >= low) & (exact <= high)])[::-1][:10]
        mine = np.sort(score[(score >= low) & (score <= high)])[::-1][:10]
        assert inside.tolist() == mine.tolist()
    # the bounds do leave rows out before the last dimension
    anchor = np.array([100.0] + [0.1] * 23)
    alive, _ = scan(columns, columns.min(1), columns.max(1), anchor, [(-1e9, 1e9)], 5)
    assert len(alive) < 50


def test_awkward_rows(spark):
    rows = [
        (0, [0.5, 0.5, 0.0], 1), (1, [0.5, 0.4, 0.0], 1), (2, [0.3, 0.2, 0.1], 2), (None, [0.5, 0.5, 0.5], 2), (3, None, 2),
        (4, [0.5, None, 0.5], 2), (5, [0.5, float("nan"), 0.5], 2), (6, [0.5, float("inf"), 0.1], 2), (7, [0.5, 0.3, 0.2], None),
        (8, [0.3], 2), (9, [], 2), (10, [0.4, 0.1, 0.0], 2), (10, [0.4, 0.1, 0.0], 2), (10, [0.1, 0.4, 0.0], 2),
        (100, [], 3), (200, [-0.5, 0.0, 0.0], 4), (201, [0.5, 0.0, 0.0], 4),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("mark", F.lit("y")).withColumn("n", F.lit(1))
    found = hard_negatives(frame, F.col("vec_id") % 100 == 0).collect()
    first = [(r["rank"], r["negative_id"], r["negative_score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["anchor_id"] == 0]
    # the two different rows of vec_id 10 both take part, the repeated one once
    assert first == [(1, 201, 128 * 128), (2, 2, 128 * (76 + 51)), (3, 10, 128 * 127), (4, 10, 128 * 127), (5, 8, 128 * 76)]
    # a negative positive score opens no window, and neither does an anchor without positives
    assert {r["anchor_id"] for r in found} == {0}


def test_empty_tables_and_large_components(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0
    alone = spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 1)], SCHEMA)
    assert hard_negatives(alone, F.col("vec_id") % 100 == 0).count() == 0
    wide = spark.createDataFrame([(0, [3e4, 1.0], 0), (1, [2.5e4, 1.0], 0), (2, [1e4, 3.0], 1)], SCHEMA)
    assert told(hard_negatives(wide, F.col("vec_id") % 100 == 0)) == brute([(0, [3e4, 1.0], 0), (1, [2.5e4, 1.0], 0), (2, [1e4, 3.0], 1)])
    huge = spark.createDataFrame([(0, [3e30], 0), (1, [1.0], 0)], SCHEMA)
    with pytest.raises(ValueError):
        hard_negatives(huge, F.col("vec_id") % 100 == 0)
