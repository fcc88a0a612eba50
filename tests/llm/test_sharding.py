from collections import Counter

import pytest

from latemark.llm.sharding import permuted, shard_rows


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one_to_one(spark, rows):
    from pyspark.sql import functions as F

    places = [r[0] for r in spark.range(rows).select(F.expr(permuted("id", rows, 5))).collect()]
    assert sorted(places) == list(range(rows))


def _rows(df):
    return sorted(map(tuple, df.select("doc_id", "size", "text_crc32", "shard", "slot").collect()), key=str)


def test_laws(spark, documents, awkward):
    docs = documents(awkward)
    found = shard_rows(docs, shards=4).collect()
    assert len(found) == len(awkward)
    by = Counter(r["shard"] for r in found)
    assert max(by.values()) - min(by.get(s, 0) for s in range(4)) <= 1
    for shard in range(4):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(by.get(shard, 0)))
    sizes = Counter((r["doc_id"], r["size"]) for r in found)
    assert sizes == Counter((i, len((t or "").encode()) + 1) for i, t in awkward)


def test_same_rows_whatever_their_layout(documents, awkward):
    assert _rows(shard_rows(documents(awkward))) == _rows(shard_rows(documents(awkward[::-1]).repartition(7)))


def test_crc_and_empty(documents, spark):
    import zlib

    row = shard_rows(documents([(1, "é")])).first()
    assert (row["text_crc32"], row["shard"], row["slot"]) == (zlib.crc32("é".encode()), 0, 0)
    assert shard_rows(documents([])).count() == 0


def test_many_equal_rows(documents):
    found = shard_rows(documents([(1, "x")] * 100), shards=16).collect()
    assert sorted((r["shard"], r["slot"]) for r in found) == sorted((p % 16, p // 16) for p in range(100))
