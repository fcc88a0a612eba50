import pytest
from pyspark.sql import functions as F

from checks.legs import PERIODS, ROLES, legs
from checks.queries import _disjoint_and_whole
from latemark.operators import (
    content_position, hash_parts, hash_split, mark_parts, stratified_sample, stratified_split, temporal_split,
)
from latemark.plans import TreeConfig, trees


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def years(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "year int")


def test_temporal_split_places_the_cut(spark):
    split = temporal_split(years(spark, 2001, 2002, 2003, 2004, 2005, 2005), ratio=0.8)
    assert split.first_test_year == 2005 and split.test.count() == 2 and split.train.count() == 4


@pytest.mark.parametrize("values, ratio", [((2001,), 0.8), ((), 0.8), ((2001, 2002), 1.0), ((2001, 2002), 0.0)])
def test_temporal_split_refuses_an_empty_side(spark, values, ratio):
    with pytest.raises(ValueError):
        temporal_split(years(spark, *values), ratio=ratio)


def test_content_splits_ignore_layout(kept_clean):
    moved = kept_clean.repartition(7)
    for make in (
        lambda df: hash_split(df, 0.8, 42)[1],
        lambda df: stratified_sample(df, "label", {0: 0.1, 1: 0.3}, 42),
        lambda df: stratified_split(df, "label", 0.2, 42)[1],
    ):
        assert same_rows(make(kept_clean), make(moved))


def test_another_seed_gives_another_split(kept_clean):
    assert not same_rows(hash_split(kept_clean, 0.8, 1)[1], hash_split(kept_clean, 0.8, 2)[1])


def test_parts_cover_everything_once(kept_clean):
    shares = {"a": 0.5, "b": 0.3, "c": 0.2}
    parts = hash_parts(kept_clean, shares, 7)
    marked = {r["part"]: r["count"] for r in mark_parts(kept_clean, shares, 7).groupBy("part").count().collect()}
    assert {n: p.count() for n, p in parts.items()} == marked
    assert sum(marked.values()) == kept_clean.count()
    with pytest.raises(ValueError):
        hash_parts(kept_clean, {"a": 0.5, "b": 0.6}, 7)


@pytest.mark.parametrize("cell_bits", [1, 8, 16])
def test_stratified_shares_are_exact(kept_clean, cell_bits):
    train, test = stratified_split(kept_clean, "label", 0.2, 42, cell_bits=cell_bits)
    whole = dict(kept_clean.groupBy("label").count().collect())
    assert dict(test.groupBy("label").count().collect()) == {k: int(n * 0.2 + 0.5) for k, n in whole.items()}
    assert train.count() + test.count() == kept_clean.count()


def test_copies_stay_on_one_side(spark):
    rows = spark.range(300).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").alias("v"))
    copies = spark.range(200).select(F.lit(1).alias("label"), F.lit(-1).cast("bigint").alias("v"))
    both = rows.unionAll(copies)
    for train, test in (hash_split(both, 0.8, 3), stratified_split(both, "label", 0.3, 3)):
        assert train.intersect(test).isEmpty()
        assert train.count() + test.count() == 500


def test_sample_takes_only_named_labels(kept_clean):
    assert stratified_sample(kept_clean, "label", {1: 1.0}, 42).select("label").distinct().collect() == [(1,)]
    with pytest.raises(ValueError):
        stratified_sample(kept_clean, "label", {1: 1.5}, 42)


def test_splits_by_a_place_told_before_are_the_same(kept_clean):
    names = kept_clean.columns
    told = kept_clean.withColumn("_at", content_position(names, 42))
    for plain, by_place in (
        (hash_split(kept_clean, 0.8, 42), hash_split(told, 0.8, 42, names, "_at")),
        (stratified_split(kept_clean, "label", 0.2, 42), stratified_split(told, "label", 0.2, 42, position="_at")),
        # one cell for all: the cut is found by digests alone
        (stratified_split(kept_clean, "label", 0.2, 42), stratified_split(told, "label", 0.2, 42, names, 0, "_at")),
    ):
        assert all(same_rows(a, b.drop("_at")) for a, b in zip(plain, by_place))


def test_parts_with_a_lost_doubled_or_shared_row_are_found(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, "a"), (3, "b")], "x int, y string")
    low, high = rows.filter("x = 1"), rows.filter("x > 1")
    good = (low, high)
    assert _disjoint_and_whole(rows, [good, (high, low)])
    one = spark.createDataFrame([(1, None)], rows.schema)
    for bad in ((one, high), (low, high.unionAll(one)), (low.unionAll(one), high), (one, high.unionAll(one)), (low, low)):
        assert not _disjoint_and_whole(rows, [good, bad])


def test_tree_job_looks_for_the_cut_in_staged_rows(spark, small, monkeypatch):
    """The legs are joined once, not again for every pass of the stratified split."""
    class Seen(Exception):
        pass

    def seen(df, *_, **__):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(trees, "stratified_test", seen)
    with pytest.raises(Seen) as told:
        trees.run_trees(spark, TreeConfig(roles=ROLES, periods=PERIODS), legs(spark, small))
    assert "Join" not in str(told.value) and "parquet" in str(told.value)


def test_marking_parts_takes_a_digest_once(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 7).cast("double").alias("_position"))
    shares = {"train": 0.6, "validation": 0.2, "test": 0.2}
    marked = mark_parts(rows, shares, 5)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1
    assert marked.columns == ["id", "_position", "part"]
    apart = hash_parts(rows, shares, 5)
    for name in shares:
        assert same_rows(marked.filter(F.col("part") == name).drop("part"), apart[name])


def test_marking_parts_turns_no_digest_into_a_number(spark):
    rows = spark.range(2000).selectExpr("id % 700 as key", "if(id % 3 = 0, null, id / 7) as share")
    shares = {"a": 0.37, "b": 0.13, "c": 0.5}
    marked = mark_parts(rows, shares, 5)
    assert "conv(" not in marked._jdf.queryExecution().optimizedPlan().toString()
    place = content_position(rows.columns, 5)
    told = F.when(place < int(0.37 * 2**32), "a").when(place < int(0.5 * 2**32), "b").otherwise("c")
    assert marked.filter(F.col("part") != told).isEmpty() and marked.select("part").distinct().count() == 3
