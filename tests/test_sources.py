import json
from pathlib import Path

import pytest

from latemark.evaluation import metrics_document
from latemark.sources import (
    RAW_TYPES, malformed_entries, read_legs, read_sample, read_staged, stage_legs, write_confusion, write_metrics, write_sample,
)

TYPES = {"a": "int", "b": "double", "c": "string"}


def written(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_header_order_and_case_do_not_matter(spark, tmp_path):
    path = written(tmp_path, one="B,c,A\n1.5,x,7\n")
    assert read_legs(spark, path, types=TYPES).collect() == [(7, 1.5, "x")]
    assert read_legs(spark, path, columns=["C", "a"], types=TYPES).collect() == [("x", 7)]


def test_files_that_disagree_fail(spark, tmp_path):
    path = written(tmp_path, one="a,b,c\n1,1.5,x\n", two="b,a,c\n2.5,2,y\n")
    with pytest.raises(Exception, match="header|schema"):
        read_legs(spark, path, columns=["a"], types=TYPES).collect()


def test_missing_marks_are_null(spark, tmp_path):
    path = written(tmp_path, one="a,b,c\nNA,NA,NA\n,,\n1,2.0,z\n")
    rows = {tuple(r) for r in read_legs(spark, path, types=TYPES, corrupt_column="bad").collect()}
    assert rows == {(None, None, None, None), (1, 2.0, "z", None)}


def test_malformed_values_keep_the_line(spark, tmp_path):
    path = written(tmp_path, one="a,b,c\nseven,2.0,z\n")
    rows = read_legs(spark, path, types=TYPES, corrupt_column="bad").collect()
    assert [tuple(r) for r in rows] == [(None, 2.0, "z", "seven,2.0,z")]


def test_whole_numbers_with_a_point(spark, tmp_path):
    path = written(tmp_path, one="a,b,c\n7.0,1,x\n-3.00,2,y\n7.5,3,z\n9999999999,4,v\nx,5,w\nNA,6,u\n 8 ,7,t\n")
    rows = {r["c"]: r["a"] for r in read_legs(spark, path, types=TYPES).collect()}
    assert {k: rows[k] for k in "xyzvwu"} == {"x": 7, "y": -3, "z": None, "v": None, "w": None, "u": None}
    counts = {r["column"]: (r["entries"], r["malformed"]) for r in malformed_entries(spark, path, types=TYPES).collect()}
    assert counts == {"a": (6, 3), "b": (7, 0)}
    big = written(tmp_path, one="a,b,c\n9007199254740993.0,1,x\n")
    assert read_legs(spark, big, types=TYPES | {"a": "bigint"}).first()["a"] == 9007199254740993


def test_absent_columns_are_named(spark, tmp_path):
    path = written(tmp_path, one="a,b\n1,2\n")
    with pytest.raises(ValueError, match="c"):
        read_legs(spark, path, types=TYPES, strict=True)
    with pytest.raises(ValueError, match="c"):
        read_legs(spark, path, columns=["c"], types=TYPES)


def test_raw_schema_has_all_columns():
    assert len(RAW_TYPES) == 37 and set(RAW_TYPES.values()) == {"int", "double", "string"}


def test_staging_prunes_years(spark, tmp_path):
    df = spark.createDataFrame([(y, y * 1.0) for y in range(2000, 2010)], "year int, v double")
    stage_legs(df, str(tmp_path / "staged"))
    recent = read_staged(spark, str(tmp_path / "staged"), ["year", "v"]).filter("year >= 2008")
    assert sorted(tuple(r) for r in recent.collect()) == [(2008, 2008.0), (2009, 2009.0)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_metrics_text_is_one_ordered_document(spark, tmp_path):
    document = metrics_document(
        spark, model="m", mode="baseline", auc=0.75, weights={"bias": 1.0, "z": 2.0, "a": 3.0},
        confusion=[(0, 0, 5), (1, 1, 2)],
    )
    path = write_metrics(document, str(tmp_path), "baseline")
    (part,) = Path(path).glob("part-*")
    (line,) = part.read_text().splitlines()
    told = json.loads(line)
    assert list(told["weights"]) == ["bias", "z", "a"] and told["auc"] == 0.75
    assert told["confusion"][1] == {"label": 1, "prediction": 1, "count": 2}
    # what is not known is written as null, not left out
    assert told["positive_weight"] is None and "positive_weight" in told
    with pytest.raises(ValueError, match="colour"):
        metrics_document(spark, colour="red")


def test_document_of_many_weights(spark):
    import time

    start = time.perf_counter()
    row = metrics_document(spark, weights={f"w{i}": i for i in range(100_000)}).first()
    assert len(row["weights"]) == 100_000 and time.perf_counter() - start < 20


def test_confusion_file_layout(spark, tmp_path):
    df = spark.createDataFrame([(1, 0, 4), (0, 0, 3)], "label int, prediction int, count bigint")
    path = write_confusion(df, str(tmp_path), "weighted")
    (part,) = Path(path).glob("part-*")
    assert part.read_text().split() == ["label,prediction,count", "0,0,3", "1,0,4"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_sample_keeps_types(spark, tmp_path, fmt):
    df = spark.createDataFrame([(0, 1.5, "x"), (1, 2.5, "y")], "label int, v double, s string")
    write_sample(df, str(tmp_path / fmt), "label", fmt)
    again = read_sample(spark, str(tmp_path / fmt), df, fmt)
    assert again.dtypes == df.dtypes and sorted(again.collect()) == sorted(df.collect())
