import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

DEALT = ["toxicity", "sharding", "quality", "url_filter", "packing", "token_counts", "order_minhash", "decontamination", "simhash", "suffix_array", "hard_negatives", "license_scan", "spelling_variants"]


def test_registered():
    names = entry_points.queries()
    assert [n for n in (f"op{i}_{name}" for i, name in enumerate(DEALT, 1)) if n not in names] == []
    assert "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_text", "benchmark", "packing"]


@pytest.fixture(scope="module")
def planted(spark, prose, tmp_path_factory):
    """A folder of tables with toxic documents, copies, shared passages and benchmark items."""
    folder = str(tmp_path_factory.mktemp("tables"))
    item, passage = prose(5000, 30), prose(5001, 70)
    rows = []
    for i in range(300):
        text = ". ".join(prose(100 * i + k, 12) for k in range(6))
        if i % 5 == 0:
            text += f". you dolt {prose(i, 3)}"
        if i in (41, 42):
            text = rows[33][1]
        if i in (51, 52):
            text += ". " + passage
        if i in (61, 62):
            text = prose(i, 40) + f" {item.replace(' ', '  ')} " + prose(i + 9000, 40)
        rows.append((i, text, "en", "s", len(text)))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (301, "", "en", "s", 0), (None, prose(9, 40), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, passage


def test_stages(spark, planted):
    folder, rows, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage-{name}")
        docs = spark.read.parquet(f"{folder}/stage-{name}")
        if name != "packing":
            assert docs.columns == columns
        kept[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in found} for name, found in kept.items()}
    clean = {r[0] for r in rows if r[0] is None or r[0] >= 300 or r[0] % 5}
    assert ids["toxicity"] == clean
    assert ids["near_duplicates"] == clean - {41, 42, 301}
    texts = {r["doc_id"]: r["text"] for r in kept["repeated_text"]}
    assert passage[100:] not in texts[51] and passage[100:] not in texts[52] and texts[1] == rows[1][1]
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept["repeated_text"])
    assert ids["benchmark"] == ids["repeated_text"] - {61, 62}
    assert ids["packing"] == ids["benchmark"]


def test_extra_columns_and_empty_tables(spark, planted, tmp_path):
    folder = planted[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    for name in ("__score", "__text", "__id", "__hash", "__clean", "fingerprint", "n_bytes", "key", "n", "id"):
        docs = docs.withColumn(name, F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_leaves_its_result_only(spark, planted):
    from latemark.session import scratch_made

    with scratch_made() as paths:
        rows = corpus_pipeline.run(spark, planted[0])
    there = {p for p in paths if _exists(spark, p)}
    assert len(paths) > 10 and there == {rows.scratch} and rows.count() > 200


def _exists(spark, name):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
