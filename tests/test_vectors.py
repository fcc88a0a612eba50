from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import queries
from latemark.features.vectors import hot_slot, vector_slot, vector_sum, vector_width


def test_entries_of_vectors_too_wide_to_write_out(spark):
    """An array of 2^30 doubles does not fit a row; the stored entries do."""
    wide = 1 << 30
    rows = [
        (0, Vectors.sparse(wide, [5, wide - 2], [1.0, 7.5])), (1, Vectors.sparse(wide, [], [])),
        (2, Vectors.sparse(wide, [wide - 1], [float("nan")])), (3, Vectors.dense([0.0, 1.0, 2.0, 3.0])),
    ]
    df = spark.createDataFrame(rows, ["i", "v"])
    width = vector_width("v")
    found = df.select(
        width, vector_slot("v", width - 2), vector_sum("v", width - 2), hot_slot("v"),
        F.isnan(vector_slot("v", width - 1)), vector_slot("v", width),
    ).orderBy("i").collect()
    assert [tuple(r) for r in found] == [
        (wide, 7.5, 1.0, 5, False, None), (wide, 0.0, 0.0, -1, False, None),
        (wide, 0.0, 0.0, -1, True, None), (4, 2.0, 1.0, 1, False, None),
    ]


def test_no_query_writes_out_one_hot_vectors():
    assert not hasattr(queries, "vector_to_array")
