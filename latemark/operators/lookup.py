"""Left join of a large table to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

from latemark.operators.aggregates import keyed_aggregates
from latemark.session import checkpointed

#: A lookup table of at most this many rows and bytes is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20

#: Types whose values differ in length.
VARYING = (StringType, BinaryType, ArrayType, MapType, StructType)

#: A key is hot if it holds this many times the mean rows of a shuffle task.
HOT_MEANS = 0.25


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    key: str,
    values: Sequence[str],
    table_rows: int,
    total_rows: int,
    rows_column: str = "rows",
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
    table_bytes: int | None = None,
) -> DataFrame:
    """Add ``values`` of ``table`` to every row of ``df``; null where the key is not there.

    ``table_rows`` and ``table_bytes`` are the checked size of ``table``; a small one is broadcast
    and nothing is shuffled. Bytes that are not given are summed up, where few rows leave the
    question open. For a larger one the keys of ``df`` itself are counted, in one pass over the key
    column that adds up before it shuffles. Keys that would fill a good part of a task are
    answered by broadcast: there are at most tasks / HOT_MEANS of them, whether the table
    knows them or not. Only the remaining keys are shuffled. Rows with a hot or null key take
    part in that shuffle under a key that matches nothing and spreads them by the task they
    come from and one narrow column, so no other column is read for it.

    ``counted`` (key, _n, _all) are the numbers of rows of the keys of ``df`` where they are known
    already; see ``key_counts`` for several keys at once.
    """
    slim = table.select(key, rows_column, *values)
    if fits_broadcast(slim.drop(rows_column), table_rows, table_bytes, broadcast_rows):
        return df.join(F.broadcast(slim.drop(rows_column)), on=key, how="left")

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if counted is None:
        counted = key_counts(df, [key])[key]
    heavy = counted.filter(F.col("_n") > F.col("_all") / tasks * HOT_MEANS).select(F.col(key).alias("_hot_key"))
    known = slim.select(F.col(key).alias("_known"), F.struct(*values).alias("_hot"))
    hot = heavy.join(known, F.col("_hot_key") == F.col("_known"), "left").drop("_known")
    marked = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    aside = F.col(key).isNull() | F.col("_hot_key").isNotNull()
    narrow = min((f for f in df.schema.fields if f.name != key), key=_width, default=df.schema[key])
    # equal again when a lost task runs again, unlike a random number
    spread = F.xxhash64(F.spark_partition_id(), F.col(f"`{narrow.name}`"))
    marked = marked.withColumn("_place", F.when(aside, spread).otherwise(F.xxhash64(key)))
    marked = marked.withColumn("_cold_only", F.when(~aside, F.col(key)))
    cold = slim.select(
        F.col(key).alias("_cold_key"), F.xxhash64(key).alias("_cold_place"), F.struct(*values).alias("_cold"),
    )
    joined = marked.join(
        cold.hint("shuffle_merge"),
        (F.col("_place") == F.col("_cold_place")) & (F.col("_cold_only") == F.col("_cold_key")),
        "left",
    )
    picked = [
        F.when(F.col("_hot_key").isNotNull(), F.col(f"_hot.{v}")).otherwise(F.col(f"_cold.{v}")).alias(v)
        for v in values
    ]
    rest = [c for c in df.columns if c != key]
    return joined.select(key, *rest, *picked)


def row_bytes(df: DataFrame, columns: Sequence[str]) -> Column:
    """About what the columns of a row take in memory: eight bytes each, and the length of what has one."""
    varying = [
        F.octet_length(F.col(c) if isinstance(df.schema[c].dataType, BinaryType) else F.col(c).cast("string"))
        for c in columns if isinstance(df.schema[c].dataType, VARYING)
    ]
    lengths = [F.coalesce(v, F.lit(0)).cast("bigint") for v in varying]
    return reduce(lambda a, b: a + b, lengths, F.lit(8 * (len(columns) + 1)).cast("bigint"))


def fits_broadcast(
    table: DataFrame, table_rows: int, table_bytes: int | None = None, broadcast_rows: int = BROADCAST_ROWS
) -> bool:
    """Whether a table of so many rows and bytes may be broadcast; unknown bytes are summed up."""
    if table_rows > broadcast_rows:
        return False
    if table_bytes is None:
        table_bytes = table.agg(F.sum(row_bytes(table, table.columns))).first()[0] or 0
    return table_bytes <= BROADCAST_BYTES


def key_counts(df: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """For each key column (key, _n, _all) without the null key, all from one scan of ``df``.

    ``_n`` counts the rows of a key, ``_all`` those of all keys of the column.
    Joined one after the other, lookups would count the rows of a frame that holds the joins
    before; counts of the frame they start from are the same.
    """
    tables = keyed_aggregates(df.select(*keys), keys, _n=F.count(F.lit(1)))
    tables.combined = checkpointed(tables.combined)
    known = {k: tables.table(k).filter(F.col(k).isNotNull()) for k in keys}
    sums = [t.select(F.lit(k).alias("k"), "_n") for k, t in known.items()]
    rows = reduce(DataFrame.unionByName, sums).groupBy("k").agg(F.sum("_n").alias("n")).collect()  # one row per key
    every = {r["k"]: r["n"] for r in rows}
    return {k: t.withColumn("_all", F.lit(every.get(k, 0))) for k, t in known.items()}


def _width(field: StructField) -> int:
    """Numbers with a fraction first: they differ most from row to row for their size."""
    order = ("double", "float", "bigint", "long", "timestamp", "date", "integer", "int")
    name = field.dataType.typeName()
    return order.index(name) if name in order else len(order)
