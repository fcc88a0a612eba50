"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from latemark.session import remove_paths, scratch_path

#: A key is hot when it has more than this share of the rows; so at most 256 keys are hot.
HOT_PARTS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared folder; what reads it survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.scratch = path
    return found


def forget(*tables: DataFrame) -> None:
    """Delete kept tables of which all that reads them is written."""
    remove_paths(tables[0].sparkSession, [t.scratch for t in tables])


def whole(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``work`` over the Arrow batches of each partition."""
    return df.mapInArrow(work, schema if isinstance(schema, (str, StructType)) else StructType(schema))


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def extended(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``df`` with the fields of ``ddl`` behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def with_totals(df: DataFrame, order: list[str], amount: str, name: str) -> DataFrame:
    """Add the sum of ``amount`` in all rows before each row, in the order of whole rows.

    ``order`` must tell any two rows apart. Rows are cut into ranges, each is summed by
    itself, and the sums of the ranges, one row a partition, are added up and broadcast.
    """
    placed = kept(
        df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges"
    )
    sums = placed.groupBy("__part").agg(F.sum(amount).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + F.coalesce(F.sum(amount).over(own), F.lit(0)))
        .drop("__part", "__before")
    )


def split_join(left: DataFrame, right: DataFrame, on: str, count: str, how: str = "inner") -> DataFrame:
    """Join a unique-keyed ``right``, which has the rows of each key in ``count``.

    Hot keys, fewer than ``HOT_PARTS`` by construction, are broadcast; the rest is an
    ordinary join. Both frames are read more than once, so they should be kept ones.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    hot = right.filter(F.col(count) > total / HOT_PARTS)
    hot_keys = [r[0] for r in hot.select(on).collect()]
    cold_left, cold = left, right
    if not hot_keys:
        return left.join(right, on, how)
    cold_left = left.filter(F.col(on).isNull() | ~F.col(on).isin(hot_keys))
    cold = right.filter(~F.col(on).isin(hot_keys))
    joined = left.filter(F.col(on).isin(hot_keys)).join(F.broadcast(hot), on)
    return joined.unionByName(cold_left.join(cold, on, how))
