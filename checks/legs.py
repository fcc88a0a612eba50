"""Transport legs derived from the order tables, used by the registered queries.

Each line item is a leg: its ship date is the day of travel, order priority the carrier,
supplier and customer nation the two ends. Nulls are planted by fixed rules. The SQL
twin is ``LEGS_SQL`` in ``checks/oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.operators import clean_legs
from latemark.roles import LegRoles
from latemark.sources import RAW_TYPES

ROLES = LegRoles(
    delay="delay",
    categorical=("carrier", "origin_id", "dest_id"),
    numeric=("year", "month", "day", "dayofweek", "sched_hhmm", "distance", "sched_elapsed"),
    scheduled_hhmm="sched_hhmm",
    carrier="carrier",
    origin="origin_id",
    destination="dest_id",
)

#: months left out of training, both ends included
PERIODS = (((1998, 3), (2000, 6)),)
START_YEAR = 1995
LEG_TYPES = {
    "year": "int", "month": "int", "day": "int", "dayofweek": "int", "carrier": "string",
    "origin_id": "bigint", "dest_id": "int", "sched_hhmm": "int", "distance": "double",
    "sched_elapsed": "double", "taxi_out": "double", "air_time": "double", "delay": "double",
    "cancelled": "int", "diverted": "int",
}
IMPUTED = ("taxi_out", "air_time")


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # a time of day is turned into its date once a row, and lines are shuffled once, with what they need
    items = table("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    customers = table("customer").select("c_custkey", "c_nationkey")
    orders = (
        table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
    )
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.col("l_shipdate")
    number, quantity = F.col("l_linenumber"), F.col("l_quantity")
    mixed = (F.col("l_partkey") * 31 + F.col("l_orderkey") * 17) % 60
    delay = (
        mixed - 45
        + F.floor((F.col("l_orderkey") % 24) / 6) * 3
        + F.substring("o_orderpriority", 1, 1).cast("int") * 2
    )

    def unless(condition, value):
        return F.when(~condition, value)

    return joined.select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("dayofweek"),
        unless((number == 7) & (quantity <= 5), F.col("o_orderpriority")).alias("carrier"),
        F.col("l_suppkey").alias("origin_id"),
        F.when(
            (F.year(day) >= 2000) & (F.col("c_nationkey") == 24), F.lit(99)
        ).otherwise(F.col("c_nationkey")).alias("dest_id"),
        ((F.col("l_orderkey") % 24) * 100 + F.col("l_partkey") % 60).cast("int").alias("sched_hhmm"),
        F.col("l_extendedprice").alias("distance"),
        quantity.alias("sched_elapsed"),
        unless(number == 3, F.col("l_discount") * 100).alias("taxi_out"),
        unless(number == 5, quantity * 3).alias("air_time"),
        unless((number == 1) & (quantity > 45), delay.cast("double")).alias("delay"),
        ((F.col("l_returnflag") == "R") & (quantity <= 5)).cast("int").alias("cancelled"),
        ((F.col("l_tax") > 0.075) & (F.col("l_linestatus") == "F")).cast("int").alias("diverted"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and labelled legs with the two columns to impute."""
    return clean_legs(legs(spark, sf_dir), ROLES, START_YEAR, PERIODS, extra=IMPUTED)


def as_flights(df: DataFrame) -> DataFrame:
    """Legs under the column names of the raw flight file; columns legs lack are null."""
    known = {
        "year": "year", "month": "month", "day": "day", "dayofweek": "dayofweek",
        "airline": "carrier", "origin_airport_id": "origin_id", "dest_airport_id": "dest_id",
        "departure_delay": "delay", "departure_delay_mins": "delay", "taxi_out": "taxi_out",
        "scheduled_elapsed_time": "sched_elapsed", "air_time": "air_time", "distance": "distance",
        "cancelled": "cancelled", "diverted": "diverted", "crsdeptime": "sched_hhmm",
    }
    return df.select(*[
        (F.col(known[name]) if name in known else F.lit(None)).cast(kind).alias(name)
        for name, kind in RAW_TYPES.items()
    ])
