"""Reading raw flight files with a checked schema, and staging them as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latemark.session import scratch_path

# Columns of the raw flight file, in file order, with their types.
RAW_TYPES: dict[str, str] = {
    "year": "int",
    "month": "int",
    "day": "int",
    "formatted_date": "string",
    "dayofweek": "int",
    "airline": "string",
    "flight_number": "string",
    "tail_number": "string",
    "origin_airport_id": "int",
    "iata_code_reporting_airline": "string",
    "dest_airport_id": "int",
    "departure_time_hhmm": "string",
    "departure_delay": "double",
    "departure_delay_mins": "double",
    "taxi_out": "double",
    "wheels_off_hhmm": "string",
    "scheduled_elapsed_time": "double",
    "elapsed_time": "double",
    "air_time": "double",
    "distance": "double",
    "wheels_on_hhmm": "string",
    "taxi_in": "double",
    "scheduled_arrival_hhmm": "string",
    "arrival_time_hhmm": "string",
    "arrival_delay": "double",
    "arrival_delay_mins": "double",
    "cancellation_code": "string",
    "cancelled": "int",
    "diverted": "int",
    "airline_delay": "double",
    "weather_delay": "double",
    "air_system_delay": "double",
    "security_delay": "double",
    "late_aircraft_delay": "double",
    "crs_dep_time_hhmm": "string",
    "crs_dep_time": "string",
    "crsdeptime": "int",
}

# Fixed value: how a missing entry is written in the raw files (an empty entry is one too).
MISSING_MARK = "NA"


#: Whole numbers are parsed by a type that also takes ``7.0``.
PARSED_AS = {"int": "double", "bigint": "decimal(38,6)"}


def _typed(parsed: Column, kind: str) -> Column:
    """A parsed whole number in its own type, null where it has a fraction or does not fit."""
    if kind not in PARSED_AS:
        return parsed
    return F.when(parsed == F.floor(parsed), parsed.try_cast(kind))


def malformed_entries(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """(column, entries, malformed): entries present and those that do not fit their type."""
    types = RAW_TYPES if types is None else types
    by_name = {written.strip().lower(): written for written in _header(spark, path)}
    wanted = [c for c in (columns or types) if c in by_name and types.get(c, "string") != "string"]
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.option("header", True).option("nullValue", MISSING_MARK).csv(paths)

    def bad(name: str) -> Column:
        entry, kind = F.trim(F.col(f"`{by_name[name]}`")), types[name]
        fits = _typed(entry.try_cast(PARSED_AS.get(kind, kind)), kind)
        return F.count_if(F.col(f"`{by_name[name]}`").isNotNull() & fits.isNull())

    counted = raw.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{by_name[c]}`")).alias("entries"), bad(c).alias("malformed")).alias(c)
        for c in wanted
    ])
    return counted.select(F.inline(F.array(*[F.col(f"`{c}`") for c in wanted])))


def _header(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names as written in the files; reads one line, infers nothing."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("header", True).option("inferSchema", False).csv(paths).columns


def bound_columns(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None, types: dict[str, str], strict: bool
) -> tuple[dict[str, str], list[str]]:
    """(name as written by canonical name, in file order; names asked for), checked against the header."""
    header = _header(spark, path)
    by_name: dict[str, str] = {}
    for written in header:
        canonical = written.strip().lower()
        if canonical in by_name:
            raise ValueError(f"column {canonical!r} appears twice in the header")
        by_name[canonical] = written
    wanted = [c.lower() for c in columns] if columns else [c for c in types if c in by_name]
    needed = set(wanted) | (set(types) if strict else set())
    missing = sorted(needed - set(by_name))
    if missing:
        raise ValueError(f"columns missing from {path}: {', '.join(missing)}")
    return by_name, wanted


def read_legs(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
    strict: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan header-first CSV files into canonical lower-case columns.

    Columns are bound by the names in the header, in any order and any case. Files of
    one call whose headers disagree fail instead of being read shifted. A whole number
    may be written with a decimal point (``7.0``). Entries that do not fit their type become
    null, and the whole line is kept in ``corrupt_column`` when one is named;
    :func:`malformed_entries` counts them.

    ``strict`` asks for every known column to be present; otherwise only ``columns``
    (default: all known ones found in the header) are needed.
    """
    types = RAW_TYPES if types is None else types
    by_name, wanted = bound_columns(spark, path, columns, types, strict)
    schema = T.StructType([
        T.StructField(written, T.DataType.fromDDL(PARSED_AS.get(kind := types.get(canonical, "string"), kind)), True)
        for canonical, written in by_name.items()
    ])
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", MISSING_MARK)
        .option("mode", "PERMISSIVE")
    )
    if corrupt_column:
        schema = schema.add(corrupt_column, T.StringType(), True)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    raw = reader.schema(schema).csv([path] if isinstance(path, str) else list(path))
    picked = [_typed(F.col(f"`{by_name[c]}`"), types.get(c, "string")).alias(c) for c in wanted]
    return raw.select(*picked, *([corrupt_column] if corrupt_column else []))


def stage_legs(df: DataFrame, path: str, partition_column: str = "year") -> None:
    """Write legs as Parquet, one folder per year.

    The rebalance hint lets adaptive execution cut a heavy year into several files and
    merge light ones, so neither one huge writer task nor millions of small files arise.
    Later runs get column pruning, row-group skipping and year pruning from it.
    """
    (
        df.hint("rebalance", F.col(partition_column))
        .write.mode("overwrite").partitionBy(partition_column).parquet(path)
    )


def read_staged(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def restaged(df: DataFrame, name: str = "legs", partition_column: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and go on from there.

    For rows that several passes read: each pass then scans only its columns, and nothing
    before the write is ever done again, whichever executors are lost. Rows are written
    where they are; a ``partition_column`` pays only if later passes filter by it, and
    costs a shuffle.
    """
    path = scratch_path(df.sparkSession, name)
    if partition_column is None:
        df.write.parquet(path)
    else:
        stage_legs(df, path, partition_column)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
