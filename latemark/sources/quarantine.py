"""One pass over raw files that sets apart the rows that do not fit their schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latemark.session import remove_paths, scratch_path
from latemark.sources.legs import MISSING_MARK, PARSED_AS, RAW_TYPES, _typed, bound_columns

#: in ``misfits``, the name for a line with too many or too few entries
WHOLE_LINE = "*"


@dataclass
class Quarantine:
    """Rows of raw files, sorted into those that fit and those that do not.

    ``accepted`` has the typed columns. ``rejected`` has the same columns, null where an entry
    does not fit, and ``file``, ``line`` (the entries in file order, as CSV) and ``misfits``: an
    array of (column, entry). All frames read the table written at ``path``.
    """

    accepted: DataFrame
    rejected: DataFrame
    path: str

    def misfits(self) -> DataFrame:
        """(file, column, entry, line): one row per entry that does not fit."""
        return self.rejected.select("file", F.explode("misfits").alias("m"), "line").select("file", "m.column", "m.entry", "line")

    def counts(self) -> DataFrame:
        """(file, column, rows) from the rejected rows alone."""
        return self.misfits().groupBy("file", "column").agg(F.count(F.lit(1)).alias("rows"))

    def discard(self, spark: SparkSession) -> None:
        remove_paths(spark, [self.path])


def quarantined_legs(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    types: dict[str, str] | None = None,
    strict: bool = False,
) -> Quarantine:
    """Read like :func:`read_legs`, but keep rows that do not fit apart, with file and reason.

    The files are scanned once: a row is typed, judged and written where it is, to one of two
    folders below the shared folder, and nothing is shuffled. A row is rejected if an asked-for
    entry is there and does not fit its type, or if its line has not as many entries as the
    header. Missing entries are no misfits. The line's text is written for rejected rows only.
    """
    types = RAW_TYPES if types is None else types
    by_name, wanted = bound_columns(spark, path, columns, types, strict)
    broken = _unused("_broken", by_name.values())
    schema = T.StructType([T.StructField(written, T.StringType()) for written in by_name.values()])
    raw = (
        spark.read.option("header", True).option("enforceSchema", False).option("nullValue", MISSING_MARK)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken)
        # every entry is needed to see that a line has too few
        .option("columnPruning", False)
        .schema(schema.add(broken, T.StringType())).csv([path] if isinstance(path, str) else list(path))
    )

    def entry(name: str):
        return F.col(f"`{by_name[name]}`")

    def fitted(name: str):
        kind = types.get(name, "string")
        if kind == "string":
            return entry(name)
        return _typed(F.trim(entry(name)).try_cast(PARSED_AS.get(kind, kind)), kind)

    def misfit(name: str):
        wrong = F.struct(F.lit(name).alias("column"), entry(name).alias("entry"))
        return F.when(entry(name).isNotNull() & fitted(name).isNull(), wrong)

    checked = [misfit(c) for c in wanted if types.get(c, "string") != "string"]
    shape = F.when(F.col(broken).isNotNull(), F.struct(F.lit(WHOLE_LINE).alias("column"), F.col(broken).alias("entry")))
    whole = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in by_name.values()]), {"nullValue": MISSING_MARK})
    told = raw.select(
        *[fitted(c).alias(c) for c in wanted],
        F.col("_metadata.file_path").alias("file"),
        F.array_compact(F.array(shape, *checked)).alias("misfits"),
        F.coalesce(F.col(broken), whole).alias("line"),
    )
    bad = F.size("misfits") > 0
    sorted_out = told.withColumns({
        "rejected": bad.cast("int"), "line": F.when(bad, F.col("line")), "file": F.when(bad, F.col("file")),
    })
    kept_at = scratch_path(spark, "quarantine")
    sorted_out.write.partitionBy("rejected").parquet(kept_at)
    kept = spark.read.schema(sorted_out.schema).parquet(kept_at)
    return Quarantine(
        kept.filter(F.col("rejected") == 0).select(*wanted),
        kept.filter(F.col("rejected") == 1).select(*wanted, "file", "line", "misfits"),
        kept_at,
    )


def _unused(name: str, taken) -> str:
    taken = {t.lower() for t in taken}
    while name in taken:
        name += "_"
    return name
