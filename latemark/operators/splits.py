"""Train, validation and test parts that depend on row content only.

None of these moves rows: each part is a filter over the input. A digest costs more than all
else here; rows that are split in several passes may carry its place (:func:`content_position`)
in a column, named by ``position``, and digests are then taken of a few rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.functions.hashing import POSITIONS, content_digest, digest_position

_DIGEST, _POSITION, _CELL = "_digest", "_position", "_cell"


@dataclass(frozen=True)
class TemporalSplit:
    train: DataFrame
    test: DataFrame
    first_test_year: int


def _check_ratio(ratio: float) -> None:
    if not 0.0 < ratio < 1.0:
        raise ValueError(f"ratio must lie strictly between 0 and 1, got {ratio}")


def temporal_split(
    df: DataFrame, year: str = "year", ratio: float = 0.8, years: Sequence[int] | None = None
) -> TemporalSplit:
    """Earlier years for training, later ones for testing.

    With n years in order, the first ``max(1, int(n * ratio))`` are training years. Only
    the list of years reaches the driver; pass ``years`` if they are known already.
    """
    _check_ratio(ratio)
    if years is None:
        years = [r[0] for r in df.select(year).filter(F.col(year).isNotNull()).distinct().collect()]
    years = sorted(set(years))
    cut = max(1, int(len(years) * ratio))
    if cut >= len(years):
        raise ValueError(f"{len(years)} year(s) of data cannot be split into train and test")
    first = years[cut]
    return TemporalSplit(df.filter(F.col(year) < first), df.filter(F.col(year) >= first), first)


def content_position(columns: Sequence[str], seed: int) -> Column:
    """Place in [0, 2^32) that the content of a row gives it."""
    return digest_position(content_digest(columns, seed))


def _positioned(df: DataFrame, seed: int, columns: Sequence[str] | None, position: str | None = None) -> Column:
    if position:
        return F.col(position)
    return content_position(columns or df.columns, seed)


def _contents(df: DataFrame, columns: Sequence[str] | None, position: str | None) -> list[str]:
    return list(columns or [c for c in df.columns if c != position])


def _bounds(shares: dict[str, float]) -> list[tuple[str, int, int]]:
    if abs(sum(shares.values()) - 1.0) > 1e-9 or min(shares.values()) <= 0:
        raise ValueError(f"shares must be positive and add up to 1, got {shares}")
    bounds, low, reached = [], 0, 0.0
    for index, (name, share) in enumerate(shares.items()):
        reached += share
        high = POSITIONS if index == len(shares) - 1 else int(reached * POSITIONS)
        bounds.append((name, low, high))
        low = high
    return bounds


def mark_parts(
    df: DataFrame, shares: dict[str, float], seed: int, columns: Sequence[str] | None = None,
    output: str = "part",
) -> DataFrame:
    """Add the name of the part each row belongs to, sized by ``shares`` (adding up to one).

    A row goes where its content hash falls, whatever file or partition it came from.
    Copies of a row always land together, so none leaks from one part to another.
    """
    held, taken = _DIGEST, {name.lower() for name in (*df.columns, output)}
    while held in taken:
        held = f"_{held}"
    (last, _, _), *others = reversed(_bounds(shares))
    part = F.lit(last)
    for name, _, high in others:
        # digests are in the order of their places, so that none has to be turned into a number
        below = F.col(held) < f"{high:08x}" if high < POSITIONS else F.lit(True)
        part = F.when(below, F.lit(name)).otherwise(part)
    # a column of its own, so that the digest is not taken again for every bound
    placed = df.withColumn(held, content_digest(columns or df.columns, seed))
    return placed.withColumn(output, part).drop(held)


def hash_parts(
    df: DataFrame, shares: dict[str, float], seed: int, columns: Sequence[str] | None = None,
    position: str | None = None,
) -> dict[str, DataFrame]:
    """Disjoint frames covering every row; rows are placed as in :func:`mark_parts`."""
    place = _positioned(df, seed, columns, position)

    def inside(low: int, high: int) -> Column:
        # the ends of the range need no test, which saves computing the digest twice
        tests = [place >= low] * (low > 0) + [place < high] * (high < POSITIONS)
        return reduce(lambda a, b: a & b, tests or [F.lit(True)])

    return {name: df.filter(inside(low, high)) for name, low, high in _bounds(shares)}


def hash_split(
    df: DataFrame, ratio: float, seed: int, columns: Sequence[str] | None = None,
    position: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Two-way :func:`hash_parts`: (train, test)."""
    _check_ratio(ratio)
    parts = hash_parts(df, {"train": ratio, "test": 1.0 - ratio}, seed, columns, position)
    return parts["train"], parts["test"]


def stratified_sample(
    df: DataFrame,
    label: str,
    fractions: dict[int, float],
    seed: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Bernoulli sample with one rate per label value; labels not named are left out."""
    limit = F.lit(None).cast("bigint")
    for value, fraction in fractions.items():
        if not 0.0 <= fraction <= 1.0:
            raise ValueError(f"fraction of {value!r} must lie in [0, 1], got {fraction}")
        limit = F.when(F.col(label) == value, F.lit(int(fraction * POSITIONS))).otherwise(limit)
    return df.filter(_positioned(df, seed, columns) < limit)


def stratified_split(
    df: DataFrame,
    label: str,
    test_share: float,
    seed: int,
    columns: Sequence[str] | None = None,
    cell_bits: int = 16,
    position: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as told by :func:`stratified_test`."""
    in_test = stratified_test(df, label, test_share, seed, columns, cell_bits, position)
    return df.filter(~in_test), df.filter(in_test)


def stratified_test(
    df: DataFrame,
    label: str,
    test_share: float,
    seed: int,
    columns: Sequence[str] | None = None,
    cell_bits: int = 16,
    position: str | None = None,
) -> Column:
    """Whether a row of ``df`` is a test row, with exactly ``round(n * test_share)`` test rows of every label.

    Test rows are those with the smallest content digests of their label. The digest to
    cut at is found without sorting a label: a histogram over the leading digest bits
    tells which cell holds the cut, and only that cell (one in 2^cell_bits) is ranked.
    Copies of one row stay together, so the count is exact up to the copies of the row
    at the cut.
    """
    _check_ratio(test_share)
    digest = content_digest(_contents(df, columns, position), seed)
    width = POSITIONS >> cell_bits
    place = F.col(position) if position else digest_position(F.col(_DIGEST))
    located = df.select("*", F.col(label).alias("_label"), digest.alias(_DIGEST)).withColumn(
        _CELL, F.floor(place / width).cast("int")
    )

    # per label: cells with their row counts, at most 2^cell_bits rows each
    cells = located.groupBy("_label", _CELL).agg(F.count(F.lit(1)).alias("_rows"))
    per_label = Window.partitionBy("_label")
    running = per_label.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.floor(F.sum("_rows").over(per_label) * F.lit(test_share) + 0.5).cast("bigint")
    cut_cells = (
        cells.select("_label", _CELL, "_rows", F.sum("_rows").over(running).alias("_upto"), wanted.alias("_wanted"))
        .filter((F.col("_upto") - F.col("_rows") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_upto")))
        .select("_label", _CELL, (F.col("_wanted") - F.col("_upto") + F.col("_rows")).alias("_take"))
    ).collect()  # one row per label

    if not cut_cells:
        return F.lit(False)
    cut_filter = F.lit(False)
    take = F.lit(None).cast("bigint")
    for row in cut_cells:
        here = F.col("_label") == row["_label"]
        cut_filter = cut_filter | (here & (F.col(_CELL) == row[_CELL]))
        take = F.when(here, F.lit(row["_take"])).otherwise(take)
    # copies of a row collapse before they are ranked
    candidates = located.filter(cut_filter).groupBy("_label", _DIGEST).agg(F.count(F.lit(1)).alias("_rows"))
    ordered = per_label.orderBy(_DIGEST).rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        candidates.select("_label", _DIGEST, "_rows", F.sum("_rows").over(ordered).alias("_upto"))
        .filter((F.col("_upto") >= take) & (F.col("_upto") - F.col("_rows") < take))
        .select("_label", _DIGEST)
    ).collect()  # one row per label

    last_test_digest, last_place = F.lit(""), F.lit(-1)
    for row in cuts:
        here = F.col(label) == row["_label"]
        last_test_digest = F.when(here, F.lit(row[_DIGEST])).otherwise(last_test_digest)
        last_place = F.when(here, F.lit(int(row[_DIGEST][:8], 16))).otherwise(last_place)
    if not position:
        return digest <= last_test_digest
    # digests are in the order of their places; only rows at the place of the cut need theirs
    return F.when(F.col(position) != last_place, F.col(position) < last_place).otherwise(digest <= last_test_digest)
