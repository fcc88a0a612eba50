"""Hard negatives by a vertical scan with shrinking bounds (BOND).

Vectors are scaled to whole numbers and cut into cells of some ``CELL`` rows that lie together
by label; anchors are cut into groups in the same way. A task gets one cell and one group. It
holds the cell by columns and reads, for each anchor, the dimensions in the order of the
anchor's magnitudes. The least and greatest value of each column bound what the unread
dimensions can still add, so each row has a lower and an upper bound of its score; rows whose
bounds miss every window, or stay below as many sure rows as are asked for, leave the
candidates. What is left when all dimensions are read has its exact score.

Two rounds are made: the first finds the positives of each anchor, which stand in the cells of
its own label only; the second finds the negatives in the score windows that the positives
open, in all cells. A cell and a group are bounded however many rows one label has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.llm.frames import kept, split_join, with_totals

#: Rows of a cell and anchors of a group, on average.
CELL, GROUP = 2048, 1024
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Doubles hold whole numbers below the first exactly; longs have room for hundredths of the second.
EXACT, LIMIT = 1 << 53, 1 << 55


def scan(columns: np.ndarray, least: np.ndarray, most: np.ndarray, anchor: np.ndarray, windows: list[tuple], first: int):
    """(indices, scores) of the rows that can be among the ``first`` of a window (low, high) of scores.

    ``columns`` has a row for each dimension; ``least`` and ``most`` bound each. Scores are
    exact; of equal scores at the edge all are given.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    sides = np.stack([anchor * least, anchor * most])[:, order]
    rest = [np.concatenate([np.cumsum(s[::-1])[::-1], [0]]) for s in (sides.min(0), sides.max(0))]
    alive = np.arange(columns.shape[1])
    score = np.zeros(len(alive), columns.dtype)
    for at in range(0, len(order), STEP):
        dims = order[at:at + STEP]
        part = columns[dims] if len(alive) == columns.shape[1] else columns[np.ix_(dims, alive)]
        score += anchor[dims] @ part
        read = at + len(dims)
        lower, upper = score + rest[0][read], score + rest[1][read]
        stays = np.zeros(len(alive), bool)
        for low, high in windows:
            able = (upper >= low) & (lower <= high)
            sure = lower[(lower >= low) & (upper <= high)]
            if len(sure) > first:
                able &= upper >= np.partition(sure, -first)[-first]
            stays |= able
        if not stays.all():
            alive, score = alive[stays], score[stays]
        if not len(alive):
            break
    return alive, score


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    """The vectors of ``table`` as rows of one array."""
    values = table.column(column).combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 0), flat.dtype)


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


class _Cell:
    """The rows of one cell by columns, of some labels or of all but one."""

    def __init__(self, rows: pa.Table):
        self.ids, self.marks, self.labels = (_numbers(rows, c) for c in ("vec_id", "mark", "label"))
        self.values = _matrix(rows, "vector")
        self.known: dict = {}

    def part(self, label: int, same: bool, kind) -> tuple:
        """(indices, columns, least, most) of the rows that have the label, or have not."""
        if label not in self.known:
            at = np.flatnonzero((self.labels == label) == same)
            columns = np.ascontiguousarray(self.values[at].T).astype(kind)
            self.known[label] = at, columns, columns.min(1, initial=0), columns.max(1, initial=0)
        return self.known[label]

    def first(self, found: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
        """Which of the rows ``found`` come first by score, then by vec_id."""
        return np.lexsort((self.marks[found], self.ids[found], -score))[:count]


def _kind(top: int, dims: int) -> type:
    """The number type in which scores of values up to ``top`` are exact."""
    if top * top * max(dims, 1) >= LIMIT:
        raise ValueError("vector components are too large for whole scores")
    return np.float64 if top * top * max(dims, 1) < EXACT else np.int64


_FOUND = "anchor_id long, anchor_mark long, positive_id long, positive_score long, vec_id long, mark long, score long"


def _tiles(rows: DataFrame, anchors: DataFrame, same: bool, first: int, kind: type) -> DataFrame:
    """``_FOUND`` rows of every tile; ``anchors`` carry their windows as a list."""

    def work(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in range(7)]
        cell = _Cell(mine)
        if mine.num_rows and theirs.num_rows:
            vectors = _matrix(theirs, "vector").astype(kind)
            owners = zip(*(_numbers(theirs, c).tolist() for c in ("vec_id", "mark", "label")), theirs.column("windows").to_pylist())
            for vector, (id_, mark, label, windows) in zip(vectors, owners):
                at, columns, least, most = cell.part(label, same, kind)
                if not len(at):
                    continue
                # one more where the anchor itself is among the rows
                alive, score = scan(columns, least, most, vector, [(w["low"], w["high"]) for w in windows], first + same)
                alive, score = at[alive], score.astype(np.int64)
                if same:
                    other = (cell.ids[alive] != id_) | (cell.marks[alive] != mark)
                    alive, score = alive[other], score[other]
                for w in windows:
                    inside = np.flatnonzero((score >= w["low"]) & (score <= w["high"]))
                    inside = inside[cell.first(alive[inside], score[inside], first)]
                    met = alive[inside]
                    ours = [np.full(len(met), v, np.int64) for v in (id_, mark, w["positive_id"], w["positive_score"])]
                    for column, value in zip(out, (*ours, cell.ids[met], cell.marks[met], score[inside])):
                        column.append(value)
        names = [f.split()[0] for f in _FOUND.split(", ")]
        return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for n, c in zip(names, out)})

    tile = ("cell", "group")
    return rows.groupBy(*tile).cogroup(anchors.groupBy(*tile)).applyInArrow(work, _FOUND)


def _ranked(found: DataFrame, keys: list[str], first: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "mark")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= first)


def _vectors(rows: DataFrame, is_anchor: Column, scale: float) -> DataFrame:
    """(vec_id, label, vector, anchor) of the rows that take part, whole-numbered."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return (
        rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale))).alias("vector"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        )
        .withColumn("mark", F.xxhash64("label", "vector"))
    )


def _hundredths(value: str) -> str:
    """The whole hundredths of a long, rounded down, as an expression."""
    return f"(({value}) - pmod({value}, 100L)) div 100"


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: float = 256.0,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` have vec_id, label and embedding; ``is_anchor`` says which are anchors. Components
    are scaled and rounded down; a score is the inner product with the anchor, in whole
    numbers. The ``positives`` of an anchor are the first other rows of its label; for each,
    the first ``negatives`` rows of other labels are given whose score is from ``low`` to
    ``high`` hundredths of the positive's. Higher scores come first, ties by vec_id.

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no
    part. Shorter vectors count as filled up with zeros, empty ones as all zero. Rows alike in
    vec_id, label and vector count once; rows that share a vec_id only are rows of their own.
    Other columns are not read. Components whose scores could pass 55 bits are refused.
    """
    source = _vectors(rows, is_anchor, scale)
    top = F.array_max(F.transform("vector", F.abs))
    stats = source.agg(F.max(F.size("vector")), F.min(F.size("vector")), F.max(top)).first()
    dims, fewest, most = (int(x or 0) for x in stats)
    kind = _kind(most, dims)
    stored = "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "bigint"
    if fewest < dims:
        more = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("vector"))
        source = source.withColumn("vector", F.concat("vector", more))
    source = source.withColumn("vector", F.col("vector").cast(f"array<{stored}>"))
    if not source.groupBy("vec_id", "mark").count().filter("count > 1").isEmpty():
        source = source.dropDuplicates(["vec_id", "mark"])

    # a place in the order of labels for each row, without sorting rows: cells of equal size
    counts = source.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("long")).alias("m"))
    counts = kept(counts, "labels")
    labels = with_totals(with_totals(counts, ["label"], "n", "before"), ["label"], "m", "ahead")
    labels = kept(
        labels.select(
            "label", "n", "before", "m", "ahead",
            F.expr(f"before div {CELL}").alias("first_cell"), F.expr(f"(before + n - 1) div {CELL}").alias("last_cell"),
            F.expr(f"ahead div {GROUP}").alias("first_group"), F.expr(f"(ahead + m - 1) div {GROUP}").alias("last_group"),
        ), "places")
    sums = labels.agg(F.sum("n"), F.sum("m")).first()
    cells, groups = -(-int(sums[0] or 0) // CELL), -(-int(sums[1] or 0) // GROUP)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not groups:
        return rows.sparkSession.createDataFrame([], result)
    placed = kept(
        split_join(source, labels, "label", "n")
        .withColumn("cell", F.expr(f"(before + pmod(xxhash64(vec_id, mark), n)) div {CELL}"))
        .withColumn("group", F.expr(f"CASE WHEN anchor THEN (ahead + pmod(xxhash64(vec_id, mark), m)) div {GROUP} END")),
        "cells",
    )
    row = ["vec_id", "mark", "label", "vector"]
    # columns of their own, as both sides of a cogroup come from one table
    asking = placed.filter("anchor").select(
        *(F.col(c).alias(c) for c in (*row, "group", "first_cell", "last_cell"))
    )
    # the first round has one window for all scores; its positive is not named yet
    all_scores = F.array(F.struct(*(F.lit(v).cast("long").alias(n) for n, v in (
        ("positive_id", 0), ("positive_score", 0), ("low", -LIMIT), ("high", LIMIT),
    ))))
    near = _tiles(
        placed.filter("m > 0").select(*row, "cell", F.explode(F.sequence("first_group", "last_group")).alias("group")),
        asking.select(*row, all_scores.alias("windows"), F.explode(F.sequence("first_cell", "last_cell")).alias("cell"), "group"),
        True, positives, kind,
    )
    anchor = ["anchor_id", "anchor_mark"]
    # a window without a whole number in it is empty; so is every one of a negative score
    window = F.struct(
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr(f"-({_hundredths(f'{-low}L * score')})").alias("low"),
        F.expr(_hundredths(f"{high}L * score")).alias("high"),
    )
    chosen = _ranked(near, anchor, positives).select(*anchor, window.alias("w")).filter("w.low <= w.high")
    windows = kept(chosen.groupBy(*anchor).agg(F.array_sort(F.collect_list("w")).alias("windows")), "windows")
    ready = asking.join(windows, (asking["vec_id"] == windows["anchor_id"]) & (asking["mark"] == windows["anchor_mark"]))
    far = _tiles(
        placed.select(*row, "cell", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("group")),
        ready.select(*row, "windows", F.explode(F.expr(f"sequence(0L, {cells - 1}L)")).alias("cell"), "group"),
        False, negatives, kind,
    )
    return _ranked(far, [*anchor, "positive_id", "positive_score"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
