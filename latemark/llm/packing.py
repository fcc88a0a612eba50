"""Packing of token sequences into windows by non-negative least squares.

Documents become token ids with an end id; whole windows are cut off first, what is left of
each is a tail. Tails are counted by length in steps of ``STEP`` tokens. All multisets of up to
``DEPTH`` steps that fill a window are enumerated, and non-negative least squares finds how
often to use each so that together they match the histogram. Rounded counts that the
histogram can serve are taken, and what is left is packed greedily, longest first, still on
the histogram. Only the histogram and the plan, both bounded by the window, are on the
driver; tails get their place by their rank among those of their length.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latemark.llm.frames import kept, map_batches, whole, with_totals
from latemark.llm.word_codes import WordCoder, agrees, ranks_of

WINDOW = 2048
STEP = 8
DEPTH = 3
END_ID = 1
CACHE = 300_000


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of all pieces, and their ``ids`` if asked for.

    White space ends a word in this tokenizer, so words are encoded once per task and the
    ids of a text are those of its words in a row. A null text counts as empty: its only
    piece is the end id.
    """

    fast = agrees(*ranks_of(tokenizer))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        coder = WordCoder(tokenizer, fast)
        known: dict[bytes, bytes] = {}
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                words = text.split()
                new = list({w for w in words if w not in known})
                if len(known) + len(new) > CACHE:
                    known.clear()
                    new = list(set(words))
                for at in range(0, len(new), 1 << 16):
                    part = new[at:at + (1 << 16)]
                    known.update(zip(part, coder.codes(part)))
                body = b"".join(map(known.__getitem__, words)) + end
                total = len(body) // 4
                for start in range(0, total, window):
                    piece = body[4 * start:4 * (start + window)]
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total, piece)):
                        column.append(value)
            arrays = [pa.array(c, pa.int64()) for c in out[:5]] + ([pa.array(out[5], pa.binary())] if ids else [])
            yield pa.RecordBatch.from_arrays(arrays, names=NAMES[:len(arrays)])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if ids else "")
    return map_batches(docs.select(F.col("doc_id").cast("long"), whole().alias("text")), work, schema)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]


def combinations(total: int, depth: int, most: int | None = None) -> list[tuple[int, ...]]:
    """All falling tuples of at most ``depth`` numbers from 1 up that add up to ``total``."""
    most = min(total, most or total)
    if depth == 1:
        return [(total,)] if 1 <= total <= most else []
    found = [(total,)] if total <= most else []
    for first in range(min(most, total - 1), -(-total // depth) - 1, -1):
        found += [(first, *rest) for rest in combinations(total - first, depth - 1, first)]
    return found


def least_squares(matrix: np.ndarray, wanted: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 of least ``|matrix @ x - wanted|``, by the active sets of Lawson and Hanson."""
    rows, columns = matrix.shape
    answer, active = np.zeros(columns), np.zeros(columns, bool)
    scale = max(1.0, float(np.abs(wanted).max(initial=0)))
    for _ in range(3 * rows):
        gain = matrix.T @ (wanted - matrix @ answer)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance * scale:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            part = matrix[:, chosen]
            tried = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(chosen)), part.T @ wanted)
            if tried.min() > 0:
                answer[:] = 0
                answer[chosen] = tried
                break
            before = answer[chosen]
            low = tried <= 0
            step = float(np.min(before[low] / (before[low] - tried[low])))
            answer[chosen] = before + step * (tried - before)
            gone = chosen[low & (answer[chosen] <= tolerance * scale)]
            if not len(gone):
                gone = chosen[low][[int(np.argmin(answer[chosen][low]))]]
            active[gone] = False
            answer[gone] = 0
            if not active.any():
                break
    return answer


def plan(histogram: dict[int, int], total: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(steps of a window, how often): uses every count of the histogram exactly once."""
    left = np.zeros(total + 1, np.int64)
    for step, count in histogram.items():
        left[step] = count
    if not left.sum():
        return []
    shapes = combinations(total, depth)
    matrix = np.zeros((total, len(shapes)))
    for column, shape in enumerate(shapes):
        for step in shape:
            matrix[step - 1, column] += 1
    times = np.rint(least_squares(matrix, left[1:].astype(float))).astype(np.int64)
    chosen: list[tuple[tuple[int, ...], int]] = []

    def take(shape: tuple[int, ...], most: int) -> None:
        need = np.bincount(shape, minlength=total + 1)
        used = need > 0
        most = int(min(most, (left[used] // need[used]).min()))
        if most > 0:
            left[:] -= most * need
            chosen.append((shape, most))

    for column in np.argsort(-times, kind="stable"):
        if times[column] > 0:
            take(shapes[column], int(times[column]))
    while left.any():
        room, shape, free = total, [], left.copy()
        while room and (fits := np.flatnonzero(free[1:room + 1])).size:
            step = int(fits[-1]) + 1
            count = min(room // step, int(free[step]))
            shape += [step] * count
            room -= step * count
            free[step] -= count
        take(tuple(shape), int(left.max()))
    return chosen


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` (from 0, no gaps) and ``offset`` (no gaps within a sequence).

    Every id of every row lies in one piece and no sequence is longer than ``window``.
    Repeated rows give pieces of their own; null ids stay null. An empty table gives none.
    Columns other than doc_id and text are not read.
    """
    cut = kept(pieces(docs, tokenizer, window, ids), "pieces").withColumn("__row", F.monotonically_increasing_id())
    total = window // STEP
    # whole windows are a step of their own, above all tails
    step = F.when(F.col("length") == window, total + 1).otherwise(F.ceil(F.col("length") / STEP)).cast("int")
    stepped = cut.withColumn("__step", step).withColumn("__one", F.lit(1).cast("long"))
    counts = {r[0]: r[1] for r in stepped.groupBy("__step").count().collect()}  # total + 1 rows at most
    full = counts.pop(total + 1, 0)
    slots, base, used = [(total + 1, 0, full, 0, 0)], full, dict.fromkeys(counts, 0)
    for shape, times in plan(counts, total):
        for at, one in enumerate(shape):
            slots.append((one, used[one], used[one] + times, base, at))
            used[one] += times
        base += times
    before, offsets = 0, []
    for one in [*sorted(counts), total + 1]:
        offsets.append((one, before))
        before += counts.get(one, full if one == total + 1 else 0)
    spark = docs.sparkSession
    places = spark.createDataFrame(slots, "__step int, __low long, __high long, __base long, __at int")
    starts = spark.createDataFrame(offsets, "__step int, __start long")
    ranked = with_totals(stepped, ["__step", "doc_id", "start", "__row"], "__one", "__number")
    rank = F.col("__number") - F.col("__start")
    placed = (
        ranked.join(F.broadcast(starts), "__step").withColumn("__rank", rank)
        .join(F.broadcast(places), "__step")
        .filter((F.col("__rank") >= F.col("__low")) & (F.col("__rank") < F.col("__high")))
        .withColumn("sequence_id", F.col("__base") + F.col("__rank") - F.col("__low"))
    )
    earlier = Window.partitionBy("sequence_id").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long"))
    return placed.select(*NAMES[:5 + ids], "sequence_id", "offset")
