"""Exact removal of repeated stretches of text, by suffix sorting of what may repeat.

Windows of ``window`` bytes are cut into segments at content-defined anchors (see anchors),
so equal windows lie in segments of the same anchor hash. Segments that repeat whole are
known by their hash: within a batch at once, across batches after one shuffle by anchor.
Segments that share an anchor but differ go to shards by their anchor, where all suffixes are
sorted by induced sorting (see induced) and neighbours in that order with a common prefix of a
window are repeats. An anchor with very many different segments is not sorted: its windows are
compared by 128-bit hashes, equal ones within a partition merged before they are shuffled, so
no task gathers them however many documents hold a passage.

Only hashes and places are shuffled for segments that stand once; the text of a document is
fetched once for the segments to sort and once to cut what repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from latemark.llm.anchors import segments
from latemark.llm.frames import extended, forget, free, kept, map_batches, quoted, whole, with_totals
from latemark.llm.induced import repeats

GRAM = 48
#: Different segments of one anchor above which its windows are compared by hashes.
CROWD = 2000
#: Different windows of crowded anchors that a task merges at a time.
MERGED = 1 << 17
#: Bytes sorted at once; anchors are not divided.
SHARD = 256 << 10
NO_ID = -(1 << 63)


def _packed(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> np.ndarray:
    return first << 16 | (last - first) << 8 | (place - first)


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, segment, n, id, spot) of all segments; those repeated in a batch as marks, n = 0.

    A segment that a batch has more than once is a repeat, whatever else there is: each
    place gives a row with n = 0 and a key of its own, and one row with n = 2 tells others.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = list(segments(batch.column(1).cast(pa.binary()).to_pylist(), window, GRAM))
            if not found:
                continue
            index, anchor, segment, place, first, last = (np.concatenate(x) for x in zip(*found))
            spot, owner = _packed(first, last, place), ids[index]
            order = np.lexsort((segment, anchor))
            anchor, segment, spot, owner = anchor[order], segment[order], spot[order], owner[order]
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])])
            heads = np.flatnonzero(new)
            times = np.diff(np.concatenate([heads, [len(order)]]))
            repeated = np.repeat(times > 1, times)
            own = np.arange(len(order), dtype=np.uint64)[repeated]
            columns = [
                np.concatenate([anchor[heads], segment[repeated] ^ (own * np.uint64(0x9E3779B97F4A7C15))]).view(np.int64),
                np.concatenate([segment[heads], segment[repeated]]).view(np.int64),
                np.concatenate([np.minimum(times, 2), np.zeros(len(own), np.int64)]),
                np.concatenate([owner[heads], owner[repeated]]),
                np.concatenate([spot[heads], spot[repeated]]),
            ]
            for at in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[at:at + (1 << 16)]) for c in columns], names=["anchor", "segment", "n", "id", "spot"]
                )

    return map_batches(texts, work, "anchor long, segment long, n long, id long, spot long")


def _fetched(wanted: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """(shard, crowd, id, start, pending, piece) of the wanted segments, in one pass over the texts."""
    asked = wanted.groupBy("id").agg(F.collect_list(F.struct("anchor", "crowd", "spot", "pending")).alias("asked"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            size = 0
            columns = (batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist())
            for id_, text, asked in zip(*columns):
                for ask in asked:
                    first = ask["spot"] >> 16
                    piece = text[first:first + (ask["spot"] >> 8 & 0xFF) + window]
                    size += len(piece)
                    for column, value in zip(out, (ask["anchor"], ask["crowd"], id_, first, ask["pending"], piece)):
                        column.append(value)
                    if size > 8 << 20:
                        yield _pieces(out)
                        out, size = ([], [], [], [], [], []), 0
            if out[0]:
                yield _pieces(out)

    return map_batches(texts.join(asked, "id").select("id", "text", "asked"), work, PIECES)


PIECES = "shard long, crowd boolean, id long, start long, pending boolean, piece binary"


def _pieces(out: tuple[list, ...]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(out, kinds)], names=[f.split()[0] for f in PIECES.split(", ")]
    )


def _crowded_repeats(pieces: DataFrame, window: int) -> DataFrame:
    """(id, first, last): window starts of pending pieces of crowded anchors that repeat.

    A window that a task meets again is a repeat, whatever else there is: both places give a
    row with n = 0, and the window goes on once with n = 2 to tell other tasks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, list] = {}  # window -> times up to 2, id, start, pending
        marks: list[tuple] = []

        def told(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            columns = list(zip(*rows)) if rows else [()] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "n", "id", "start", "pending"]
            )

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = [(key, *one) for key, one in met.items()]
            for at in range(0, len(rows), 1 << 15):
                yield told(rows[at:at + (1 << 15)])
            met.clear()

        for batch in batches:
            for anchor, id_, first, pending, piece in zip(*(c.to_pylist() for c in batch.columns)):
                for at in range(len(piece) - window + 1):
                    key = xxhash.xxh3_128_digest(piece[at:at + window], anchor & 0xFFFFFFFFFFFFFFFF)
                    one = met.get(key)
                    if one is None:
                        met[key] = [1, id_, first + at, pending]
                        continue
                    one[0] = 2
                    if one[3]:
                        marks.append((None, 0, one[1], one[2], True))
                        one[3] = False
                    if pending:
                        marks.append((None, 0, id_, first + at, True))
                if len(marks) > 1 << 15:
                    yield told(marks)
                    marks = []
                if len(met) > MERGED:
                    yield from flushed()
        yield told(marks)
        yield from flushed()

    rows = pieces.select("shard", "id", "start", "pending", "piece")
    windows = kept(map_batches(rows, work, "key binary, n long, id long, start long, pending boolean"), "windows")
    same = Window.partitionBy("key")
    later = windows.filter("n > 0").withColumn("times", F.sum("n").over(same)).filter("pending and times > 1")
    found = windows.filter("n = 0").select("id", "start").unionByName(later.select("id", "start"))
    found = kept(found.select("id", F.col("start").alias("first"), F.col("start").alias("last")), "crowds")
    forget(windows)
    return found


def _sorted_repeats(pieces: DataFrame, window: int, memory: int) -> DataFrame:
    """(id, first, last): runs of repeated window starts of the pending pieces.

    No anchor has more than ``CROWD`` pieces here, so rows gathered for one sort are bounded.
    """

    def solved(rows: list) -> pa.RecordBatch:
        ids, firsts, lasts = [], [], []
        for (_, id_, start, pending, _), mask in zip(rows, repeats([r[4] for r in rows], window, memory)):
            if pending and mask.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                for a, b in zip(edges[::2], edges[1::2]):
                    ids.append(id_)
                    firsts.append(start + int(a))
                    lasts.append(start + int(b) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (ids, firsts, lasts)], names=["id", "first", "last"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD and row[0] != rows[-1][0]:
                    yield solved(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solved(rows)

    dealt = pieces.select("shard", "id", "start", "pending", "piece").repartition("shard").sortWithinPartitions("shard")
    return map_batches(dealt, work, "id long, first long, last long")


def repeated_spans(texts: DataFrame, window: int = 200, memory: int = 64 << 20) -> DataFrame:
    """(id, first, last): window starts of kept ``texts`` (id unique unless alike, text) whose window repeats."""
    cut = _cut(texts.select("id", "text"), window)
    same, anchor = Window.partitionBy("anchor", "segment"), Window.partitionBy("anchor")
    known = F.col("n") > 0
    # marks have n = 0 and anchors of their own; one that meets another anchor changes nothing
    least = F.min(F.when(known, F.col("segment"))).over(anchor)
    most = F.max(F.when(known, F.col("segment"))).over(anchor)
    first = F.row_number().over(same.orderBy(F.desc("n"), "id", "spot"))
    judged = (
        cut.repartition("anchor")
        .withColumn("times", F.sum("n").over(same)).withColumn("differ", least != most)
        .withColumn("first", first == 1)
        # different segments; a task may send a segment that others send as well
        .withColumn("crowd", F.sum((known & F.col("first")).cast("int")).over(anchor) > CROWD)
        .filter((F.col("n") == 0) | (F.col("times") > 1) | F.col("differ"))
        .select(
            "anchor", "id", "spot", "crowd",
            ((F.col("n") == 0) | (F.col("times") > 1)).alias("repeated"),
            (F.col("differ") & known & F.col("first")).alias("wanted"),
        )
    )
    judged = kept(judged, "segments")
    start = F.shiftright("spot", 16)
    whole_spans = judged.filter("repeated").select(
        "id", start.alias("first"), (start + F.shiftright("spot", 8).bitwiseAND(F.lit(255))).alias("last")
    )
    wanted = judged.filter("wanted").select("anchor", "id", "spot", "crowd", (~F.col("repeated")).alias("pending"))
    pieces = kept(_fetched(wanted, texts, window), "pieces")
    found = kept(_sorted_repeats(pieces.filter("not crowd"), window, memory), "repeats")
    many = pieces.filter("crowd")
    if not many.isEmpty():
        found = found.unionByName(_crowded_repeats(many, window))
    forget(pieces)
    return whole_spans.unionByName(found)


def identified(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a long ``name`` that only rows alike in doc_id and text share.

    That is doc_id where no two rows have the same, else a number of the (doc_id, text).
    """
    counted = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if counted.filter((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty():
        return docs.withColumn(name, F.col("doc_id").cast("long"))
    key, hash_ = free(docs, "__key"), free(docs, "__h")
    keyed = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(hash_, F.xxhash64(whole()))
    classes = keyed.select(key, hash_).distinct().withColumn("__one", F.lit(1).cast("long"))
    numbers = kept(with_totals(classes, [key, hash_], "__one", name).drop("__one"), "ids")
    return kept(keyed.join(numbers, [key, hash_]).drop(key, hash_), "identified")


def runs(spans: list[dict], window: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows of the spans cover."""
    merged: list[tuple[int, int]] = []
    for first, end in sorted((s["first"], s["last"] + window) for s in spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((first, end))
    return merged


def without_repeats(docs: DataFrame, window: int = 200, memory: int = 64 << 20) -> DataFrame:
    """``docs`` with the bytes of repeated windows cut out of ``text``, and what was cut.

    Every byte covered by a string of ``window`` bytes that also starts anywhere else, in the
    same or another document, is removed; strings are judged on the input. Columns stay but
    for ``text``, which becomes the kept bytes read as UTF-8 without incomplete characters.
    Four columns are added, called as ``added_names`` says: bytes, bytes removed, maximal
    runs removed, and sha256 of the kept bytes. Null texts count as empty for these and stay
    null. Texts shorter than the window keep all. ``memory`` bounds the arrays of one sort
    before they go to files.
    """
    columns, names = docs.columns, added_names(docs)
    id_, found_ = free(docs, "__id"), free(docs, "__found")
    rows = identified(docs, id_)
    texts = rows.select(F.col(id_).alias("id"), whole().alias("text"))
    spans = repeated_spans(texts, window, memory).groupBy(F.col("id").alias(id_)).agg(
        F.collect_list(F.struct("first", "last")).alias(found_)
    )
    joined = rows.join(spans, id_, "left").select(*quoted(columns), found_)
    place, last = columns.index("text"), len(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results: tuple[list, ...] = ([], [], [], [], [])
            for text, found in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(last).to_pylist()):
                cuts = runs(found or [], window)
                body, at, left = text or b"", 0, []
                for first, end in cuts:
                    left.append(body[at:first])
                    at = end
                left.append(body[at:])
                rest = b"".join(left)
                whole_text = None if text is None else rest.decode("utf-8", "ignore")
                for column, value in zip(results, (
                    whole_text, len(body), len(body) - len(rest), len(cuts), hashlib.sha256(rest).hexdigest(),
                )):
                    column.append(value)
            arrays = list(batch.columns[:last])
            arrays[place] = pa.array(results[0], pa.string())
            arrays += [pa.array(c, k) for c, k in zip(results[1:], (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *names])

    kinds = ("long", "long", "long", "string")
    return map_batches(joined, work, extended(docs, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds))))


def added_names(docs: DataFrame) -> list[str]:
    """What ``without_repeats`` calls its columns, apart from those of ``docs``."""
    return [free(docs, n) for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256")]
