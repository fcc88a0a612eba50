"""Shards of equal row counts from a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in the order of (doc_id, text hash). A Feistel network over pairs
(l, r) with l < a, r < b and a * b >= n permutes 0..a*b-1; numbers that land at n or above
walk on along their cycle until they fall below n, which gives a permutation of 0..n-1. Row
``p`` of the permuted order is in shard ``p mod shards`` at slot ``p div shards``, so the
place of a row follows from its number, n and the seed alone, and every shard is read by
itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import kept, whole, with_totals

ROUNDS = 6
#: a * b exceeds n by less than a, so one step leaves 0..n-1 with chance 1 / sqrt(n) at most.
WALK = 64


def permuted(number: str, rows: int, seed: int) -> str:
    """SQL for the place of row ``number`` among ``rows``; fails rather than give a wrong one."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    b = max(1, -(-rows // a))

    def network(value: str) -> str:
        return f"""aggregate(sequence(0, {ROUNDS - 1}),
            named_struct('l', ({value}) div {b}L, 'r', ({value}) % {b}L),
            (s, k) -> if(k % 2 = 0,
                named_struct('l', (s.l + pmod(xxhash64(s.r, k, {seed}L), {a}L)) % {a}L, 'r', s.r),
                named_struct('l', s.l, 'r', (s.r + pmod(xxhash64(s.l, k, {seed}L), {b}L)) % {b}L)),
            s -> s.l * {b}L + s.r)"""

    walked = f"aggregate(sequence(1, {WALK}), {network(number)}, (v, i) -> if(v < {rows}L, v, {network('v')}))"
    return f"""transform(array({walked}), v -> if(v < {rows}L, v,
        cast(raise_error('the walk did not end') as bigint)))[0]"""


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 20240) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) for every row.

    Shard counts differ by one at most and slots have no gaps. Null texts count as empty,
    null ids come first; rows alike in id and text are interchangeable and each gets a place
    of its own. An empty table gives an empty result. Other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(whole()) + F.lit(1)).cast("long").alias("size"),
        F.crc32(whole().cast("binary")).alias("text_crc32"),
        F.xxhash64(whole()).alias("__hash"),
    )
    alike = ["doc_id", "__hash", "size", "text_crc32"]
    distinct = with_totals(rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("__n")), alike, "__n", "__first")
    distinct = kept(distinct, "numbered")
    total = distinct.agg(F.sum("__n")).first()[0] or 0
    return (
        distinct.withColumn("row_number", F.explode(F.expr("sequence(__first, __first + __n - 1)")))
        .withColumn("__place", F.expr(permuted("row_number", total, seed)))
        .select(
            "doc_id", "size", "text_crc32", "row_number",
            (F.col("__place") % shards).cast("int").alias("shard"),
            F.expr(f"__place div {shards}L").alias("slot"),
        )
    )
