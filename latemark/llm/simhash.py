"""SimHash near-duplicates found at covering-code anchors.

A fingerprint has 64 bits; fingerprints link at three or fewer differing bits. Of two linked
fingerprints, one half of 32 bits differs in one bit at most. Each half is covered by a code:
two Hamming words of 15 bits and two free bits, 2**24 anchors with covering radius 2. A
fingerprint lives at its nearest anchor and visits every anchor within covering radius plus
one that is the nearest one of some half one bit away, 16 others. So each linked pair meets
at the home of either, in one of the two halves, and fingerprints are compared per anchor.

An anchor where more than ``CROWD`` fingerprints live is split by the four bytes of the other
half, of which linked fingerprints share one. Fingerprints of parts that are still larger meet
once more by themselves, under each choice of five of all eight bytes: three differing bits
spoil three bytes at most. What is compared are distinct fingerprints; equal ones
are one class already. Groups give back a spanning tree of their links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.components import components
from latemark.llm.frames import extended, free, kept, map_batches, quoted, split_join, whole

SEED = 42
SHINGLE = 3
THRESHOLD = 3
#: Members of one anchor, and of a part of it, above which it is split, whatever the table's size.
CROWD = 10_000
#: Tables of at most so many groups are broadcast, longer ones joined.
BROADCAST = 10_000
#: Groups up to this size give pairs, larger ones a spanning tree.
SMALL = 16
BITS = 1 << 16


def fingerprint(text: bytes) -> int:
    """The SimHash of one text: a bit is 1 if it is set in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), BITS):
        part = hashes[first:first + BITS]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def with_fingerprints(docs: DataFrame, name: str = "fingerprint", text: str = "text") -> DataFrame:
    """Add the fingerprint as a signed long to every row; null texts count as empty."""
    columns = docs.columns
    place = len(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:place], pa.array(found, pa.int64())], names=[*columns, name]
            )

    schema = extended(docs, f"`{name}` long")
    return map_batches(docs.select(*quoted(columns), whole(text).alias(free(docs, "__text"))), work, schema)


def _nearest_words() -> np.ndarray:
    """The nearest word of the Hamming code for each of the 2**15 words of 15 bits."""
    words = np.arange(1 << 15)
    syndrome = np.zeros(1 << 15, np.int64)
    for place in range(15):
        syndrome ^= np.where(words >> place & 1, place + 1, 0)
    return np.where(syndrome > 0, words ^ (1 << np.maximum(syndrome - 1, 0)), words)


NEAREST = _nearest_words()


def home(half: np.ndarray) -> np.ndarray:
    """The nearest anchor of 32-bit halves, given as int64."""
    return NEAREST[half & 0x7FFF] | NEAREST[half >> 15 & 0x7FFF] << 15 | half & 0xC0000000


def stations(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, index of the fingerprint, lives there) for all anchors of all fingerprints."""
    keys, owners, lives = [], [], []
    flips = np.concatenate([[0], 1 << np.arange(32, dtype=np.int64)])
    for side in range(2):
        half = (prints >> np.uint64(32 * side) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        own = home(half)
        all_of = np.sort(home(half[:, None] ^ flips[None, :]), axis=1)
        new = np.concatenate([np.ones((len(half), 1), bool), all_of[:, 1:] != all_of[:, :-1]], axis=1)
        owner, _ = np.nonzero(new)
        keys.append(all_of[new] | side << 32)
        owners.append(owner)
        lives.append(all_of[new] == own[owner])
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(lives)


def _stationed(prints: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for first in range(0, len(values), 4096):
                part = values[first:first + 4096]
                keys, owners, lives = stations(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(part[owners]), pa.array(lives)], names=["key", "print", "lives"]
                )

    return map_batches(prints, work, "key long, print long, lives boolean")


def _near(one: np.uint64 | np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ many) <= THRESHOLD


def _tree(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links among ``members``, one search front at a time."""
    left, found = members, []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            near = _near(one := front.pop(), left)
            if near.any():
                met = left[near]
                found.append((np.full(len(met), one), met))
                front.extend(met)
                left = left[~near]
    return found


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within groups of equal keys; rows come sorted by key."""
    rest: list[np.ndarray] = []

    def links(keys: np.ndarray, prints: np.ndarray, lives: np.ndarray) -> pa.RecordBatch:
        heads = np.flatnonzero(np.concatenate([[True], np.any(keys[1:] != keys[:-1], axis=1)]))
        sizes = np.diff(np.concatenate([heads, [len(keys)]]))
        pairs = []
        small = np.repeat((sizes > 1) & (sizes <= SMALL), sizes)
        group = np.repeat(np.arange(len(heads)), sizes)
        at = np.flatnonzero(small & lives)
        for step in range(SMALL):
            other = heads[group[at]] + step
            inside = step < sizes[group[at]]
            a, b = prints[at[inside]], prints[other[inside]]
            linked = (a != b) & _near(a, b)
            pairs.append((a[linked], b[linked]))
        for g in np.flatnonzero(sizes > SMALL):
            rows = slice(heads[g], heads[g] + sizes[g])
            if lives[rows].any():
                pairs.extend(_tree(np.unique(prints[rows])))
        a, b = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        now = [np.stack(columns[:2], axis=1), columns[2].view(np.uint64), columns[3].astype(bool)]
        if rest:
            now = [np.concatenate(x) for x in zip(rest, now)]
        last = np.flatnonzero(np.any(now[0] != now[0][-1], axis=1)) if len(now[0]) else []
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield links(*[x[:cut] for x in now])
        rest = [x[cut:] for x in now]
    if rest and len(rest[0]):
        yield links(*rest)


def _told_apart(rows: DataFrame, crowds: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows outside and inside of ``crowds``, a kept table of groups; no second part if it is empty."""
    on, groups = crowds.columns, crowds.count()
    if not groups:
        return rows, None
    few = F.broadcast(crowds) if groups <= BROADCAST else crowds
    return rows.join(few, on, "left_anti"), rows.join(few, on, "left_semi")


def _above(rows: DataFrame, *on: str) -> DataFrame:
    return kept(rows.groupBy(*on).count().filter(F.col("count") > CROWD).select(*on), "crowds")


def _by_byte(rows: DataFrame) -> DataFrame:
    """Each row four times, under the bytes of the half that its anchor does not cover."""
    shift = F.when(F.expr("key < 4294967296"), F.lit(32)).otherwise(F.lit(0))
    spots = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda j: F.expr("1L") + j * 256 + F.call_function(
            "shiftrightunsigned", F.col("print"), (shift + j * 8).cast("int")).bitwiseAND(F.lit(255)),
    )
    return rows.withColumn("__sub", F.explode(spots))


def _by_five_bytes(prints: DataFrame) -> DataFrame:
    """Fingerprints under each choice of five of their eight bytes, the key telling which."""
    chosen = [sum(255 << 8 * j for j in c) for c in combinations(range(8), 8 - THRESHOLD)]
    signed = [m - (1 << 64) if m >> 63 else m for m in chosen]
    spots = [
        F.struct(F.lit((2 << 32) + i).cast("long").alias("key"), F.col("print").bitwiseAND(F.lit(m)).alias("__sub"))
        for i, m in enumerate(signed)
    ]
    under = prints.select("print", F.lit(True).alias("lives"), F.explode(F.array(*spots)).alias("s"))
    return under.select("s.key", "print", "lives", "s.__sub")


def linked_prints(prints: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (one column, ``fingerprint``), enough to connect all."""
    rows = _stationed(prints.select("fingerprint"))
    calm, crowd = _told_apart(rows, _above(rows.filter("lives"), "key"))
    dealt = calm.withColumn("__sub", F.lit(0).cast("long"))
    if crowd is not None:
        split = _by_byte(kept(crowd, "crowd"))
        loose, dense = _told_apart(split, _above(split, "key", "__sub"))
        dealt = dealt.unionByName(loose)
        if dense is not None:
            dealt = dealt.unionByName(_by_five_bytes(dense.select("print").distinct()))
    dealt = dealt.repartition("key", "__sub").sortWithinPartitions("key", "__sub")
    return map_batches(dealt.select("key", "__sub", "print", "lives"), _compared, "a long, b long")


def print_components(prints: DataFrame) -> DataFrame:
    """(fingerprint, n, component_id, root) from kept rows (doc_id, fingerprint).

    ``component_id`` is the smallest doc_id that has a fingerprint in reach, null if all ids
    there are null; ``n`` counts the rows of the fingerprint, ``root`` is the same fingerprint for
    all in reach of each other.
    """
    classes = kept(
        prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("__least")), "prints"
    )
    roots = components(linked_prints(classes)).select(F.col("a").alias("fingerprint"), F.col("b").alias("__root"))
    rooted = classes.join(roots, "fingerprint", "left").withColumn("__root", F.coalesce("__root", "fingerprint"))
    rooted = kept(rooted, "rooted")
    least = rooted.groupBy("__root").agg(F.min("__least").alias("component_id"), F.count(F.lit(1)).alias("__m"))
    found = split_join(rooted, kept(least, "least"), "__root", "__m")
    return kept(found.select("fingerprint", "n", "component_id", F.col("__root").alias("root")), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row.

    Texts without words, empty and null ones included, have fingerprint zero and link like
    any other. Repeated rows give repeated results. Other columns are not read.
    """
    prints = kept(with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "fingerprint"), "fingerprints")
    return split_join(prints, print_components(prints), "fingerprint", "n").select(
        "doc_id", "fingerprint", "component_id"
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component: the one of smallest doc_id, null ids last, ties by the text.

    Columns and their order stay as they are.
    """
    columns = docs.columns
    # ids that tell rows apart up to equal (doc_id, text)
    rows = with_fingerprints(docs.select("doc_id", "text")).select(
        "doc_id", "fingerprint", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash")
    )
    prints = kept(rows, "fingerprints")
    joined = split_join(prints, print_components(prints), "fingerprint", "n")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__hash")
    chosen = joined.groupBy("root").agg(F.min(first).alias("__first")).select("__first.doc_id", "__first.__hash")
    id_, hash_, own = (free(docs, n) for n in ("__id", "__h", "__hash"))
    chosen = chosen.distinct().select(F.col("doc_id").alias(id_), F.col("__hash").alias(hash_))
    marked = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_))
    return marked.join(chosen, same).dropDuplicates([id_, hash_]).select(*quoted(columns))
