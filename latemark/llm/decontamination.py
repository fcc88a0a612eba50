"""Benchmark decontamination: rare seeds, then Smith-Waterman alignment.

Benchmark items are taken in blocks of bounded size and every block meets all documents, so
what is broadcast does not grow with the benchmark. A copy may lack some words of its item, say
k of them, and have any number put in; so no run of words is sure to stay, but of any k + 1
words one is. The seeds of an item are its k + 1 rarest words, by how many documents hold each
(n-grams of one word). How often an item leaked changes which words are rarest, never that a
copy has one. One pass counts documents, one finds the seeds. An item is aligned only where
enough of its words stand, in any order, to reach the similarity asked for; that leaves out no
copy. There the stretch around the seeds and the item are aligned word by word; edited and
paraphrased copies align with gaps and mismatches.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import extended, free, map_batches, quoted, whole

#: Share of an item's words that must align in their order.
SIMILARITY = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words that the benchmark text of one block can have, at one letter and one space a word.
BLOCK_WORDS = 1_000_000
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def needed(length: int) -> int:
    """The least number of equal words that makes a copy of an item of ``length`` words."""
    if not length:
        return 0
    least = int(length * SIMILARITY)
    return least if least / length >= SIMILARITY else least + 1


def seed_places(words: list[str], counts: dict[str, int]) -> list[int]:
    """The places of the rarest words of an item, one more than a copy may lack."""
    lost = len(words) - needed(len(words))
    return sorted(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))[:lost + 1]


def align(item: np.ndarray, part: np.ndarray) -> tuple[int, int, int, int]:
    """(score, aligned equal words, first, end) of the best local alignment of ``item`` in ``part``."""
    rows, columns = len(item), len(part)
    table = np.zeros((rows + 1, columns + 1), np.int32)
    ramp = np.arange(columns + 1, dtype=np.int32) * GAP
    for i in range(1, rows + 1):
        above = table[i - 1]
        step = np.where(part == item[i - 1], MATCH, MISMATCH)
        row = np.zeros(columns + 1, np.int32)
        np.maximum(above[:-1] + step, above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        # gaps in the item's text: the best value further left, less its distance
        table[i] = np.maximum.accumulate(row - ramp) + ramp
    i, j = np.unravel_index(int(np.argmax(table)), table.shape)
    best, end, equal = int(table[i, j]), int(j), 0
    while table[i, j] > 0:
        now = table[i, j]
        same = i and j and part[j - 1] == item[i - 1]
        if i and j and now == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
            equal += bool(same)
            i, j = i - 1, j - 1
        elif i and now == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, equal, int(j), end


def _stretches(places: list[tuple[int, int]], length: int, total: int) -> list[tuple[int, int]]:
    """Document stretches that an item of ``length`` words may cover, from (document, item) seed places.

    An alignment above zero has no more than two gaps for each equal word.
    """
    slack = 2 * length
    spans = sorted((max(0, at - own - slack), min(total, at - own + length + slack)) for at, own in places)
    merged = [spans[0]]
    for low, high in spans[1:]:
        if low <= merged[-1][1] and high - merged[-1][0] <= 4 * (length + slack):
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def may_hold(have: Counter, bag: list[tuple[str, int]], lost: int) -> bool:
    """Whether not more than ``lost`` words of an item, given with their numbers, are missing."""
    for word, times in bag:
        there = have.get(word, 0)
        if there < times:
            lost -= times - there
            if lost < 0:
                return False
    return True


def matches_in(words: list[str], items: list[list[str]], seeds: dict, bags: list) -> list[tuple[int, float, int, int, int, int]]:
    """(item, similarity, score, equal words, first word, end) of every item that the words hold a copy of."""
    places: dict[int, list[tuple[int, int]]] = defaultdict(list)
    have: Counter = Counter()
    able: dict[int, bool] = {}
    for at, word in enumerate(words):
        if word not in seeds:
            continue
        have = have or Counter(words)
        for item, own in seeds[word]:
            if item not in able:
                able[item] = may_hold(have, *bags[item])
            if able[item]:
                places[item].append((at, own))
    found = []
    for item, seen in places.items():
        own = items[item]
        best = None
        for low, high in _stretches(seen, len(own), len(words)):
            if not may_hold(Counter(words[low:high]), *bags[item]):
                continue
            code: dict[str, int] = {}
            coded = [np.array([code.setdefault(w, len(code)) for w in ws]) for ws in (own, words[low:high])]
            score, equal, first, end = align(*coded)
            now = (equal / max(len(own), 1), score, equal, low + first, low + end)
            if best is None or now > best:
                best = now
        if best and best[0] >= SIMILARITY:
            found.append((item, *best))
    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, list[str]]]]:
    """The items, some ``BLOCK_WORDS`` words at a time; ties and nulls are items of their own."""
    items = benchmark.select("item_id", whole().alias("text"))
    # letters bound the words of any script
    total = items.agg(F.sum(F.floor((F.length("text") + 1) / 2))).first()[0] or 0
    count = -(-total // BLOCK_WORDS)
    for block in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).orderBy("item_id", "text")
        yield [(r["item_id"], words_of(r["text"])) for r in part.collect()]


def seeds_of(items: list[list[str]], counts: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Where the rarest words of the items stand: word -> (item, place)."""
    seeds: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for item, words in enumerate(items):
        for place in seed_places(words, counts):
            seeds[words[place]].append((item, place))
    return dict(seeds)


def bags_of(items: list[list[str]], counts: dict[str, int]) -> list[tuple[list[tuple[str, int]], int]]:
    """The words of each item with their numbers, the rarest first, and how many a copy may lack."""
    return [
        (sorted(Counter(words).items(), key=lambda x: (counts.get(x[0], 0), -x[1], x[0])), len(words) - needed(len(words)))
        for words in items
    ]


def document_counts(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """How many of all documents hold each word of a bounded vocabulary; words of none are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                met.update(shared.value.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], names=["word", "n"]
        )

    counted = map_batches(docs.select(whole().alias("text")), work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def _matchers(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple[list, Callable[[str], list]]]:
    """For each block: the ids of its items, and a function from a text to its matches."""
    for block in _blocks(benchmark):
        ids, items = [i for i, _ in block], [w for _, w in block]
        counts = document_counts(docs, {w for words in items for w in words})
        shared = docs.sparkSession.sparkContext.broadcast((items, seeds_of(items, counts), bags_of(items, counts)))

        def matcher(text: str, shared=shared) -> list:
            items, seeds, bags = shared.value
            return matches_in(words_of(text), items, seeds, bags)

        yield ids, matcher


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, score, equal_words, item_words, first_word, end_word).

    One row for each document and item of which it holds a copy: the best alignment has at
    least ``SIMILARITY`` of the item's words in their order. Null texts and items without
    words match nothing; equal items match each for itself; repeated documents give repeated
    rows. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole().alias("text"))
    schema = (
        "doc_id long, item_id long, similarity double, score int, equal_words int, item_words int, "
        "first_word int, end_word int"
    )
    result = docs.sparkSession.createDataFrame([], schema)
    for ids, matcher in _matchers(docs, benchmark):

        def work(batches: Iterator[pa.RecordBatch], ids=ids, matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [
                    (doc_id, ids[item], similarity, score, equal, round(equal / similarity), first, end)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for item, similarity, score, equal, first, end in matcher(text)
                ]
                columns = list(zip(*out)) if out else [()] * 8
                kinds = [pa.int64(), pa.int64(), pa.float64(), *[pa.int32()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=FIELDS)

        result = result.unionByName(map_batches(rows, work, schema))
    return result


FIELDS = ["doc_id", "item_id", "similarity", "score", "equal_words", "item_words", "first_word", "end_word"]


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` less the rows whose text holds a copy of an item; columns stay as they are."""
    columns, kept_rows, clean_name = docs.columns, docs, free(docs, "__clean")
    for _, matcher in _matchers(docs, benchmark):

        def work(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not matcher(text) for text in batch.column(len(columns)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(clean, pa.bool_())], names=[*columns, clean_name])

        rows = kept_rows.select(*quoted(columns), whole().alias(free(docs, "__text")))
        marked = map_batches(rows, work, extended(docs, f"`{clean_name}` boolean"))
        kept_rows = marked.filter(F.col(clean_name)).drop(clean_name)
    return kept_rows
