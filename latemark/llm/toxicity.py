"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is a bag of sentences. A sentence is toxic with chance p = sigmoid(b + sum of the
weights of its words), a document with chance 1 - product(1 - p) over its sentences (noisy
or), and only labels of documents are learnt from. The weight of a word is the sum over the
word and its beginnings of three to five letters, hashed, so unseen forms of a known stem
count. Training is full-batch on a bounded sample; features that are not clearly more frequent
in its toxic documents are left out. Once learnt, the sentence chances tell where in a document the offence is.
"""

from __future__ import annotations

import re
import zlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import extended, free, map_batches, quoted, whole
from latemark.llm.labelled import class_weights, sample

#: At most so many labelled documents of each class are learnt from, none above LETTERS.
ROWS = 3000
LETTERS = 20_000
BUCKETS = 1 << 18
STEMS = (3, 4, 5)
#: Toxic documents of the sample that must have a feature, how many standard errors its share
#: among them must lie above that among the others, and by which log ratio.
LEAST_DOCS = 8
ERRORS = 3.5
LIFT = 1.5
ROUNDS = 120
RATE = 0.15
DECAY = 2e-3
CACHE = 200_000
#: What ends a sentence, and what a word is.
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Buckets of a word in lower case and of its beginnings."""
    found = [zlib.crc32(word.encode()) % BUCKETS]
    found += [zlib.crc32(f"{n} {word[:n]}".encode()) % BUCKETS for n in STEMS if len(word) > n]
    return found


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, distinct words in lower case) of each sentence that has a word."""
    for found in SENTENCE.finditer(text):
        words = set(WORD.findall(found.group().lower()))
        if words:
            yield found.start(), found.end(), words


@dataclass
class SentenceModel:
    weights: np.ndarray
    bias: float

    def word_weight(self, word: str) -> float:
        return float(sum(self.weights[i] for i in features(word)))


def telling(seen: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which features are clearly more frequent under label 1; ``seen`` has documents by label."""
    sizes = np.array([(labels == 0).sum(), (labels == 1).sum()])
    clean, toxic = ((seen[k] + 0.5) / (sizes[k] + 1) if sizes[k] else np.full(seen.shape[1], 0.5) for k in (0, 1))
    error = np.sqrt(toxic * (1 - toxic) / max(sizes[1], 1) + clean * (1 - clean) / max(sizes[0], 1))
    return (seen[1] >= LEAST_DOCS) & (toxic - clean > ERRORS * error) & (np.log(toxic / clean) > LIFT)


def fit(bags: list[list[np.ndarray]], labels: np.ndarray, row_weights: np.ndarray) -> SentenceModel:
    """Weights of noisy-or over sentences, each an array of feature buckets."""
    weights, bias = np.zeros(BUCKETS), -4.0
    if not len(bags) or not labels.any():
        return SentenceModel(weights, -20.0)
    seen = np.zeros((2, BUCKETS))
    for bag, label in zip(bags, labels):
        if bag:
            seen[label, np.unique(np.concatenate(bag))] += 1
    counts = np.array([len(b) for b in bags])
    flat = [s for bag in bags for s in bag]
    sizes = np.array([len(s) for s in flat], np.int64)
    columns = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(flat)), sizes)
    # the telling features, numbered densely
    dense = np.full(BUCKETS, -1)
    often = np.flatnonzero(telling(seen, labels))
    dense[often] = np.arange(len(often))
    keep = dense[columns] >= 0
    columns, owner = dense[columns[keep]], owner[keep]
    doc_of = np.repeat(np.arange(len(bags)), counts)
    w = np.zeros(len(often))
    first, second, steps = np.zeros(len(w) + 1), np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    share = row_weights / row_weights.sum()
    for round_ in range(1, ROUNDS + 1):
        z = bias + np.bincount(owner, w[columns], minlength=len(flat))
        hazard = np.bincount(doc_of, np.logaddexp(0, z), minlength=len(bags))
        # loss: hazard for label 0, -log(1 - exp(-hazard)) for label 1
        slope = share * np.where(labels == 1, -1 / np.expm1(np.clip(hazard, 1e-6, 50)), 1.0)
        by_sentence = slope[doc_of] / (1 + np.exp(-z))
        steps[:-1] = np.bincount(columns, by_sentence[owner], minlength=len(w)) + DECAY / len(bags) * w * 10
        steps[-1] = by_sentence.sum()
        first = 0.9 * first + 0.1 * steps
        second = 0.99 * second + 0.01 * steps**2
        move = RATE * (first / (1 - 0.9**round_)) / (np.sqrt(second / (1 - 0.99**round_)) + 1e-6)
        w -= move[:-1]
        bias -= float(move[-1])
    weights[often] = w
    return SentenceModel(weights, bias)


def _bagged(rows: DataFrame) -> DataFrame:
    """Feature buckets of (text, label) as flat 32-bit numbers, sentences told apart by -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for text in batch.column(0).to_pylist():
                flat: list[int] = []
                for _, _, words in sentences(text):
                    flat.extend({i for word in words for i in features(word)})
                    flat.append(-1)
                bags.append(np.array(flat, np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.binary()), batch.column(1)], names=["bag", "label"])

    return map_batches(rows, work, "bag binary, label int")


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, letters: int = LETTERS) -> SentenceModel:
    """Fit on at most ``rows`` documents a class; without toxic labels nothing is toxic."""
    chosen, counts = sample(docs, labels, "toxic", rows, letters)
    table = _bagged(chosen).orderBy("label", F.xxhash64("bag"), "bag").toArrow()
    bags = []
    for bag in table.column("bag").to_pylist():
        flat = np.frombuffer(bag, np.int32)
        ends = np.flatnonzero(flat == -1)
        bags.append([part[part >= 0] for part in np.split(flat, ends)[:len(ends)]] if len(flat) else [])
    marks = np.array(table.column("label").to_pylist(), np.int64)
    return fit(bags, marks, class_weights(marks, counts))


def scored(docs: DataFrame, model: SentenceModel, score: str = "score", spans: str = "spans", least: float = 0.3) -> DataFrame:
    """``docs`` with the chance of being toxic and the sentences of at least ``least``.

    ``spans`` lists (start, end, chance) in characters, in the order of the text. Null and
    empty texts score 0 and have none. Other columns, whatever their names, stay as they are.
    """
    columns = docs.columns
    place = len(columns)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        known: dict[str, float] = {}
        for batch in batches:
            chances, found = [], []
            for text in batch.column(place).to_pylist():
                if len(known) > CACHE:
                    known.clear()
                hazard, where = 0.0, []
                for start, end, words in sentences(text):
                    z = bias
                    for word in words:
                        weight = known.get(word)
                        if weight is None:
                            weight = known[word] = float(sum(weights[i] for i in features(word)))
                        z += weight
                    small = math.exp(-abs(z))
                    hazard += max(z, 0.0) + math.log1p(small)
                    chance = (1.0 if z > 0 else small) / (1.0 + small)
                    if chance >= least:
                        where.append({"start": start, "end": end, "chance": chance})
                chances.append(float(-np.expm1(-hazard)))
                found.append(where)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:place], pa.array(chances, pa.float64()), pa.array(found, SPANS)],
                names=[*columns, score, spans],
            )

    schema = extended(docs, f"`{score}` double, `{spans}` array<struct<start:int,end:int,chance:double>>")
    return map_batches(docs.select(*quoted(columns), whole().alias(free(docs, "__text"))), work, schema)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))
