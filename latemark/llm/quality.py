"""Quality by attention over passages, learnt from labels of whole documents.

A document is cut into passages of ``PASSAGE`` words. Each is encoded by shares of its
letters, signs, repeats and shapes through a learnt layer; gated attention (tanh of one
projection times sigmoid of another) gives every passage a weight, the weights of a document
add up to one, and the document's score is a logistic of the weighted mean of its passages.
Encoder, attention and score are learnt together, full-batch, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import extended, free, map_batches, quoted, whole
from latemark.llm.labelled import class_weights, sample

PASSAGE = 40
#: At most so many labelled documents of each class are learnt from, none above LETTERS.
ROWS = 3000
LETTERS = 20_000
HIDDEN, GATE = 24, 12
ROUNDS = 400
RATE = 0.02
DECAY = 1e-4
#: Passages encoded at once.
BLOCK = 2048
#: Fixed value: ASCII signs counted one by one.
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    table = np.zeros((256, 6 + len(SIGNS)))
    table[ord("A"):ord("Z") + 1, 0] = 1
    table[ord("a"):ord("z") + 1, 1] = 1
    table[ord("0"):ord("9") + 1, 2] = 1
    table[128:192, 3] = 1
    table[192:, 4] = 1
    table[list(b" \t\r\n"), 5] = 1
    for place, sign in enumerate(SIGNS):
        table[sign, 6 + place] = 1
    return table


CLASSES = _classes()
WIDTH = CLASSES.shape[1] + 8


def encoded(words: list[bytes]) -> np.ndarray:
    """One row of numbers for each passage of the words; one row of zeros for none."""
    if not words:
        return np.zeros((1, WIDTH))
    out = []
    for block in range(0, len(words), PASSAGE * BLOCK):
        passages = [words[i:i + PASSAGE] for i in range(block, min(block + PASSAGE * BLOCK, len(words)), PASSAGE)]
        counts = np.zeros((len(passages), 256))
        shapes = np.zeros((len(passages), 8))
        for row, passage in enumerate(passages):
            counts[row] = np.bincount(np.frombuffer(b" ".join(passage), np.uint8), minlength=256)
            n = len(passage)
            lengths = list(map(len, passage))
            mean = sum(lengths) / n
            shapes[row] = (
                n / PASSAGE, mean / 10, len(set(passage)) / n, max(lengths) / 30,
                sum(map(bytes.__eq__, passage, passage[1:])) / n,
                sum(map(bytes.isupper, passage)) / n, sum(map(bytes.isalpha, passage)) / n,
                sum(l <= 3 for l in lengths) / n,
            )
        shares = counts @ CLASSES / np.maximum(counts.sum(1, keepdims=True), 1)
        # signs are few in most texts; the root spreads what is near zero
        out.append(np.concatenate([np.sqrt(shares), shapes], axis=1))
    return np.concatenate(out)


class AttentionModel:
    """Encoder, gated attention and logistic score, with gradients by hand."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        scale = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b))
        self.mean, self.spread = np.zeros(WIDTH), np.ones(WIDTH)
        self.parts = {
            "encode": scale(WIDTH, HIDDEN), "encode0": np.zeros(HIDDEN), "tanh": scale(HIDDEN, GATE),
            "gate": scale(HIDDEN, GATE), "attend": scale(GATE, 1)[:, 0], "score": np.zeros(HIDDEN), "score0": np.zeros(1),
        }

    def forward(self, passages: np.ndarray, heads: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags; ``heads`` are the first passages of each bag, none empty."""
        p = self.parts
        x = np.clip((passages - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ p["encode"] + p["encode0"])
        a, g = np.tanh(h @ p["tanh"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        e = (a * g) @ p["attend"]
        sizes = np.diff(np.concatenate([heads, [len(x)]]))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), sizes))
        weight = e / np.repeat(np.add.reduceat(e, heads), sizes)
        z = np.add.reduceat(weight[:, None] * h, heads)
        score = 1 / (1 + np.exp(-np.clip(z @ p["score"] + p["score0"][0], -30, 30)))
        return {"x": x, "h": h, "a": a, "g": g, "weight": weight, "z": z, "score": score, "sizes": sizes}

    def slopes(self, f: dict[str, np.ndarray], heads: np.ndarray, labels: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.parts, f["sizes"]
        d = share * (f["score"] - labels)
        dz = np.repeat(d[:, None] * p["score"], sizes, axis=0)
        dh = f["weight"][:, None] * dz
        dw = (dz * f["h"]).sum(1)
        de = f["weight"] * (dw - np.repeat(np.add.reduceat(f["weight"] * dw, heads), sizes))
        dag = de[:, None] * p["attend"]
        da, dg = dag * f["g"] * (1 - f["a"] ** 2), dag * f["a"] * f["g"] * (1 - f["g"])
        dh = dh + da @ p["tanh"].T + dg @ p["gate"].T
        dx = dh * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ dx, "encode0": dx.sum(0), "tanh": f["h"].T @ da, "gate": f["h"].T @ dg,
            "attend": (f["a"] * f["g"]).T @ de, "score": f["z"].T @ d, "score0": np.array([d.sum()]),
        }

    def fit(self, passages: np.ndarray, heads: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        self.mean, self.spread = passages.mean(0), passages.std(0) + 0.01
        share = weights / weights.sum()
        first = {k: np.zeros_like(v) for k, v in self.parts.items()}
        second = {k: np.zeros_like(v) for k, v in self.parts.items()}
        for round_ in range(1, ROUNDS + 1):
            slopes = self.slopes(self.forward(passages, heads), heads, labels, share)
            for k, v in self.parts.items():
                slope = slopes[k] + DECAY * v
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                v -= RATE * (first[k] / (1 - 0.9**round_)) / (np.sqrt(second[k] / (1 - 0.99**round_)) + 1e-8)


def _encoded_rows(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [encoded(t.split()).astype("f4").tobytes() for t in batch.column(0).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(bags, pa.binary()), batch.column(1)], names=["bag", "label"])

    return map_batches(rows, work, "bag binary, label int")


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, letters: int = LETTERS) -> AttentionModel:
    """Fit on at most ``rows`` documents a class; without labels every score is one half."""
    chosen, counts = sample(docs, labels, "quality", rows, letters)
    table = _encoded_rows(chosen).orderBy("label", F.xxhash64("bag"), "bag").toArrow()
    model = AttentionModel()
    bags = [np.frombuffer(b, "f4").reshape(-1, WIDTH) for b in table.column("bag").to_pylist()]
    if bags:
        heads = np.cumsum([0, *(len(b) for b in bags)])[:-1]
        marks = np.array(table.column("label").to_pylist(), np.int64)
        model.fit(np.concatenate(bags).astype(float), heads, marks, class_weights(marks, counts))
    return model


def scored(docs: DataFrame, model: AttentionModel, score: str = "score", passages: str = "best_passage") -> DataFrame:
    """``docs`` with the chance of label 1 and the number of the passage of most attention.

    Null and empty texts are one passage of zeros, number 0. Other columns, whatever their
    names, stay as they are.
    """
    columns = docs.columns
    place = len(columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, most, group, size = [], [], [], 0

            def flush() -> None:
                heads = np.cumsum([0, *(len(b) for b in group)])
                found = shared.value.forward(np.concatenate(group), heads[:-1])
                scores.extend(found["score"].tolist())
                most.extend(int(np.argmax(found["weight"][a:b])) for a, b in zip(heads, heads[1:]))
                group.clear()

            for text in batch.column(place).cast(pa.binary()).to_pylist():
                group.append(encoded(text.split()))
                size += len(group[-1])
                if size > 2 * BLOCK:
                    flush()
                    size = 0
            if group:
                flush()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:place], pa.array(scores, pa.float64()), pa.array(most, pa.int32())],
                names=[*columns, score, passages],
            )

    schema = extended(docs, f"`{score}` double, `{passages}` int")
    return map_batches(docs.select(*quoted(columns), whole().alias(free(docs, "__text"))), work, schema)
