"""Counts of greedy word pieces in linear time, without building the pieces.

The vocabulary is a trie. Where a word cannot go on from a node, the longest pieces at its
start are popped and the failure link leads to the node of what is left; how many pieces a
link pops is counted when the automaton is built. A word is read once, from left to right.
A letter that no piece begins with counts as its UTF-8 bytes, as vocabularies with byte
fallback have it. Words are cut at white space and begin with a mark, so pieces that begin a
word and pieces that go on are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import map_batches, whole

#: Fixed value: the mark at the beginning of a word.
MARK = "▁"
CACHE = 300_000


class Automaton:
    """Longest-match counting over a vocabulary of strings."""

    def __init__(self, vocabulary: list[str]):
        self.next: dict[tuple[int, str], int] = {}
        pieces, depth = {}, [("", 0, 0)]
        for piece in vocabulary:
            node = 0
            for letter in piece:
                at = self.next.get((node, letter))
                if at is None:
                    at = self.next[node, letter] = len(depth)
                    depth.append((letter, node, depth[node][2] + 1))
                node = at
            if node:
                pieces[node] = True
        self.link, self.popped = [0] * len(depth), [0] * len(depth)
        for node in sorted(range(1, len(depth)), key=lambda v: depth[v][2]):
            letter, parent, length = depth[node]
            if node in pieces or length == 1:
                self.popped[node] = 1 if node in pieces else len(letter.encode())
                continue
            self.link[node], self.popped[node] = self._step(self.link[parent], letter, self.popped[parent])

    def _step(self, node: int, letter: str, count: int) -> tuple[int, int]:
        while (found := self.next.get((node, letter))) is None:
            if not node:
                return 0, count + len(letter.encode())
            count += self.popped[node]
            node = self.link[node]
        return found, count

    def count(self, word: str) -> int:
        """The number of greedy longest pieces of one word."""
        node = total = 0
        for letter in word:
            node, total = self._step(node, letter, total)
        while node:
            total += self.popped[node]
            node = self.link[node]
        return total


def vocabulary_of(path: str) -> list[str]:
    """The pieces of a sentencepiece model file; control, unknown and byte pieces left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


@lru_cache(2)
def automaton_of(path: str) -> Automaton:
    return Automaton(vocabulary_of(path))


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of ``docs``.

    Null, empty and white texts have no words and no tokens. Repeated rows give repeated
    results; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(model)
        known: dict[bytes, int] = {}
        for batch in batches:
            words, tokens = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                parts = text.split()
                if len(known) > CACHE:
                    known.clear()
                for word in {p for p in parts if p not in known}:
                    known[word] = automaton.count(MARK + word.decode())
                words.append(len(parts))
                tokens.append(sum(map(known.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(words, np.int64)), pa.array(np.array(tokens, np.int64))],
                names=["doc_id", "n_words", "n_tokens"],
            )

    return map_batches(
        docs.select(F.col("doc_id").cast("long"), whole().alias("text")), work, "doc_id long, n_words long, n_tokens long"
    )
