"""The corpus pipeline: documents become packed training sequences in five stages.

Each stage takes (spark, docs, folder of the tables) and returns a frame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latemark.llm import decontamination, packing, simhash, substrings, toxicity
from latemark.llm.frames import free, kept, table
from latemark.session import remove_paths, scratch_made

#: Documents of at least this chance of being toxic go, as in op1_toxicity.
TOXIC = 0.3
TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents and drop those that score as toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    score, spans = free(docs, "__score"), free(docs, "__spans")
    return toxicity.scored(docs, model, score, spans).filter(F.col(score) < TOXIC).drop(score, spans)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints of three-word shingles link at three bits."""
    return simhash.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start more than once are cut out; ``n_chars`` follows the text."""
    cut = substrings.without_repeats(docs, window=200).drop(*substrings.added_names(docs))
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_text", cut_repeats),
    ("benchmark", drop_contaminated),
    ("packing", pack),
]

#: Trained models, suffix sorting and tokenizers have no equal in SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has put aside goes when its result is written."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch_made() as paths:
            docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
        remove_paths(spark, last + [p for p in paths if p != docs.scratch])
        last = [docs.scratch]
    return docs
