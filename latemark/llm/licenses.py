"""License notices by diagonal voting, in DataFrame operations only.

The words of every text and of a few license templates are cut into rolling k-grams. One join
of the k-gram hashes gives hits (document place, template place); hits of one alignment share
the diagonal, document place less template place. Hits are counted by diagonal before anything
else is shuffled. Diagonals of one template and document that lie a few words apart belong to
one copy with words put in or left out, and are merged. A merged run is verified: enough
different words of the template must be covered, by grams that are equal word by word, in a
stretch that is not much longer than the template. Of runs that overlap, those that cover the
most words stay.

A phrase is a template that must stand word by word: every k-gram of it on one diagonal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from latemark.llm.frames import kept, whole

#: Words of a rolling gram.
GRAM = 2
#: Diagonals that lie at most so many words apart are one run.
DRIFT = 3
#: Share of a template's words that a run must cover, and its greatest length by that of the template.
COVERED, STRETCH = 0.75, 1.5
#: Grams of all templates up to which they are broadcast; some 100 bytes each.
BROADCAST_GRAMS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but for digits and small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A license text in small letters; a phrase must stand word by word."""

    label: str
    text: str
    phrase: bool = False


#: Phrases and their labels.
PHRASES = [
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
]

#: Sentences by which licenses are commonly given, with their public short names.
NOTICES = [
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license"),
    Template("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("cc-by-4.0", "licensed under cc by 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
]


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in small letters; null if the text is."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), BETWEEN), "")


def _grams(words: Column, size: int) -> Column:
    """The rolling grams of an array of words as structs of words w0, w1, ...; none for fewer words."""
    count = F.size(words) - F.lit(size - 1)
    parts = [F.slice(words, F.lit(1 + i), F.greatest(count, F.lit(0))).alias(f"w{i}") for i in range(size)]
    return F.arrays_zip(*parts)


def _template_grams(spark: SparkSession, templates: Sequence[Template], size: int) -> DataFrame:
    """(template, label, phrase, length, place, gram words) of all templates."""
    rows = [(i, t.label, t.phrase, t.text) for i, t in enumerate(templates)]
    frame = spark.createDataFrame(rows, "template int, label string, phrase boolean, text string")
    worded = frame.withColumn("words", words_of(F.col("text")))
    short = worded.filter(F.size("words") < size).select("text").first()
    if short:
        raise ValueError(f"a template has fewer than {size} words: {short[0]!r}")
    grams = worded.select(
        "template", "label", "phrase", F.size("words").alias("length"), F.posexplode(_grams(F.col("words"), size)).alias("place", "gram")
    )
    return grams.select("template", "label", "phrase", "length", "place", *(F.col(f"gram.w{i}").alias(f"t{i}") for i in range(size))).withColumn(
        "hash", F.xxhash64(*(f"t{i}" for i in range(size)))
    )


def _hits(texts: DataFrame, grams: DataFrame, size: int, count: int) -> DataFrame:
    """(key, template, label, phrase, length, diagonal, place): grams of ``texts`` that a template has."""
    rolled = texts.select("key", F.posexplode(_grams(F.col("words"), size)).alias("at", "gram"))
    own = rolled.select("key", "at", *(F.col(f"gram.w{i}").alias(f"w{i}") for i in range(size))).withColumn(
        "hash", F.xxhash64(*(f"w{i}" for i in range(size)))
    )
    table = F.broadcast(grams) if count <= BROADCAST_GRAMS else grams
    same = own["hash"] == table["hash"]
    for i in range(size):
        same = same & (own[f"w{i}"] == table[f"t{i}"])
    return own.join(table, same).select(
        "key", "template", "label", "phrase", "length", (F.col("at") - F.col("place")).alias("diagonal"), "place"
    )


def notices(docs: DataFrame, templates: Sequence[Template], size: int = GRAM, drift: int = DRIFT, covered: float = COVERED) -> DataFrame:
    """(key, template, label, phrase, first_word, end_word, share): verified runs of templates in ``docs`` (key, words).

    ``phrase`` marks the places of phrases; they have no rivals.

    Rows of equal key must have equal words. ``share`` is the part of the template's words
    that the run covers; 1 for a phrase, whose every place is a run.
    """
    spark = docs.sparkSession
    grams = _template_grams(spark, templates, size)
    count = sum(len(t.text.split()) for t in templates)
    # sets, so that repeated rows do not vote twice
    voted = _hits(docs, grams, size, count).groupBy("key", "template", "label", "phrase", "length", "diagonal").agg(
        F.collect_set("place").alias("places")
    )
    phrases = voted.filter("phrase").filter(F.size("places") == F.col("length") - F.lit(size - 1)).select(
        "key", "template", "label", "phrase", F.col("diagonal").alias("first_word"),
        (F.col("diagonal") + F.col("length")).alias("end_word"), F.lit(1.0).alias("share"),
    )
    of = Window.partitionBy("key", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(of) > drift, F.lit(True))
    merged = (
        voted.filter("not phrase")
        .withColumn("run", F.sum(far.cast("int")).over(of))
        .groupBy("key", "template", "label", "phrase", "length", "run")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
            F.max(F.col("diagonal") + F.array_max("places") + F.lit(size)).alias("end_word"),
        )
    )
    words = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.lit(size - 1)))))
    verified = merged.withColumn("held", F.size(words)).withColumn("share", F.col("held") / F.col("length")).filter(
        (F.col("share") >= covered) & (F.col("end_word") - F.col("first_word") <= F.col("length") * F.lit(STRETCH))
    )
    # overlapping runs are rival readings of one place
    order = Window.partitionBy("key").orderBy("first_word", "end_word", "template")
    before = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = verified.withColumn("new", F.coalesce(F.col("first_word") >= before, F.lit(True)).cast("int"))
    rivals = placed.withColumn("spot", F.sum("new").over(order))
    best = rivals.withColumn("most", F.max("held").over(Window.partitionBy("key", "spot"))).filter("held = most")
    return phrases.unionByName(best.select(*phrases.columns))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(labels)), ",")


def license_scan(docs: DataFrame, phrases: Sequence[Template] = PHRASES, templates: Sequence[Template] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row.

    ``n_base`` counts the places of all ``phrases``, ``first_word`` and ``last_word`` are the
    least and greatest word at which one starts. ``labels`` has those of the phrases and of
    every verified run of ``templates``; ``score`` is the greatest share of words that a run
    or phrase covers. Without any, labels are empty, places null and the score 0.

    Null texts count as empty. Rows alike in doc_id and text, null ids included, have equal
    results, one for each row. Other columns are not read. Templates must be small letters.
    """
    rows = docs.select(F.col("doc_id"), whole().alias("text")).withColumn(
        # what rows alike share: two hashes and the length, never null
        "key", F.struct(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text").alias("h"),
                        F.crc32("text").alias("c"), F.length("text").alias("n")),
    )
    every = [*phrases, *templates]
    found = notices(rows.select("key", words_of(F.col("text")).alias("words")), every)
    start = F.when(F.col("phrase"), F.col("first_word"))
    told = found.groupBy("key").agg(
        F.count(start).alias("n_base"), F.min(start).cast("long").alias("first_word"), F.max(start).cast("long").alias("last_word"),
        _joined(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), _joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    counted = rows.select("doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"), "key")
    return counted.join(kept(told, "notices"), "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
