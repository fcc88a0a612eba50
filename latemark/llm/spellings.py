"""Spelling variants: words one edit apart, found by joining states with the edges of a trie.

The words are a trie: a node is a beginning of a word, an edge (node, letter, child) one more
letter. The edge table is distributed; nodes are known by a hash of their beginning. A state
(word, rest, node) says that the letters of ``word`` read so far, with one edit, lead to
``node``, and which are still to be read. One edit at a node gives the states: another letter
read, a letter of the trie put in, a letter of the word left out. From then on all states
advance one letter a round by a join with the edges on (node, letter), until their rest is
empty; where a word ends at the node, it is a neighbour. States that find no edge are gone, so
a round is smaller than the one before, and the rounds end when none is left.

Near the root nearly every edit leads on. So edits are made in the second half of a word only,
in one trie of the words and in one of the reversed words: of any edit, one of the two is in
the second half. Both tries share the tables; their nodes differ by a letter in the hash.
Neighbours are compared at the end, so a collision of hashes can add no pair.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import forget, kept, split_join, whole

#: Letters that make up runs.
LETTER = "[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run of letters in so many, by hash, loses a letter.
NOISE = 199
LETTERS, TIMES, RATIO = 6, 5, 5


def word_counts(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, noise: int = NOISE) -> DataFrame:
    """(word, n): words of at least ``letters`` code points that occur at least ``times`` times.

    Words are the runs of Latin letters of the texts, A-Z in small letters. Where the crc32 of
    ``doc_id:run`` is divisible by ``noise``, the run loses one code point. Null texts have no
    words; a null doc_id reads as nothing. Repeated rows count each.
    """
    # a run too short stays too short
    runs = F.regexp_extract_all(whole(), F.lit(f"{LETTER}{{{letters},}}"), 0)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.withColumn("run", F.translate("run", _UPPER, _LOWER))
    hash_ = F.crc32(F.concat_ws(":", "id", "run"))
    spot = F.pmod(hash_, F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), spot), F.substring(F.col("run"), spot + 2, F.length("run")))
    word = F.when(hash_ % noise == 0, cut).otherwise(F.col("run"))
    return (
        rows.select(word.alias("word")).filter(F.length("word") >= letters)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= times)
    )


def _node(side: Column, beginning: Column) -> Column:
    return F.xxhash64(side, beginning)


def _spelled(words: DataFrame) -> DataFrame:
    """(side, word, spelled): every word forwards and backwards."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("spelled")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("spelled")))
    return words.select("word", F.explode(sides).alias("s")).select("s.side", "word", "s.spelled")


def _edges(spelled: DataFrame) -> DataFrame:
    """(node, letter, child, m): the edges of both tries, with the number of words through each."""
    at = spelled.select("side", "spelled", F.explode(F.sequence(F.lit(1), F.length("spelled"))).alias("at"))
    before = F.substring(F.col("spelled"), F.lit(1), F.col("at") - 1)
    return at.select(
        _node(F.col("side"), before).alias("node"), F.substring(F.col("spelled"), F.col("at"), F.lit(1)).alias("letter"),
        _node(F.col("side"), F.substring(F.col("spelled"), F.lit(1), F.col("at"))).alias("child"),
    ).groupBy("node", "letter", "child").agg(F.count(F.lit(1)).alias("m"))


def _edited(spelled: DataFrame, edges: DataFrame) -> DataFrame:
    """(word, rest, node): all states right after their edit.

    Up to its edit a state is at the node of the word's own beginning, which is in the trie;
    so it starts where the second half does.
    """
    own = spelled.select(
        "word", "side", "spelled", F.length("spelled").alias("n"),
        F.explode(F.sequence(F.floor(F.length("spelled") / 2).cast("int"), F.length("spelled"))).alias("at"),
    )
    rest = F.substring(F.col("spelled"), F.col("at") + 1, F.col("n"))
    node = _node(F.col("side"), F.substring(F.col("spelled"), F.lit(1), F.col("at")))
    states = kept(own.select("word", rest.alias("rest"), node.alias("node")), "states")
    left_out = states.filter("rest <> ''").select("word", F.expr("substring(rest, 2)").alias("rest"), "node")
    # all letters that leave a node in one row, the letters of an alphabet at most
    leaving = edges.groupBy("node").agg(F.collect_list(F.struct("letter", "child")).alias("edges"), F.sum("m").alias("m"))
    met = split_join(states, kept(leaving, "leaving"), "node", "m").select("word", "rest", F.explode("edges").alias("e"))
    other = (F.col("rest") == "") | (F.col("e.letter") != F.substring("rest", 1, 1))
    both = F.when(F.col("rest") == "", F.array("rest")).otherwise(F.array(F.col("rest"), F.expr("substring(rest, 2)")))
    # a letter equal to the next one of the word is put in further on as well
    grown = met.filter(other).select("word", F.explode(both).alias("rest"), F.col("e.child").alias("node"))
    return grown.unionByName(left_out)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, other): ordered pairs of ``words`` (word, unique) that differ by one edit.

    An edit is one code point put in, left out or replaced.
    """
    spelled = _spelled(words.select("word"))
    edges = kept(_edges(spelled), "edges")
    ends = kept(spelled.select(_node(F.col("side"), F.col("spelled")).alias("node"), F.col("word").alias("other")), "ends")
    frontier, found = kept(_edited(spelled, edges), "frontier"), []
    while True:
        found.append(kept(frontier.filter("rest = ''").join(ends, "node").select("word", "other").distinct(), "met"))
        on = frontier.filter("rest <> ''")
        if on.isEmpty():
            break
        step = on.withColumn("letter", F.substring("rest", 1, 1)).join(edges.select("node", "letter", "child"), ["node", "letter"])
        after = kept(step.select("word", F.expr("substring(rest, 2)").alias("rest"), F.col("child").alias("node")), "frontier")
        forget(frontier)
        frontier = after
    pairs = kept(
        reduce(DataFrame.unionByName, found)
        .filter((F.col("word") != F.col("other")) & (F.levenshtein("word", "other") == 1)).distinct(),
        "pairs",
    )
    forget(frontier, edges, ends, *found)
    return pairs


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root) from kept ``forms`` (word, form): where the forms lead to.

    A form has more occurrences than its word, so there are no rings; each round doubles the
    steps that are made.
    """
    now = kept(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        times = now.groupBy("root").agg(F.count(F.lit(1)).alias("m")).withColumnRenamed("root", "at")
        further = kept(now.select(F.col("word").alias("at"), F.col("root").alias("next")).join(times, "at"), "further")
        if further.isEmpty():
            forget(further)
            return now
        # words of one root may be many, so the join is split by their number
        onward = split_join(now.withColumnRenamed("root", "at"), further, "at", "m", "left")
        after = kept(onward.select("word", F.coalesce("next", "at").alias("root")), "roots")
        forget(now, further)
        now = after


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``words`` (word, n; word unique).

    ``n_near`` counts the words one edit away. The form is the one of those with the greatest
    n, ties by the smaller word, if it occurs ``ratio`` times as often as the word or more.
    The root is where forms of forms lead to, the word itself without a form. Rows without a
    word are left out; an empty table gives none.
    """
    known = kept(words.filter(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = neighbours(known)
    best = pairs.join(known.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("first"),
    )
    joined = known.join(best, "word", "left").withColumn("top", -F.col("first.less"))
    formed = F.col("top") >= F.col("n") * ratio
    judged = kept(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("first.other")).alias("form"), F.when(formed, F.col("top")).alias("form_n"),
    ), "judged")
    roots = _rooted(judged.filter("form is not null"))
    forget(known, pairs)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The spelling groups of the words of all texts; see ``word_counts`` and ``spelling_groups``."""
    return spelling_groups(word_counts(docs))
