"""Order MinHash: fingerprints of texts that tell how close they are in edits.

The letters of a text are its words, cut at white space; a k-mer is ``K`` words in a row and
carries its occurrence number, 0 for the first time it stands in the text. Sketch i orders
all numbered k-mers by a hash of its own, draws the least one from either half of the hash
values, puts the two in the order in which they stand in the text and hashes the pair. Equal
entries of two fingerprints are those where the same k-mers won and kept their order, so
moved text costs likeness and not only changed text. All of it is column expressions: arrays
for words and occurrence numbers, then one explode that an aggregation of minima takes in
where it is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.llm.frames import kept, whole, with_totals

K = 3
SKETCHES = 32
#: Places in the text take the low bits of a minimum, its hash the rest.
PLACE_BITS = 30
NO_ID = -(1 << 63)


def numbered_kmers(text: str) -> str:
    """SQL: array of (g: hash of k-mer and occurrence number, p: place) of a text column."""
    words = f"filter(split({text}, '[\\\\s]+'), w -> w <> '')"
    hashes = f"""transform(array({words}), w -> if(size(w) = 0, cast(array() as array<bigint>),
        transform(sequence(0, greatest(size(w) - {K}, 0)), i -> xxhash64({', '.join(f'get(w, i + {j})' for j in range(K))}))))[0]"""
    sorted_ = "array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))"
    runs = "filter(sequence(0, size(s) - 1), j -> j = 0 or s[j].x <> s[j - 1].x)"
    counted = f"""transform(array({sorted_}), s -> transform(array({runs}), r -> flatten(transform(r, (a, n) ->
        transform(sequence(a, coalesce(get(r, n + 1), size(s)) - 1),
            j -> named_struct('g', xxhash64(s[j].x, j - a), 'p', s[j].i)))))[0])[0]"""
    plain = "transform(h, (x, i) -> named_struct('g', xxhash64(x, 0), 'p', i))"
    return f"transform(array({hashes}), h -> if(size(array_distinct(h)) = size(h), {plain}, {counted}))[0]"


def _minima() -> list[Column]:
    found = []
    for i in range(SKETCHES):
        hashed = f"xxhash64(g, {i})"
        packed = f"(({hashed} & {((1 << 62) - 1) & ~((1 << PLACE_BITS) - 1)}L) | p)"
        for half, test in enumerate((">= 0", "< 0")):
            found.append(F.expr(f"min(if({hashed} {test}, {packed}, {(1 << 63) - 1}L))").alias(f"m{i}_{half}"))
    return found


def _entries() -> Column:
    """The fingerprint from the minima: four bytes for each sketch."""
    parts = []
    for i in range(SKETCHES):
        a, b = (f"(m{i}_{half} >> {PLACE_BITS})" for half in (0, 1))
        places = [f"(m{i}_{half} & {(1 << PLACE_BITS) - 1}L)" for half in (0, 1)]
        first = f"{places[0]} <= {places[1]}"
        parts.append(f"lpad(hex(xxhash64(if({first}, {a}, {b}), if({first}, {b}, {a}), {first}) & 4294967295L), 8, '0')")
    return F.unhex(F.expr(f"concat({', '.join(parts)})"))


def fingerprints(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, fingerprint) of ``texts`` (keys, text); rows of equal keys count as one text.

    A null or empty text, or one of white space, has the fingerprint of no k-mers.
    """
    rows = texts.select(*keys, F.expr(f"explode_outer({numbered_kmers('text')})").alias("k"))
    flat = rows.select(*keys, F.col("k.g").alias("g"), F.coalesce(F.col("k.p"), F.lit(0)).cast("long").alias("p"))
    # a text without k-mers has one row of null g, whose hash is the seed's: the same for all such
    return flat.groupBy(*keys).agg(*_minima()).select(*keys, _entries().alias("fingerprint"))


def likeness(one: Column, other: Column) -> Column:
    """Share of equal entries of two fingerprints."""
    equal = [(F.substring(one, 4 * i + 1, 4) == F.substring(other, 4 * i + 1, 4)).cast("int") for i in range(SKETCHES)]
    total = equal[0]
    for e in equal[1:]:
        total = total + e
    return total / F.lit(float(SKETCHES))


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited forms, and the likeness to both neighbours.

    The next document is the one before in the order of (doc_id, text hash), null ids first;
    after the first comes the last. The edited text has the last half of the code points
    replaced by the beginning of the next document. Rows alike in id and text are one text
    here; each but one of them has a copy of itself as its next document. Null texts count as
    empty. Other columns are not read.
    """
    texts = docs.select("doc_id", whole().alias("text")).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("h"), "doc_id", "text"
    )
    ids = texts.groupBy("id", "h").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("text")).cast("long").alias("n_chars")
    )
    order = kept(
        with_totals(ids.withColumn("one", F.lit(1).cast("long")), ["id", "h"], "one", "number"), "order"
    )
    rows, classes = order.agg(F.sum("n"), F.count(F.lit(1))).first()
    classes = max(classes, 1)
    # each class, and the class whose next document it is
    after = F.pmod(F.col("number") + 1, F.lit(classes))
    takers = order.select(
        F.col("number").alias("number"), F.col("id").alias("to_id"), F.col("h").alias("to_h"),
        F.expr("n_chars div 2").alias("need"),
    )
    pairs = order.withColumn("after", after).join(takers.withColumnRenamed("number", "after"), "after")
    pairs = kept(pairs.select("id", "h", "n", "n_chars", "to_id", "to_h", "need"), "pairs")
    once = texts.dropDuplicates(["id", "h"]) if (rows or 0) > classes else texts
    known = once.select("id", "h", "doc_id", "text").join(pairs.hint("merge"), ["id", "h"])
    # what each hands on: the beginning of its text to the class it follows, to itself if repeated
    given = known.select(
        F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.lit(1).alias("kind"),
        F.expr("left(text, cast(need as int))").alias("lent"),
    )
    edited = known.join(given.hint("merge"), ["id", "h"])
    own_half = F.expr("left(text, cast(n_chars - n_chars div 2 as int))")
    own_lent = F.expr("left(text, cast(n_chars div 2 as int))")
    bodies = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.concat(own_half, "lent").alias("text")),
        F.struct(F.lit(2).alias("kind"), F.when(F.col("n") > 1, F.concat(own_half, own_lent)).alias("text")),
    )
    forms = edited.select("id", "h", "n", "n_chars", F.explode(bodies).alias("body")).filter(
        "body.kind < 2 or n > 1"
    ).select("id", "h", "n", "n_chars", "body.kind", "body.text", F.unhex(F.sha2(F.col("body.text").cast("binary"), 256)).alias("sha"))
    marked = kept(fingerprints(forms, "id", "h", "n", "n_chars", "kind", "sha"), "marks")
    by_kind = [marked.filter(F.col("kind") == k) for k in range(3)]
    own = by_kind[0].select("id", "h", "n", "n_chars", "fingerprint")
    links = pairs.select(F.col("to_id").alias("id"), F.col("to_h").alias("h"), F.col("id").alias("next_id"), F.col("h").alias("next_h"))
    nexts = own.select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_fingerprint"))
    changed = own.join(
        by_kind[1].union(by_kind[2]).select("id", "h", "kind", F.col("sha").alias("edited_sha256"), F.col("fingerprint").alias("edited_fingerprint")),
        ["id", "h"],
    ).join(links, ["id", "h"]).join(nexts, ["next_id", "next_h"])
    times = F.when(F.col("kind") == 1, F.lit(1).cast("long")).otherwise(F.col("n") - 1)
    return changed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        F.when(F.col("kind") == 2, F.lit(1.0)).otherwise(likeness(F.col("fingerprint"), F.col("next_fingerprint"))).alias("near_next"),
    )
