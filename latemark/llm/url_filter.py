"""URL filter: rules first, then the ratio of two character models of URLs.

URLs that a rule allows or blocks teach two Markov models of their characters. Each model
mixes the orders 0..4 by Witten-Bell weights, so a context counts by how much it was seen and
an unseen one gives way to the next shorter. The score of a URL is the mean over its
characters of log P(accepted) - log P(rejected). The limit between allow and block is the one
with the least sum of both error rates on a fifth of the ruled URLs, which the models have
not seen. Model tables are ordinary tables that grow with the corpus, joined on the
characters; character strings in a large share of all URLs are joined apart by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latemark.llm.frames import kept, split_join

ORDER = 4
START, END = "\u0002", "\u0003"
#: Fixed value: chance of a character before anything is counted.
FLOOR = 1.0 / 1024
FOLDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def longest_rule(rules: list[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits host and path, else null."""
    chosen = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        host = F.col("host")
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith("path", F.lit(rule.path))
        chosen = F.when(fits, value(rule)) if chosen is None else chosen.when(fits, value(rule))
    return chosen if chosen is not None else F.lit(None).cast("string")


def spelled(url: Column) -> Column:
    """What the models read: host in lower case and all that follows, runs of digits as 0."""
    tail = F.regexp_replace(F.coalesce(_rest(url), url, F.lit("")), "^[^/?#]*", "")
    head = F.when(F.instr(url, "://") > 0, host_of(url)).otherwise(F.regexp_extract(F.coalesce(url, F.lit("")), "^[^/?#]*", 0))
    return F.regexp_replace(F.concat(head, tail), "[0-9]+", "0")


def strings(lines: DataFrame, *columns: str) -> DataFrame:
    """One row for each character of ``line`` and its end, with the ``ORDER`` characters before."""
    padded = F.concat(F.lit(START * ORDER), F.col("line"), F.lit(END))
    return lines.withColumn("__padded", padded).select(
        *columns,
        F.explode(F.expr(f"transform(sequence(1, length(__padded) - {ORDER}), i -> substring(__padded, i, {ORDER + 1}))")).alias("gram"),
    )


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, ratio) from kept (gram, good, bad): log P(good) - log P(bad) of its last character."""
    orders = F.expr(f"explode(transform(sequence(0, {ORDER}), k -> named_struct('k', k, 'key', right(gram, k + 1))))")
    keys = kept(
        counts.select(orders.alias("o"), "good", "bad")
        .groupBy(F.col("o.k").alias("k"), F.col("o.key").alias("key"))
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")),
        "orders",
    )
    alike = Window.partitionBy("__before")
    chances = None
    for k in range(ORDER + 1):
        level = keys.filter(F.col("k") == k).withColumn("__before", F.expr("left(key, length(key) - 1)"))
        for name in ("good", "bad"):
            level = level.withColumn(f"__{name}_all", F.sum(name).over(alike)).withColumn(
                f"__{name}_kinds", F.sum((F.col(name) > 0).cast("long")).over(alike)
            )
        if chances is not None:
            shorter = chances.select(F.col("key").alias("__shorter"), F.col("p_good").alias("l_good"), F.col("p_bad").alias("l_bad"))
            level = level.join(shorter, F.expr("substring(key, 2)") == F.col("__shorter"))
        else:
            level = level.withColumn("l_good", F.lit(FLOOR)).withColumn("l_bad", F.lit(FLOOR))
        chances = level.select("key", *[
            F.when(F.col(f"__{n}_all") > 0, (F.col(n) + F.col(f"__{n}_kinds") * F.col(f"l_{n}"))
                   / (F.col(f"__{n}_all") + F.col(f"__{n}_kinds"))).otherwise(F.col(f"l_{n}")).alias(f"p_{n}")
            for n in ("good", "bad")
        ])
    return chances.select(F.col("key").alias("gram"), (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def limit_of(scored: DataFrame) -> float:
    """The score with least sum of error rates over (score, taught, n); 0 where a class is missing."""
    bins = scored.select((F.round(F.greatest(F.lit(-10.0), F.least(F.lit(10.0), "score")) * 100)).cast("int").alias("bin"), "taught", "n")
    sums = bins.groupBy("bin").agg(*[F.sum(F.when(F.col("taught") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")])
    table = sorted((r["bin"], r["allow"], r["block"]) for r in sums.collect())  # 2,001 rows at most
    good, bad = sum(r[1] for r in table), sum(r[2] for r in table)
    if not good or not bad:
        return 0.0
    best, lost, passed = (2.0, 0.0), 0, bad
    errors = [(passed / bad + lost / good, table[0][0])]
    for at, (_, allow, block) in enumerate(table):
        lost, passed = lost + allow, passed - block
        above = table[at + 1][0] if at + 1 < len(table) else table[at][0] + 1
        errors.append((lost / good + passed / bad, (table[at][0] + above) / 2))
    best = min(errors, key=lambda e: (round(e[0], 12), abs(e[1])))
    return best[1] / 100


def judged_urls(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    ``rule`` and the score's model come from ``rules``; ``verdict`` is the rule's, else allow
    where the score is at or above the limit. Null URLs and those without ``://`` have an empty
    host and path; a null or empty URL scores by its end alone. Without ruled URLs of both
    kinds the limit is 0. Repeated rows give repeated results; other columns are not read.
    """
    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = kept(
        read.select(
            "page_id", "host", "path", spelled(F.col("url")).alias("line"),
            longest_rule(rules, lambda r: F.lit(r.text)).alias("rule"),
            longest_rule(rules, lambda r: F.lit(r.verdict)).alias("taught"),
        ).withColumn("id", F.md5("line")),
        "urls",
    )
    lines = kept(rows.groupBy("id", "line", "taught").agg(F.count(F.lit(1)).alias("n")), "lines")
    fold = F.pmod(F.xxhash64("id"), F.lit(FOLDS))
    taught = F.when(fold > 0, F.col("taught"))
    counts = kept(
        strings(lines.withColumn("taught", taught), "taught", "n").groupBy("gram").agg(
            F.sum(F.when(F.col("taught") == "allow", F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("taught") == "block", F.col("n")).otherwise(0)).alias("bad"),
            F.count(F.lit(1)).alias("rows"),
        ),
        "grams",
    )
    ratios = kept(log_ratios(counts).join(counts.select("gram", "rows"), "gram"), "ratios")
    marks = split_join(strings(lines, "id"), ratios, "gram", "rows")
    scores = kept(
        marks.groupBy("id").agg(F.avg("ratio").alias("score"))
        .join(lines.select("id", "taught", "n"), "id"),
        "scores",
    )
    limit = limit_of(scores.filter(F.col("taught").isNotNull() & (fold == 0)))
    whole = kept(scores.groupBy("id").agg(F.first("score").alias("score"), F.sum("n").alias("n")), "whole")
    return split_join(rows, whole, "id", "n").select(
        "page_id", "host", "path", "rule",
        F.coalesce("taught", F.when(F.col("score") >= limit, "allow").otherwise("block")).alias("verdict"), "score",
    )
