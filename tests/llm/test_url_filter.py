import math
from collections import Counter, defaultdict

import pytest

from latemark.llm.queries import URL_RULES
from latemark.llm.url_filter import END, FLOOR, ORDER, START, judged_urls, log_ratios
from latemark.llm.frames import kept


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


@pytest.fixture(scope="module")
def pages(spark, small):
    return spark.read.parquet(f"{small}/pages.parquet")


def test_rules_and_parts(spark):
    urls = [
        "http://A.Net/x", "http://net", "http://net/", "https://m.example.net/en/1", "http://example.net/en", "ftp://xexample.net/en/",
        "http://example.com/de/?q", "http://b.example.com/de", "http://org/fr/#a", "http://u.org/fr/b?c://d", "no url", None, "", "://",
        "http://É.NET/É/", "http://a.net?x=/en/", "http://a.net#/", "x://y://z.net/",
    ]
    rows = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in judged_urls(rows, URL_RULES).collect():
        host, path = split(urls[r["page_id"]])
        rule = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def brute_ratio(counts, gram):
    chances = []
    for side in (0, 1):
        p = FLOOR
        for k in range(ORDER + 1):
            key = gram[len(gram) - k - 1:]
            seen = defaultdict(int)
            for g, both in counts.items():
                if g[len(g) - k - 1:-1] == key[:-1]:
                    seen[g[-1]] += both[side]
            total, kinds = sum(seen.values()), sum(v > 0 for v in seen.values())
            if total:
                p = (seen[key[-1]] + kinds * p) / (total + kinds)
        chances.append(p)
    return math.log(chances[0]) - math.log(chances[1])


def test_smoothing_against_brute_force(spark):
    counts = {}
    for line, side, n in (("ab.net/en", 0, 2), ("abba.org", 1, 1), ("ba.net/fr", 1, 3), ("unseen", None, 1)):
        padded = START * ORDER + line + END
        for i in range(len(line) + 1):
            both = counts.setdefault(padded[i:i + ORDER + 1], [0, 0])
            if side is not None:
                both[side] += n
    rows = spark.createDataFrame([(g, a, b) for g, (a, b) in counts.items()], "gram string, good long, bad long")
    found = {r["gram"]: r["ratio"] for r in log_ratios(kept(rows, "counts")).collect()}
    assert found.keys() == counts.keys()
    for gram in counts:
        assert found[gram] == pytest.approx(brute_ratio(counts, gram), abs=1e-9)


def test_scores_are_means_and_ruled_urls_are_told_apart(spark, pages):
    found = judged_urls(pages, URL_RULES).collect()
    assert len(found) == pages.count()
    ruled = [(r["score"], r["verdict"]) for r in found if r["rule"]]
    good = [s for s, v in ruled if v == "allow"]
    bad = [s for s, v in ruled if v == "block"]
    assert sum(good) / len(good) > sum(bad) / len(bad) + 0.3


def test_layout_repeats_and_empty(spark, pages):
    twice = pages.select("page_id", "url").union(pages.select("page_id", "url")).repartition(5)
    one = {tuple(r) for r in judged_urls(twice, URL_RULES).drop("score").collect()}
    assert judged_urls(twice, URL_RULES).count() == 2 * pages.count()
    assert len(one) == pages.count()
    assert judged_urls(pages.limit(0), URL_RULES).count() == 0
    nulls = spark.createDataFrame([(1, None), (1, None), (None, None)], "page_id long, url string")
    assert {r["verdict"] for r in judged_urls(nulls, URL_RULES).collect()} == {"allow"}


def test_very_long_urls_and_clashing_columns(spark):
    """Whole URLs are scored, and columns called like those of the method change nothing."""
    long_ = "http://shop.example.org/" + "a-page/" * 3000
    urls = [f"http://a{i}.net/buy/{i}" for i in range(40)] + [f"http://b{i}.org/fr/read-{i}" for i in range(40)]
    urls += [long_ + "buy/", long_ + "read-read-read", long_ + "buy/", "http://z.net/" + "x" * 20_000, None, ""]
    clashing = [f"{c} string" for c in ("host", "path", "rule", "verdict", "score", "line", "id", "taught", "gram", "ratio", "n", "good")]
    plain = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    wide = spark.createDataFrame(
        [(i, u, *["x"] * len(clashing)) for i, u in enumerate(urls)], ", ".join(["page_id long", "url string", *clashing])
    )
    one, other = ({r["page_id"]: r for r in judged_urls(t, URL_RULES).collect()} for t in (plain, wide))
    assert set(one) == set(range(len(urls))) and all(r["score"] is not None for r in one.values())
    for i, r in one.items():
        host, path = split(urls[i])
        rule = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert [r[c] for c in ("host", "path", "rule", "verdict")] == [other[i][c] for c in ("host", "path", "rule", "verdict")]
        assert other[i]["score"] == pytest.approx(r["score"], abs=1e-9)
    assert one[80]["score"] == one[82]["score"] != one[81]["score"]
