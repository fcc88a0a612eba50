"""SQL twins, for DuckDB, of the queries that SQL can tell.

Hashes of 64 bits, tokenizers, trained models and suffix sorting have no equal there; those
queries are held against brute force by the tests.
"""

from __future__ import annotations

from latemark.llm.licenses import COVERED, DRIFT, NOTICES, PHRASES, STRETCH

HARD_NEGATIVES = """
WITH part AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM part
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


def _license_scan() -> str:
    rows = ", ".join(
        f"({i}, '{t.label}', {t.phrase}, '{t.text}')" for i, t in enumerate([*PHRASES, *NOTICES])
    )
    return f"""
WITH templates AS (
    SELECT t, label, phrase, string_split(body, ' ') AS w FROM (VALUES {rows}) v(t, label, phrase, body)
), template_grams AS (
    SELECT t, label, phrase, len(w) AS length, unnest(range(len(w) - 1)) AS place, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM templates
), texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM documents
), grams AS (
    SELECT r, unnest(range(len(w) - 1)) AS here, unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM texts WHERE len(w) > 1
), voted AS (
    SELECT r, t, label, phrase, length, here - place AS diagonal, list(place) AS places
    FROM grams JOIN template_grams USING (a, b) GROUP BY ALL
), phrases AS (
    SELECT r, label, diagonal AS first_word FROM voted WHERE phrase AND len(places) = length - 1
), stepped AS (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, t ORDER BY diagonal) <= {DRIFT} THEN 0 ELSE 1 END AS far
    FROM voted WHERE NOT phrase
), ran AS (
    SELECT *, sum(far) OVER (PARTITION BY r, t ORDER BY diagonal) AS run FROM stepped
), merged AS (
    SELECT r, t, label, length, run, min(diagonal + list_min(places)) AS first_word, max(diagonal + list_max(places) + 2) AS end_word,
           list_distinct(flatten(list(list_concat(places, list_transform(places, lambda x: x + 1))))) AS held
    FROM ran GROUP BY r, t, label, length, run
), verified AS (
    SELECT *, len(held) AS words FROM merged
    WHERE len(held) / length >= {COVERED} AND end_word - first_word <= length * {STRETCH}
), spots AS (
    SELECT *, CASE WHEN first_word < max(end_word) OVER (PARTITION BY r ORDER BY first_word, end_word, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
    FROM verified
), rivals AS (
    SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY first_word, end_word, t) AS spot FROM spots
), best AS (
    SELECT r, label, words / length AS share FROM rivals QUALIFY words = max(words) OVER (PARTITION BY r, spot)
), base AS (
    SELECT r, count(*) AS n_base, min(first_word) AS first_word, max(first_word) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM phrases GROUP BY r
), every AS (
    SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM (SELECT r, label, 1.0::DOUBLE AS share FROM phrases UNION ALL SELECT r, label, share::DOUBLE FROM best) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0::DOUBLE) AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN every USING (r)
"""


SPELLINGS = """
WITH RECURSIVE bits AS (
    SELECT b, 0 AS step, b::BIGINT AS c FROM range(256) t(b)
    UNION ALL
    SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM bits WHERE step < 8
), steps AS (
    SELECT list(c ORDER BY b) AS s FROM bits WHERE step = 8
), runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS code FROM runs WHERE length(run) >= 6 GROUP BY id, run
), hashed AS (
    SELECT run, times, xor(4294967295::BIGINT, list_reduce(
               list_transform(range(1, len(code) // 2 + 1), lambda i: CAST(strpos('0123456789ABCDEF', code[2 * i - 1]) * 16 + strpos('0123456789ABCDEF', code[2 * i]) - 17 AS BIGINT)),
               lambda c, b: xor(c >> 8, s[1 + CAST(xor(c, b) & 255 AS INTEGER)]), 4294967295::BIGINT)) AS h
    FROM counted, steps
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word,
           sum(times) AS n
    FROM hashed GROUP BY 1
), known AS (
    SELECT word, CAST(n AS BIGINT) AS n FROM words WHERE length(word) >= 6 AND n >= 5
), cuts AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM known
), holes AS (
    SELECT word, n, substr(word, 1, p - 1) || '*' || substr(word, p + 1) AS hole, substr(word, 1, p - 1) || substr(word, p + 1) AS less FROM cuts
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN known b ON a.less = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN known b ON a.less = b.word
), near AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS form, max(n) AS form_n FROM pairs GROUP BY word
), judged AS (
    SELECT k.word, k.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * k.n THEN form END AS form,
           CASE WHEN form_n >= 5 * k.n THEN form_n END AS form_n
    FROM known k LEFT JOIN near USING (word)
), led AS (
    SELECT word, word AS at FROM judged
    UNION ALL
    SELECT led.word, j.form FROM led JOIN judged j ON j.word = led.at WHERE j.form IS NOT NULL
), roots AS (
    SELECT led.word, led.at AS root FROM led JOIN judged j ON j.word = led.at WHERE j.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""

SHARDING_SIZES = """
SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, least(16, count(*) OVER ()) AS shards, true AS even, true AS gapless
FROM documents
"""

URL_RULES = """
WITH parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)
), rules AS (
    SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) v(verdict, h, p)
), fits AS (
    SELECT page_id, h || p AS rule, verdict FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1
)
SELECT page_id, host, path, rule, verdict AS ruled FROM parts LEFT JOIN fits USING (page_id)
"""

#: Windows of 200 bytes by a hash of 64 bits, runs of covered bytes by gaps between them.
REPEATS_REMOVED = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, strlen(coalesce(text, '')) AS n_bytes, hex(encode(coalesce(text, ''))) AS code FROM documents
), windows AS (
    SELECT r, here, hash(substr(code, 2 * here + 1, 400)) AS h FROM (SELECT r, code, unnest(range(n_bytes - 199)) AS here FROM texts WHERE n_bytes >= 200)
), repeated AS (
    SELECT r, here FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
), begun AS (
    SELECT r, here, CASE WHEN here - lag(here) OVER (PARTITION BY r ORDER BY here) <= 200 THEN 0 ELSE 1 END AS fresh FROM repeated
), spans AS (
    SELECT r, span, max(here) + 200 - min(here) AS size FROM (SELECT r, here, sum(fresh) OVER (PARTITION BY r ORDER BY here) AS span FROM begun) GROUP BY r, span
), removed AS (
    SELECT r, sum(size) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM texts LEFT JOIN removed USING (r)
"""

ORACLES: dict[str, str] = {
    "sharding_sizes": SHARDING_SIZES,
    "url_rules": URL_RULES,
    "repeats_removed": REPEATS_REMOVED,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_license_scan": _license_scan(),
    "op13_spelling_variants": SPELLINGS,
}
