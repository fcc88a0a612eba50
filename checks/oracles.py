"""DuckDB twins of the registered queries, written from the definitions.

``legs``, ``cleaned``, ``train`` and ``test`` are the common steps; a statement names the
ones it needs. Queries without an entry are checked by their row count only.
"""

from __future__ import annotations

LEGS_SQL = """
legs AS (
  SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
         CAST(day(l_shipdate) AS INT) AS day, CAST(isodow(l_shipdate) AS INT) AS dayofweek,
         CASE WHEN l_linenumber = 7 AND l_quantity <= 5 THEN NULL ELSE o_orderpriority END AS carrier,
         l_suppkey AS origin_id,
         CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01 00:00:00' AND c_nationkey = 24
              THEN 99 ELSE c_nationkey END AS dest_id,
         CAST((l_orderkey % 24) * 100 + (l_partkey % 60) AS INT) AS sched_hhmm,
         l_extendedprice AS distance, l_quantity AS sched_elapsed,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount * 100 END AS taxi_out,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE l_quantity * 3 END AS air_time,
         CASE WHEN l_linenumber = 1 AND l_quantity > 45 THEN NULL ELSE
              CAST(((l_partkey * 31 + l_orderkey * 17) % 60) - 45 + 3 * floor((l_orderkey % 24) / 6.0)
                   + 2 * CAST(substr(o_orderpriority, 1, 1) AS INT) AS DOUBLE) END AS delay,
         CASE WHEN l_returnflag = 'R' AND l_quantity <= 5 THEN 1 ELSE 0 END AS cancelled,
         CASE WHEN l_tax > 0.075 AND l_linestatus = 'F' THEN 1 ELSE 0 END AS diverted
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

LEFT_OUT = "((year = 1998 AND month >= 3) OR year = 1999 OR (year = 2000 AND month <= 6))"

CLEANED_SQL = LEGS_SQL + f""",
cleaned AS (
  SELECT year, month, day, dayofweek, sched_hhmm, distance, sched_elapsed, carrier, origin_id,
         dest_id, taxi_out, air_time, CAST(CASE WHEN delay >= 15 THEN 1 ELSE 0 END AS INT) AS label
  FROM legs
  WHERE cancelled = 0 AND diverted = 0 AND delay IS NOT NULL AND year >= 1995 AND NOT {LEFT_OUT}
    AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND dayofweek IS NOT NULL
    AND sched_hhmm IS NOT NULL AND distance IS NOT NULL AND sched_elapsed IS NOT NULL
    AND carrier IS NOT NULL AND origin_id IS NOT NULL AND dest_id IS NOT NULL
)"""

SPLIT_SQL = CLEANED_SQL + """,
years AS (
  SELECT year, row_number() OVER (ORDER BY year) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT DISTINCT year FROM cleaned)
),
cut AS (SELECT year AS first_test_year FROM years WHERE place = greatest(1, CAST(floor(n * 0.8) AS INT))),
train AS (SELECT cleaned.* FROM cleaned, cut WHERE year < first_test_year),
test AS (SELECT cleaned.* FROM cleaned, cut WHERE year >= first_test_year)"""

CLEAN_COLUMNS = (
    "year", "month", "day", "dayofweek", "sched_hhmm", "distance", "sched_elapsed", "carrier",
    "origin_id", "dest_id", "taxi_out", "air_time", "label",
)
DOUBLES = ("distance", "sched_elapsed", "taxi_out", "air_time", "delay")
NUMERIC = ("year", "month", "day", "dayofweek", "sched_hhmm", "distance", "sched_elapsed")
CATEGORICAL = ("carrier", "origin_id", "dest_id")
FEATURES = (*NUMERIC, *[f"{c}_freq" for c in CATEGORICAL])
WEIGHTS = (0.1, -0.2, 0.05, 0.0, 0.3, -0.1, 0.02, 0.2, -0.05, 0.15)
BIAS = -0.4
STEPS, RATE = 100, 0.1


def r6(expression: str, alias: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {alias}"


def picked(names, prefix: str = "") -> str:
    return ", ".join(r6(prefix + n, n) if n in DOUBLES else prefix + n for n in names)


ALL_CLEAN = picked(CLEAN_COLUMNS)

# place of a row in [0, 2^32) by the md5 of its columns
DIGEST = "md5(concat_ws('|', '42', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in CLEAN_COLUMNS) + "))"
POSITION = f"CAST('0x' || substr({DIGEST}, 1, 8) AS BIGINT)"
PLACES = 4294967296
# the same over the columns that a job has left after cleaning
JOB_DIGEST = "md5(concat_ws('|', '42', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in (*NUMERIC, *CATEGORICAL, "label")) + "))"
JOB_POSITION = f"CAST('0x' || substr({JOB_DIGEST}, 1, 8) AS BIGINT)"

CALENDAR_SQL = """
  CAST(trunc(sched_hhmm / 100.0) AS INT) AS dep_hour,
  CASE WHEN sched_hhmm < 600 THEN 0 WHEN sched_hhmm < 1200 THEN 1 WHEN sched_hhmm < 1700 THEN 2
       WHEN sched_hhmm < 2100 THEN 3 ELSE 4 END AS dep_period,
  CASE WHEN dayofweek IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month IN (12, 1, 2) THEN 0 WHEN month IN (3, 4, 5) THEN 1
       WHEN month IN (6, 7, 8) THEN 2 ELSE 3 END AS season,
  CAST(origin_id AS VARCHAR) || '-' || CAST(dest_id AS VARCHAR) AS route"""

RATES = {
    "carrier": "airline_delay_rate", "origin_id": "origin_delay_rate", "dest_id": "dest_delay_rate",
    "route": "route_delay_rate", "dep_hour": "hour_delay_rate", "month": "month_delay_rate",
}

TREE_PARTS_SQL = SPLIT_SQL + f""",
ctrain AS (SELECT *, {CALENDAR_SQL} FROM train),
ctest AS (SELECT *, {CALENDAR_SQL} FROM test)"""

RATE_TABLES_SQL = TREE_PARTS_SQL + "".join(
    f",\nt_{key} AS (SELECT {key} AS k, avg(label) AS rate FROM ctrain GROUP BY {key})" for key in RATES
) + ",\noverall AS (SELECT avg(label) AS rate FROM ctrain)"

RATE_JOINS = " ".join(f"LEFT JOIN t_{key} ON ctest.{key} = t_{key}.k" for key in RATES)
RATE_COLUMNS = ", ".join(
    r6(f"coalesce(t_{key}.rate, (SELECT rate FROM overall))", name) for key, name in RATES.items()
)
MEDIAN_TABLES = """
medians AS (SELECT route AS mr, quantile_disc(taxi_out, 0.5) AS taxi_m, quantile_disc(air_time, 0.5) AS air_m
            FROM ctrain GROUP BY route),
median_all AS (SELECT quantile_disc(taxi_out, 0.5) AS taxi_m, quantile_disc(air_time, 0.5) AS air_m FROM ctrain)"""
MEDIAN_COLUMNS = (
    r6("coalesce(taxi_out, medians.taxi_m, (SELECT taxi_m FROM median_all))", "taxi_out_clean") + ", "
    + r6("coalesce(air_time, medians.air_m, (SELECT air_m FROM median_all))", "air_time_clean")
)

FREQUENCY_SQL = SPLIT_SQL + "".join(
    f",\nf_{c} AS (SELECT {c} AS k, count(*) AS n FROM train GROUP BY {c})" for c in CATEGORICAL
)
FREQUENCY_JOINS = " ".join(f"LEFT JOIN f_{c} ON {c} = f_{c}.k" for c in CATEGORICAL)
FREQUENCY_COLUMNS = ", ".join(f"coalesce(f_{c}.n, 0) AS {c}_freq" for c in CATEGORICAL)
FREQUENCY_OUT = picked(("year", "month", "day", "dayofweek", "sched_hhmm", "distance", "sched_elapsed",
                        "taxi_out", "air_time", "label"))

SCALED_SQL = FREQUENCY_SQL + f""",
etrain AS MATERIALIZED (SELECT train.*, {FREQUENCY_COLUMNS} FROM train {FREQUENCY_JOINS}),
etest AS (SELECT test.*, {FREQUENCY_COLUMNS} FROM test {FREQUENCY_JOINS}),
stats AS (SELECT {", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)} FROM etrain),
strain AS MATERIALIZED (SELECT label, {", ".join(f"({f} - m_{f}) / s_{f} AS x{i}" for i, f in enumerate(FEATURES))}
  FROM etrain, stats),
stest AS (SELECT label, {", ".join(f"({f} - m_{f}) / s_{f} AS x{i}" for i, f in enumerate(FEATURES))}
  FROM etest, stats)"""

NX = len(FEATURES)
XS = [f"x{i}" for i in range(NX)]
WS = [f"w{i}" for i in range(NX)]
FIXED_MARGIN = " + ".join([f"({BIAS})", *[f"x{i} * ({w})" for i, w in enumerate(WEIGHTS)]])


def descent_sql(weighted: bool) -> str:
    """Common steps plus ``final``: one row b, w0 … after all iterations."""
    ratio = (
        "(SELECT count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE) FROM strain)"
        if weighted else "1.0"
    )
    margin = " + ".join(["b", *[f"{x} * {w}" for x, w in zip(XS, WS)]])
    rate = f"CAST({RATE} AS DOUBLE)"
    moves = ", ".join(f"{w} - {rate} * sum(err * {x}) / count(*)" for w, x in zip(WS, XS))
    return "WITH RECURSIVE " + SCALED_SQL + f""",
weighted AS MATERIALIZED (
  SELECT *, CASE WHEN label = 1 THEN CAST({ratio} AS DOUBLE) ELSE 1.0 END AS rw FROM strain),
descent AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS b, {", ".join(f"CAST(0 AS DOUBLE) AS {w}" for w in WS)}
  UNION ALL
  SELECT step + 1, b - {rate} * sum(err) / count(*), {moves}
  FROM (SELECT descent.*, {", ".join(XS)}, (1.0 / (1.0 + exp(-({margin}))) - label) * rw AS err
        FROM descent, weighted WHERE step < {STEPS})
  GROUP BY step, b, {", ".join(WS)}
),
final AS (SELECT * FROM descent WHERE step = {STEPS})"""


def coefficients_sql(weighted: bool) -> str:
    lines = [f"SELECT 'bias' AS feature, {r6('b', 'weight')} FROM final"]
    lines += [f"SELECT '{f}', {r6(w, 'weight')} FROM final" for f, w in zip(FEATURES, WS)]
    return descent_sql(weighted) + "\n" + "\nUNION ALL ".join(lines)


CLOCK_SQL = CLEANED_SQL + """,
scored AS (SELECT label, sched_hhmm / CAST(2400 AS DOUBLE) AS probability,
                  CAST(CASE WHEN sched_hhmm / CAST(2400 AS DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS INT) AS prediction
           FROM cleaned)"""

# from ``scored``: tie groups, ranking metrics and threshold metrics
MEASURES_SQL = """,
ties AS (SELECT probability AS s, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS p,
                CAST(count(*) FILTER (label = 0) AS DOUBLE) AS q FROM scored GROUP BY probability),
curve AS (SELECT s, p, q, sum(p) OVER (ORDER BY s DESC) AS cp, sum(q) OVER (ORDER BY s DESC) AS cq,
                 sum(p) OVER () AS np, sum(q) OVER () AS nq FROM ties),
ranked AS (SELECT label, rank() OVER (ORDER BY probability DESC) AS r FROM scored),
ranks AS (SELECT sum(q * (cp - p / 2)) / max(np * nq) AS auc, sum(p / np * cp / (cp + cq)) AS ap,
                 CAST(max(np) AS BIGINT) AS positives, CAST(max(nq) AS BIGINT) AS negatives FROM curve),
ranksum AS (SELECT (CAST(sum(r) AS DOUBLE) - max(positives) * (max(positives) + 1) / 2.0)
                   / (max(positives) * CAST(max(negatives) AS DOUBLE)) AS stat
            FROM ranked, ranks WHERE label = 1),
counts AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                  count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
                  CAST(count(*) AS DOUBLE) AS n FROM scored),
pr AS (SELECT *, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p1, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r1,
              coalesce(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 0) AS p0, coalesce(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 0) AS r0 FROM counts),
prf AS (SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0 FROM pr),
measures AS (SELECT *, (tp + tn) / n AS acc, (p1 * (tp + fn) + p0 * (tn + fp)) / n AS wp,
                    (r1 * (tp + fn) + r0 * (tn + fp)) / n AS wr, (f1 * (tp + fn) + f0 * (tn + fp)) / n AS wf FROM prf)"""

CLOCK_DOCUMENT = "WITH " + CLOCK_SQL + MEASURES_SQL + f"""
SELECT 'clock' AS model, 'baseline' AS mode, CAST(n AS BIGINT) AS test_rows, {r6("auc", "auc")},
       {r6("stat", "auc_desc_rank")}, {r6("ap", "average_precision")}, {r6("acc", "accuracy")}, {r6("wf", "f1")},
       {r6("wp", "weighted_precision")}, {r6("wr", "weighted_recall")},
       CAST((tp > 0)::INT + (fp > 0)::INT + (tn > 0)::INT + (fn > 0)::INT AS INT) AS cells, CAST(n AS BIGINT) AS confusion_rows
FROM measures, ranks, ranksum"""

CONFUSION = "WITH " + CLOCK_SQL + " SELECT label, prediction, count(*) AS count FROM scored GROUP BY label, prediction"
LATE_OK = "SELECT true AS ok"

FLIGHT_COLUMNS = f"""year, month, day, dayofweek, carrier AS airline, CAST(origin_id AS INT) AS origin_airport_id,
  dest_id AS dest_airport_id, {r6("delay", "departure_delay")}, {r6("delay", "departure_delay_mins")},
  {r6("taxi_out", "taxi_out")}, {r6("sched_elapsed", "scheduled_elapsed_time")}, {r6("air_time", "air_time")},
  {r6("distance", "distance")}, cancelled, diverted, sched_hhmm AS crsdeptime"""
# columns of the raw file that legs do not have
EMPTY_COLUMNS = {
    "VARCHAR": (
        "formatted_date", "flight_number", "tail_number", "iata_code_reporting_airline", "departure_time_hhmm",
        "wheels_off_hhmm", "wheels_on_hhmm", "scheduled_arrival_hhmm", "arrival_time_hhmm", "cancellation_code",
        "crs_dep_time_hhmm", "crs_dep_time",
    ),
    "DOUBLE": (
        "elapsed_time", "taxi_in", "arrival_delay", "arrival_delay_mins", "airline_delay", "weather_delay",
        "air_system_delay", "security_delay", "late_aircraft_delay",
    ),
}
FLIGHT_COLUMNS += "".join(f", CAST(NULL AS {kind}) AS {c}" for kind, names in EMPTY_COLUMNS.items() for c in names)


def _index_sql() -> str:
    tables = "".join(
        f",\ni_{c} AS (SELECT CAST({c} AS VARCHAR) AS k, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS place,"
        f" count(*) OVER () AS width FROM train GROUP BY {c})" for c in CATEGORICAL
    )
    return "WITH " + SPLIT_SQL + tables


def _index_joins() -> str:
    return " ".join(f"LEFT JOIN i_{c} ON CAST(test.{c} AS VARCHAR) = i_{c}.k" for c in CATEGORICAL)


FOLD_COLUMNS = ("year", "month", "day", "carrier", "origin_id", "dest_id", "sched_hhmm")


def _out_of_fold_sql(rows: str, training: bool) -> str:
    """Sums per key over all rows less those of the row's fold; 20 rows of the overall mean on top."""
    digest = "md5(concat_ws('|', '42', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in FOLD_COLUMNS) + "))"
    fold = f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % 5"
    tables = "".join(
        f",\nn_{k} AS (SELECT {k} AS k, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS s FROM folded GROUP BY {k}),"
        f"\no_{k} AS (SELECT {k} AS k, fold AS of, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS s"
        f" FROM folded GROUP BY {k}, fold)" for k in RATES
    )
    joins = " ".join(f"LEFT JOIN n_{k} ON r.{k} = n_{k}.k LEFT JOIN o_{k} ON r.{k} = o_{k}.k AND o_{k}.of = r.fold" for k in RATES)
    prior = "(base.s - coalesce(own.s, 0)) / (base.n - coalesce(own.n, 0))"
    columns = ", ".join(r6(
        f"(coalesce(n_{k}.s, 0) - coalesce(o_{k}.s, 0) + 20 * {prior}) / (coalesce(n_{k}.n, 0) - coalesce(o_{k}.n, 0) + 20)", name
    ) for k, name in RATES.items())
    own = ", ".join(f"r.{c}" for c in FOLD_COLUMNS) + (", r.label AS is_delayed" if training else "")
    return "WITH " + TREE_PARTS_SQL + f""",
folded AS MATERIALIZED (SELECT *, {fold} AS fold FROM ctrain){tables},
base AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS s FROM folded),
own AS (SELECT fold AS of, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS s FROM folded GROUP BY fold),
r AS (SELECT *, {fold if training else "-1"} AS fold FROM {rows})
SELECT {own}, {r6("distance", "distance")}, {columns} FROM r CROSS JOIN base LEFT JOIN own ON own.of = r.fold {joins}"""


def newton_logit_sql(weighted: bool) -> str:
    """Ten Newton steps; each solves the three equations by cofactors. ``optimum`` has b0, b1, b2."""
    ratio = "(SELECT count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE) FROM train)" if weighted else "1.0"
    return "WITH RECURSIVE " + SPLIT_SQL + f""",
xy AS MATERIALIZED (SELECT label, sched_hhmm / CAST(2400 AS DOUBLE) AS x1, sched_elapsed / CAST(50 AS DOUBLE) AS x2,
  CASE WHEN label = 1 THEN CAST({ratio} AS DOUBLE) ELSE 1.0 END AS rw FROM train),
steps AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2
  UNION ALL
  SELECT step + 1,
    b0 - ((d*f - e*e) * g0 + (c*e - b*f) * g1 + (b*e - c*d) * g2) / det,
    b1 - ((c*e - b*f) * g0 + (a*f - c*c) * g1 + (b*c - a*e) * g2) / det,
    b2 - ((b*e - c*d) * g0 + (b*c - a*e) * g1 + (a*d - b*b) * g2) / det
  FROM (SELECT *, a * (d*f - e*e) + b * (c*e - b*f) + c * (b*e - c*d) AS det FROM (
    SELECT step, b0, b1, b2, sum(v) AS a, sum(v * x1) AS b, sum(v * x2) AS c, sum(v * x1 * x1) AS d,
           sum(v * x1 * x2) AS e, sum(v * x2 * x2) AS f, sum(r) AS g0, sum(r * x1) AS g1, sum(r * x2) AS g2
    FROM (SELECT *, rw * p * (1 - p) AS v, rw * (p - label) AS r
          FROM (SELECT *, 1.0 / (1.0 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM steps, xy WHERE step < 10))
    GROUP BY step, b0, b1, b2))
),
optimum AS (SELECT * FROM steps WHERE step = 10)"""


def newton_logit_weights_sql(weighted: bool, places: int = 6) -> str:
    lines = [
        f"SELECT '{name}' AS feature, round({b}, {places}) + 0.0 AS weight FROM optimum"
        for name, b in (("bias", "b0"), ("hhmm", "b1"), ("elapsed", "b2"))
    ]
    return newton_logit_sql(weighted) + "\n" + "\nUNION ALL ".join(lines)


def _turned(expression: str) -> str:
    return f"1 - {expression}"


NEWTON_FEATURES = ("dep_hour", "month", "day", "dayofweek")
NEWTON_ROUNDS, NEWTON_DEPTH, NEWTON_RATE = 12, 6, 0.2


def newton_sql() -> str:
    """Trees grown level by level: histograms, running sums, best split of each node, leaves.

    Gives ``state`` with the margin of each row after each round, ``splits`` and ``curve``.
    """
    steps = [f"""{CLEANED_SQL}, m0 AS MATERIALIZED (SELECT dep_hour, month, day, dayofweek, label, day % 5 = 0 AS valid, 0.0::DOUBLE AS margin
        FROM (SELECT *, {CALENDAR_SQL} FROM cleaned))"""]
    splits, curves = [], []
    for t in range(NEWTON_ROUNDS):
        steps.append(f"""n{t}_0 AS MATERIALIZED (SELECT *, 1 / (1 + exp(-margin)) - label AS g,
            1 / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h, 0 AS node FROM m{t})""")
        for d in range(NEWTON_DEPTH):
            at = f"{t}_{d}"
            cells = " UNION ALL ".join(
                f"SELECT node, {i} AS f, {name} AS v, sum(g) AS g, sum(h) AS h FROM n{at} WHERE NOT valid AND node >= {2**d - 1} GROUP BY node, {name}"
                for i, name in enumerate(NEWTON_FEATURES)
            )
            goes = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(NEWTON_FEATURES))
            steps.append(f"c{at} AS MATERIALIZED ({cells})")
            steps.append(f"""r{at} AS (SELECT node, f, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
                sum(g) OVER (PARTITION BY node, f) AS gs, sum(h) OVER (PARTITION BY node, f) AS hs FROM c{at} WINDOW w AS (PARTITION BY node, f ORDER BY v))""")
            steps.append(f"""b{at} AS MATERIALIZED (SELECT node, f, v, round(gl * gl / (hl + 1) + (gs - gl) * (gs - gl) / (hs - hl + 1) - gs * gs / (hs + 1), 6) AS gain
                FROM r{at} WHERE hl >= 1 AND hs - hl >= 1 AND gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1)""")
            steps.append(f"""n{t}_{d + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN b.f IS NULL THEN n.node
                ELSE 2 * n.node + 1 + CASE WHEN CASE b.f {goes} END <= b.v THEN 0 ELSE 1 END END AS node) FROM n{at} n LEFT JOIN b{at} b ON n.node = b.node)""")
            splits.append(f"SELECT {t + 1} AS round, node, f, v, gain FROM b{at}")
        steps.append(f"l{t} AS (SELECT node, -sum(g) / (sum(h) + 1) * {NEWTON_RATE} AS value FROM n{t}_{NEWTON_DEPTH} WHERE NOT valid GROUP BY node)")
        steps.append(f"""m{t + 1} AS MATERIALIZED (SELECT dep_hour, month, day, dayofweek, label, valid, margin + value AS margin
            FROM n{t}_{NEWTON_DEPTH} JOIN l{t} USING (node))""")
        curves.append(f"""SELECT {t + 1} AS round, sum(neg * (above + pos / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
            SELECT pos, neg, coalesce(sum(pos) OVER (ORDER BY m DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM (
                SELECT round(margin, 9) AS m, sum(label) AS pos, sum(1 - label) AS neg FROM m{t + 1} WHERE valid GROUP BY 1))""")
    steps.append("curve AS MATERIALIZED (" + " UNION ALL ".join(curves) + ")")
    steps.append("best AS (SELECT round FROM curve ORDER BY auc DESC, round LIMIT 1)")
    names = "[" + ", ".join(f"'{n}'" for n in NEWTON_FEATURES) + "]"
    steps.append(f"splits AS MATERIALIZED (SELECT s.round, node, {names}[f + 1] AS feature, v, gain FROM (" + " UNION ALL ".join(splits) + ") s)")
    steps.append("state AS (" + " UNION ALL ".join(f"SELECT {t} AS round, * FROM m{t}" for t in range(1, NEWTON_ROUNDS + 1)) + ")")
    return "WITH " + ", ".join(steps)


def oracles() -> dict[str, str]:
    legs_columns = ("year", "month", "day", "dayofweek", "carrier", "origin_id", "dest_id", "sched_hhmm",
                    "distance", "sched_elapsed", "taxi_out", "air_time", "delay", "cancelled", "diverted")
    sampled = f"({POSITION} < CAST(floor(0.05 * {PLACES}) AS BIGINT))"
    part = (f"CASE WHEN {POSITION} < CAST(floor(0.64 * {PLACES}) AS BIGINT) THEN 'train' "
            f"WHEN {POSITION} < CAST(floor((0.64 + 0.16) * {PLACES}) AS BIGINT) THEN 'validation' ELSE 'test' END")
    slopes = [f"SELECT 'bias' AS feature, {r6('sum(err) / count(*)', 'slope')} FROM errs"]
    slopes += [f"SELECT '{f}', {r6(f'sum(err * {x}) / count(*)', 'slope')} FROM errs" for f, x in zip(FEATURES, XS)]
    job_metrics = {"accuracy": "acc", "f1": "wf", "weighted_precision": "wp", "weighted_recall": "wr",
                   "auc": "auc", "average_precision": "ap"}
    job_margin = " + ".join(["b", *[f"{x} * {w}" for x, w in zip(XS, WS)]])
    report = [
        "SELECT '0' AS name, " + f"{r6('p0', 'precision')}, {r6('r0', 'recall')}, {r6('f0', 'f1')}, tn + fp AS support FROM measures",
        f"SELECT '1', {r6('p1', 'a')}, {r6('r1', 'b')}, {r6('f1', 'c')}, tp + fn FROM measures",
        f"SELECT 'accuracy', {r6('acc', 'a')}, {r6('acc', 'b')}, {r6('acc', 'c')}, CAST(n AS BIGINT) FROM measures",
        f"SELECT 'macro avg', {r6('(p0 + p1) / 2', 'a')}, {r6('(r0 + r1) / 2', 'b')}, {r6('(f0 + f1) / 2', 'c')}, CAST(n AS BIGINT) FROM measures",
        f"SELECT 'weighted avg', {r6('wp', 'a')}, {r6('wr', 'b')}, {r6('wf', 'c')}, CAST(n AS BIGINT) FROM measures",
    ]
    by_distance = CLEANED_SQL + ", scored AS (SELECT label, distance AS probability, 0 AS prediction FROM cleaned)"
    rates = [
        f"SELECT '{key}' AS feature, CAST({key} AS VARCHAR) AS category, {r6('avg(label)', 'rate')}, count(*) AS rows FROM dated GROUP BY {key}"
        for key in RATES
    ]
    stats = [f"SELECT '{f}' AS feature, {r6(f'avg({f})', 'mean')}, {r6(f'stddev_samp({f})', 'std')} FROM train" for f in NUMERIC]
    target_mean = "WITH " + RATE_TABLES_SQL + f"""
      SELECT year, ctest.month, day, ctest.carrier, ctest.origin_id, ctest.dest_id, sched_hhmm,
             {r6("distance", "distance")}, {RATE_COLUMNS} FROM ctest {RATE_JOINS}"""
    clock_both = "WITH " + CLOCK_SQL + MEASURES_SQL

    return {
        "read_csv_roundtrip": f"WITH {LEGS_SQL} SELECT {picked(legs_columns)} FROM legs",
        "read_csv_decimal_ints": f"WITH {LEGS_SQL} SELECT {picked(legs_columns)} FROM legs",
        "malformed_counts": f"WITH {LEGS_SQL} " + " UNION ALL ".join(
            f"SELECT '{c}' AS column, count({c}) AS entries, {bad} AS malformed FROM legs"
            for c, bad in ((c, {"origin_id": "count(*) FILTER (origin_id % 5 = 0)", "day": "count(*) FILTER (day = 31)"}.get(c, "CAST(0 AS BIGINT)"))
                           for c in legs_columns if c != "carrier")
        ),
        "malformed_rows": f"""WITH {LEGS_SQL}, misfits AS (
              SELECT 'origin_id' AS "column", CAST(origin_id AS VARCHAR) || '.5' AS entry, * FROM legs WHERE origin_id % 5 = 0
              UNION ALL SELECT 'day', 'last', * FROM legs WHERE day = 31)
            SELECT "column", entry, year, month, CASE WHEN day <> 31 THEN day END AS day,
              CASE WHEN origin_id % 5 <> 0 THEN origin_id END AS origin_id, sched_hhmm, {r6("distance", "distance")},
              CAST({len(legs_columns)} AS INT) AS entries, true AS told_file FROM misfits""",
        "accepted_rows": f"WITH {LEGS_SQL} SELECT {picked(legs_columns)} FROM legs WHERE origin_id % 5 <> 0 AND day <> 31",
        "target_mean_out_of_fold": _out_of_fold_sql("ctrain", True),
        "target_mean_smoothed": _out_of_fold_sql("ctest", False),
        "newton_splits": f"{newton_sql()} SELECT CAST(round AS INT) AS round, CAST(node AS INT) AS node, feature, CAST(v AS DOUBLE) AS cut, {r6('gain', 'gain')} FROM splits",
        "newton_gains": f"""{newton_sql()}, names AS (SELECT unnest([{', '.join(f"'{n}'" for n in NEWTON_FEATURES)}]) AS feature)
            SELECT feature, CAST(count(gain) AS INT) AS splits, {r6('coalesce(sum(gain), 0)', 'gain')},
                   {r6('coalesce(sum(gain), 0) / (SELECT sum(gain) FROM splits)', 'importance')} FROM names LEFT JOIN splits USING (feature) GROUP BY feature""",
        "newton_curve": f"{newton_sql()} SELECT CAST(round AS INT) AS round, {r6('auc', 'auc')} FROM curve",
        "newton_scores": f"""{newton_sql()} SELECT dep_hour, month, day, dayofweek, label, {r6('1 / (1 + exp(-margin))', 'probability')},
            CAST(1 / (1 + exp(-margin)) >= 0.5 AS INT) AS prediction FROM state JOIN best USING (round)""",
        "tree_split_sizes": f"""WITH {LEGS_SQL}, labelled AS (SELECT delay > 15 AS late, count(*) AS n FROM legs WHERE cancelled = 0
              AND diverted = 0 AND year >= 1995 AND NOT {LEFT_OUT} AND delay IS NOT NULL GROUP BY 1)
            SELECT CAST(sum(n - floor(n * 0.2 + 0.5)) AS BIGINT) AS learning_rows, CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) AS test_rows
            FROM labelled""",
        "tree_model_is_measured_model": LATE_OK,
        "read_csv_strict": f"WITH {LEGS_SQL} SELECT {FLIGHT_COLUMNS} FROM legs",
        "staged_roundtrip": f"""WITH {LEGS_SQL} SELECT year, count(*) AS rows, CAST(sum(sched_hhmm) AS BIGINT) AS hhmm_sum,
            count(delay) AS delays FROM legs GROUP BY year""",
        "sample_roundtrip": f"WITH {CLEANED_SQL} SELECT {ALL_CLEAN} FROM cleaned WHERE {sampled}",
        "metrics_roundtrip": CLOCK_DOCUMENT,
        "confusion_roundtrip": CONFUSION,
        "predictions_roundtrip": f"WITH {CLOCK_SQL} SELECT label, prediction, {r6('probability', 'probability')} FROM scored",
        "model_reload_same": LATE_OK,
        "clean_legs": f"WITH {CLEANED_SQL} SELECT {ALL_CLEAN} FROM cleaned",
        "exclude_periods": f"""WITH {LEGS_SQL} SELECT year, month, count(*) AS rows, CAST(sum(sched_hhmm) AS BIGINT) AS hhmm_sum
            FROM legs WHERE NOT {LEFT_OUT} GROUP BY year, month""",
        "cleaning_report": f"""WITH {LEGS_SQL}, steps AS (SELECT *, cancelled = 0 AS a, cancelled = 0 AND diverted = 0 AS b FROM legs)
            SELECT count(*) AS total_rows, count(*) FILTER (a) AS not_cancelled, count(*) FILTER (b) AS not_diverted,
              count(*) FILTER (b AND delay IS NOT NULL) AS delay_known,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996) AS from_start_year,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996 AND NOT {LEFT_OUT}) AS outside_periods,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996 AND NOT {LEFT_OUT} AND carrier IS NOT NULL) AS kept_rows,
              count(*) FILTER (year < 1996) AS dropped_by_year FROM steps""",
        "job_row_accounting": f"""WITH {LEGS_SQL}, steps AS (SELECT *, cancelled = 0 AS a, cancelled = 0 AND diverted = 0 AS b FROM legs)
            SELECT count(*) AS total_rows, count(*) FILTER (a) AS not_cancelled, count(*) FILTER (b) AS not_diverted,
              count(*) FILTER (b AND delay IS NOT NULL) AS delay_known,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996) AS from_start_year,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996 AND NOT {LEFT_OUT}) AS outside_periods,
              count(*) FILTER (b AND delay IS NOT NULL AND year >= 1996 AND NOT {LEFT_OUT} AND carrier IS NOT NULL) AS kept_rows,
              count(*) FILTER (year < 1996) AS dropped_by_year FROM steps""",
        "label_inclusive": f"""WITH {LEGS_SQL} SELECT year, month, day, origin_id, dest_id, delay,
            CAST(CASE WHEN delay >= 15 THEN 1 ELSE 0 END AS INT) AS label FROM legs WHERE delay IS NOT NULL""",
        "label_exclusive_unknown": f"""WITH {LEGS_SQL} SELECT year, month, day, origin_id, dest_id, delay,
            CAST(CASE WHEN delay > 15 THEN 1 ELSE 0 END AS INT) AS label FROM legs""",
        "class_weights": f"""WITH {SPLIT_SQL} SELECT 'train' AS scope,
              {r6("count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE)", "weight")} FROM train
            UNION ALL SELECT 'all', {r6("count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE)", "weight")} FROM cleaned""",
        "class_weight_column": f"""WITH {SPLIT_SQL},
            ratio AS (SELECT count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE) AS w FROM train)
            SELECT year, label, count(*) AS rows, {r6("max(CASE WHEN label = 1 THEN w ELSE 1.0 END)", "weight")},
              {r6("sum(CASE WHEN label = 1 THEN w ELSE 1.0 END)", "weight_sum")} FROM train, ratio GROUP BY year, label""",
        "calendar_features": f"WITH {LEGS_SQL} SELECT year, month, day, dayofweek, sched_hhmm, {CALENDAR_SQL} FROM legs",
        "route_keys": f"""WITH {LEGS_SQL} SELECT concat_ws('-', CASE WHEN carrier IS NOT NULL THEN CAST(origin_id AS VARCHAR) END,
              CASE WHEN dest_id < 24 THEN CAST(dest_id AS VARCHAR) END) AS route, count(*) AS rows FROM legs GROUP BY route""",
        "select_features": "WITH " + RATE_TABLES_SQL + "," + MEDIAN_TABLES + f"""
            SELECT year, ctest.month, day, dayofweek, ctest.dep_hour, dep_period, is_weekend, season, {picked(("distance", "sched_elapsed"))},
              {MEDIAN_COLUMNS}, ctest.origin_id, ctest.dest_id, {RATE_COLUMNS}, label AS is_delayed
            FROM ctest {RATE_JOINS} LEFT JOIN medians ON ctest.route = mr""",
        "category_counts": f"WITH {CLEANED_SQL} " + "\nUNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, count(*) AS rows FROM cleaned GROUP BY {c}" for c in CATEGORICAL),
        "delay_rates_one_scan": f"WITH {CLEANED_SQL}, dated AS (SELECT *, {CALENDAR_SQL} FROM cleaned) " + "\nUNION ALL ".join(rates),
        "group_medians": f"""WITH {LEGS_SQL}, dated AS (SELECT *, {CALENDAR_SQL} FROM legs)
            SELECT route, {r6("quantile_disc(taxi_out, 0.5)", "taxi_out_median")}, {r6("quantile_disc(air_time, 0.5)", "air_time_median")}
            FROM dated GROUP BY route""",
        "feature_stats": f"WITH {SPLIT_SQL} " + "\nUNION ALL ".join(stats),
        "label_counts": f"WITH {CLEANED_SQL} SELECT label, count(*) AS count FROM cleaned GROUP BY label",
        "class_balance": f"""WITH {CLEANED_SQL} SELECT label, count(*) AS count,
            {r6("100.0 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)", "percent")} FROM cleaned GROUP BY label""",
        "split_summary": f"""WITH {SPLIT_SQL} SELECT 'train' AS part, count(*) AS rows, count(*) FILTER (label = 1) AS late_rows FROM train
            UNION ALL SELECT 'test', count(*), count(*) FILTER (label = 1) FROM test""",
        "distinct_years": f"WITH {CLEANED_SQL} SELECT DISTINCT year FROM cleaned",
        "frequency_encode_train": f"WITH {FREQUENCY_SQL} SELECT {FREQUENCY_OUT}, {FREQUENCY_COLUMNS} FROM train {FREQUENCY_JOINS}",
        "frequency_encode_test": f"WITH {FREQUENCY_SQL} SELECT {FREQUENCY_OUT}, {FREQUENCY_COLUMNS} FROM test {FREQUENCY_JOINS}",
        "target_mean_encode": target_mean,
        "target_mean_encode_shuffled": target_mean,
        "median_impute": "WITH " + TREE_PARTS_SQL + "," + MEDIAN_TABLES + f"""
            SELECT year, month, day, route, {picked(("distance", "taxi_out", "air_time"))}, {MEDIAN_COLUMNS}
            FROM ctest LEFT JOIN medians ON route = mr""",
        "zscore": f"WITH {SCALED_SQL} SELECT " + ", ".join(r6(x, f) for x, f in zip(XS, FEATURES)) + ", label FROM stest",
        "temporal_split": f"WITH {SPLIT_SQL} SELECT {ALL_CLEAN}, first_test_year FROM test, cut",
        "onehot_job": f"""WITH {CLEANED_SQL}, placed AS (SELECT label, {JOB_POSITION} < CAST(floor(0.8 * {PLACES}) AS BIGINT) AS learnt FROM cleaned)
            SELECT 'weighted' AS mode, CAST(20 AS INT) AS max_iter, count(*) FILTER (learnt) AS train_rows, count(*) FILTER (NOT learnt) AS test_rows,
              count(*) FILTER (NOT learnt AND label = 1) AS late_test_rows,
              {r6("count(*) FILTER (learnt AND label = 0) / CAST(count(*) FILTER (learnt AND label = 1) AS DOUBLE)", "positive_weight")} FROM placed""",
        "onehot_job_metrics_hold": LATE_OK,
        "tree_job": f"""WITH {LEGS_SQL}, tested AS (SELECT delay > 15 AS late, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n FROM legs
              WHERE cancelled = 0 AND diverted = 0 AND year >= 1995 AND NOT {LEFT_OUT} AND delay IS NOT NULL GROUP BY 1)
            SELECT CASE WHEN late THEN '1' ELSE '0' END AS name, n AS support FROM tested
            UNION ALL SELECT name, CAST((SELECT sum(n) FROM tested) AS BIGINT) FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(name)""",
        "newton_job": f"""WITH {LEGS_SQL}, tested AS (SELECT delay > 15 AS late, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS n FROM legs
              WHERE cancelled = 0 AND diverted = 0 AND year >= 1995 AND NOT {LEFT_OUT} AND delay IS NOT NULL GROUP BY 1)
            SELECT CASE WHEN late THEN '1' ELSE '0' END AS name, n AS support FROM tested
            UNION ALL SELECT name, CAST((SELECT sum(n) FROM tested) AS BIGINT) FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(name)""",
        "tree_job_metrics_hold": LATE_OK,
        "hash_split": f"WITH {CLEANED_SQL} SELECT {ALL_CLEAN} FROM cleaned WHERE {POSITION} >= CAST(floor(0.8 * {PLACES}) AS BIGINT)",
        "hash_three_parts": f"""WITH {CLEANED_SQL} SELECT {part} AS part, label, count(*) AS rows,
            CAST(sum(sched_hhmm) AS BIGINT) AS hhmm_sum FROM cleaned GROUP BY ALL""",
        "stratified_sample": f"""WITH {CLEANED_SQL} SELECT {ALL_CLEAN} FROM cleaned
            WHERE {POSITION} < CASE WHEN label = 1 THEN CAST(floor(0.2 * {PLACES}) AS BIGINT) ELSE CAST(floor(0.05 * {PLACES}) AS BIGINT) END""",
        "stratified_split": f"""WITH {CLEANED_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {DIGEST}) AS rn,
              count(*) OVER (PARTITION BY label) AS n FROM cleaned)
            SELECT {ALL_CLEAN} FROM placed WHERE rn <= floor(n * 0.2 + 0.5)""",
        "split_parts_disjoint": LATE_OK,
        "gradient_step": f"""WITH {SCALED_SQL}, errs AS (SELECT *, 1.0 / (1.0 + exp(-({FIXED_MARGIN}))) - label AS err FROM strain)
            """ + "\nUNION ALL ".join(slopes),
        "gd_weights_baseline": coefficients_sql(False),
        "gd_weights_weighted": coefficients_sql(True),
        "gd_score": f"""WITH {SCALED_SQL}, p AS (SELECT label, 1.0 / (1.0 + exp(-({FIXED_MARGIN}))) AS probability FROM stest)
            SELECT label, {r6("probability", "probability")}, CAST(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS INT) AS prediction FROM p""",
        "descent_job": descent_sql(True) + f""",
            scored AS MATERIALIZED (SELECT label, probability, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction
              FROM (SELECT label, 1.0 / (1.0 + exp(-({job_margin}))) AS probability FROM stest, final))""" + MEASURES_SQL + " " + "\nUNION ALL ".join(
            f"SELECT '{name}' AS metric, {r6(column, 'value')} FROM measures, ranks" for name, column in job_metrics.items()),
        "confusion_counts": CONFUSION,
        "threshold_metrics": clock_both + f""" SELECT tp, fp, tn, fn, {r6("acc", "accuracy")}, {r6("p1", "precision_1")}, {r6("r1", "recall_1")},
            {r6("f1", "f1_1")}, {r6("p0", "precision_0")}, {r6("r0", "recall_0")}, {r6("f0", "f1_0")}, {r6("wp", "weighted_precision")},
            {r6("wr", "weighted_recall")}, {r6("wf", "f1")} FROM measures""",
        "class_report": clock_both + " " + "\nUNION ALL ".join(report),
        "roc_auc_exact": clock_both + f" SELECT {r6('auc', 'auc')} FROM ranks",
        "roc_auc_fine_scores": "WITH " + by_distance + MEASURES_SQL + f" SELECT {r6('auc', 'auc')} FROM ranks",
        "rank_sum_statistic": clock_both + f" SELECT {r6('stat', 'auc_desc_rank')}, positives, negatives FROM ranksum, ranks",
        "average_precision_exact": clock_both + f" SELECT {r6('ap', 'average_precision')} FROM ranks",
        "pr_curve_points": clock_both + f""" SELECT {r6("s", "threshold")}, {r6("cp / (cp + cq)", "precision")}, {r6("cp / np", "recall")},
            {r6("np / (np + nq)", "prevalence")} FROM curve""",
        "pr_curve_thinned": "WITH " + by_distance + MEASURES_SQL + f""", kept AS (SELECT *, row_number() OVER (
              PARTITION BY ceil(cp * 100 / np) ORDER BY s) AS place FROM curve)
            SELECT {r6("s", "threshold")}, {r6("cp / (cp + cq)", "precision")}, {r6("cp / np", "recall")},
              {r6("np / (np + nq)", "prevalence")} FROM kept WHERE place = 1""",
        "ranking_by_carrier": f"""WITH {CLEANED_SQL},
            ties AS (SELECT carrier, sched_hhmm AS s, CAST(count(*) FILTER (label = 1) AS DOUBLE) AS p,
                       CAST(count(*) FILTER (label = 0) AS DOUBLE) AS q FROM cleaned GROUP BY carrier, sched_hhmm),
            curve AS (SELECT *, sum(p) OVER (PARTITION BY carrier ORDER BY s DESC) AS cp, sum(q) OVER (PARTITION BY carrier ORDER BY s DESC) AS cq,
                        sum(p) OVER (PARTITION BY carrier) AS np, sum(q) OVER (PARTITION BY carrier) AS nq FROM ties),
            ranked AS (SELECT carrier, label, rank() OVER (PARTITION BY carrier ORDER BY sched_hhmm DESC) AS r FROM cleaned),
            ranksum AS (SELECT carrier, CAST(sum(r) AS DOUBLE) AS rs, count(*) AS n1 FROM ranked WHERE label = 1 GROUP BY carrier)
            SELECT carrier, {r6("sum(q * (cp - p / 2)) / max(np * nq)", "auc")},
              {r6("(max(rs) - max(n1) * (max(n1) + 1) / 2.0) / max(np * nq)", "auc_desc_rank")},
              {r6("sum(p / np * cp / (cp + cq))", "average_precision")}, CAST(max(np) AS BIGINT) AS positives,
              CAST(max(nq) AS BIGINT) AS negatives FROM curve JOIN ranksum USING (carrier) GROUP BY carrier""",
        "metrics_match_builtin": LATE_OK,
        **dict.fromkeys(("string_index", "string_index_by_lookup"), _index_sql() + f""" SELECT test.carrier, test.dest_id, test.origin_id,
            CAST(coalesce(max(i_carrier.place), (SELECT max(width) FROM i_carrier)) AS DOUBLE) AS carrier_index,
            CAST(coalesce(max(i_origin_id.place), (SELECT max(width) FROM i_origin_id)) AS DOUBLE) AS origin_id_index,
            CAST(coalesce(max(i_dest_id.place), (SELECT max(width) FROM i_dest_id)) AS DOUBLE) AS dest_id_index,
            count(*) AS rows FROM test {_index_joins()} GROUP BY test.carrier, test.dest_id, test.origin_id"""),
        "one_hot_by_lookup": _index_sql() + " SELECT " + ", ".join(f"test.{c}" for c in CATEGORICAL) + ", "
            + ", ".join(f"CAST(coalesce(i_{c}.place, -1) AS BIGINT) AS {c}_slot" for c in CATEGORICAL)
            + f", count(*) AS rows FROM test {_index_joins()} GROUP BY ALL",
        "newton_logit_weights": newton_logit_weights_sql(False),
        "newton_logit_weighted": newton_logit_weights_sql(True),
        "logit_coefficients": newton_logit_weights_sql(True, 4),
        "newton_logit_scores": newton_logit_sql(True) + f""" SELECT label, sched_hhmm, {r6("sched_elapsed", "sched_elapsed")},
            {r6("p", "probability")}, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INT) AS prediction
            FROM (SELECT test.*, 1.0 / (1.0 + exp(-(b0 + b1 * sched_hhmm / 2400.0 + b2 * sched_elapsed / 50.0))) AS p FROM test, optimum)""",
        "one_hot_slot": _index_sql() + f""" SELECT test.carrier, test.dest_id, CAST(coalesce(i_carrier.place, -1) AS BIGINT) AS carrier_slot,
            CAST(coalesce(i_dest_id.place, -1) AS BIGINT) AS dest_id_slot, count(*) AS rows FROM test {_index_joins()} GROUP BY ALL""",
        "assemble_features": _index_sql() + " SELECT " + ", ".join(r6(f"CAST({n} AS DOUBLE)", n) for n in NUMERIC) + f""",
            {r6("CAST((i_carrier.k IS NOT NULL)::INT + (i_origin_id.k IS NOT NULL)::INT + (i_dest_id.k IS NOT NULL)::INT AS DOUBLE)", "hot_slots")}
            FROM test {_index_joins()}""",
        "logit_optimum": LATE_OK,
        "gbt_first_trees_same": LATE_OK,
        "gbt_early_stop": LATE_OK,
        "importances_sum_to_one": LATE_OK,
        "boosting_curve_end": LATE_OK,
        "metrics_documents": CLOCK_DOCUMENT,
        "model_comparison": clock_both + f""" SELECT 'clock' AS model, 'baseline' AS mode, {r6("auc", "auc")}, {r6("auc - 0.5", "auc_gain")} FROM ranks
            UNION ALL SELECT 'turned', 'baseline', {r6(_turned("auc"), "auc")}, {r6(_turned("auc") + " - 0.5", "auc_gain")} FROM ranks""",
    }
