"""Run the registered queries against their SQL twins: python -m checks.compare [sf] [name…]."""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

KINDS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def difference(found: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows, names and types; else what differs."""
    told = db.execute(sql)
    names = [d[0] for d in told.description]
    kinds = dict(zip(names, (str(d[1]) for d in told.description)))
    rows = told.fetchall()
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} != {sorted(names)}"
    own_kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in found.schema.fields}
    if any(own_kinds[n] != kinds[n] for n in names):
        return f"types {[(n, own_kinds[n], kinds[n]) for n in names if own_kinds[n] != kinds[n]]}"
    order = sorted(names)
    theirs = Counter(tuple(_plain(r[names.index(n)]) for n in order) for r in rows)
    ours = Counter(tuple(_plain(r[n]) for n in order) for r in found.collect())
    if ours != theirs:
        return (f"rows {sum(ours.values())} vs {sum(theirs.values())}; only here "
                f"{list((ours - theirs).items())[:3]}; only there {list((theirs - ours).items())[:3]}")
    return None


def main(argv: list[str]) -> int:
    from checks.oracles import oracles
    from checks.queries import REGISTERED

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, twins, bad = database(sf_dir), oracles(), 0
    for name, function in REGISTERED.items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            found = function(spark, sf_dir)
            if name in twins:
                wrong = difference(found, db, twins[name])
                verdict = "ok" if wrong is None else f"DIFFERENT {wrong}"
            else:
                wrong, verdict = None, f"rows only: {found.count()}"
        except Exception as error:  # report and go on with the next query
            wrong = verdict = f"FAILED {type(error).__name__} {str(error)[:600]}"
            if len(argv) > 1:
                traceback.print_exc()
        bad += wrong is not None
        print(f"{name:32s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    unknown = set(twins) - set(REGISTERED)
    print(f"{bad} of {len(REGISTERED)} differ" + (f"; twins without query: {unknown}" if unknown else ""))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
