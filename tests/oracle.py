"""Runs a registered query and its SQL side by side and compares names, types of rows, and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value, digits):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "as_tuple"):  # Decimal
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        if math.isinf(value):
            return value
        value = round(value, digits) if digits is not None else value
        return int(value) if value == int(value) else value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v, digits) for v in value)
    return value


def compare(spark, con, name, run, sql, folder):
    """(status, seconds, note); 'close' means equal only after rounding to 9 digits."""
    started = time.monotonic()
    df = run(spark, folder)
    columns = df.columns
    rows = [tuple(r) for r in df.collect()]
    seconds = time.monotonic() - started
    if sql is None:
        return ("rows", seconds, f"{len(rows)} rows") if rows else ("EMPTY", seconds, "no rows")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(columns):
        return "COLUMNS", seconds, f"{sorted(columns)} against {sorted(names)}"
    ours, theirs = [columns.index(c) for c in sorted(columns)], [names.index(c) for c in sorted(names)]
    for digits, status in ((None, "ok"), (9, "close")):
        a = Counter(tuple(_plain(r[i], digits) for i in ours) for r in rows)
        b = Counter(tuple(_plain(r[i], digits) for i in theirs) for r in expected)
        if a == b:
            return status, seconds, f"{len(rows)} rows" + ("" if rows else " (none!)")
    extra, lacking = list((a - b).items())[:2], list((b - a).items())[:2]
    return "DIFFER", seconds, f"{len(rows)} against {len(expected)} rows; only ours {extra}; only theirs {lacking}"


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    # A plain session: results must not depend on our own settings.
    builder = SparkSession.builder.master("local[8]").appName("oracle")
    for key, value in {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            status, seconds, note = compare(spark, con, name, run, oracles.get(name), folder)
        except Exception as problem:
            status, seconds, note = "ERROR", 0.0, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += status not in ("ok", "rows")
        print(f"{status:8s} {seconds:6.1f}s {name}: {note[:900]}", flush=True)
    print("not ok:", bad)


if __name__ == "__main__":
    main()
