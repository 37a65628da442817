"""Run every registered scenario and its DuckDB oracle; compare rows as multisets.

Usage: python tests/oracle_check.py [--exact] [sf_dir] [name ...]

``--exact`` compares unrounded values (floats bit for bit, decimals as decimals).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def _exact(v):
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, exact: bool = False) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_cols = df.columns
    out = {"name": name, "rows": len(rows), "sec": round(time.time() - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    ocols, orows = oracle_rows(sf_dir, sql)
    out["oracle_rows"] = len(orows)
    if sorted(spark_cols) != sorted(ocols):
        out["status"] = f"COLUMNS {sorted(spark_cols)} vs {sorted(ocols)}"
        return out
    order = [ocols.index(c) for c in spark_cols]
    norm = _exact if exact else _norm  # exact: no float rounding, decimals as decimals
    a = Counter(tuple(norm(v) for v in r) for r in rows)
    b = Counter(tuple(norm(r[i]) for i in order) for r in orows)
    if a == b:
        out["status"] = "MATCH"
    else:
        only_s = list((a - b).elements())[:3]
        only_o = list((b - a).elements())[:3]
        out["status"] = f"MISMATCH spark-only={only_s} oracle-only={only_o}"
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    exact = "--exact" in argv
    argv = [a for a in argv if a != "--exact"]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = set(argv[1:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            res = compare(spark, name, fn, sqls.get(name), sf_dir, exact)
        except Exception as exc:  # report and continue
            res = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        bad += res["status"] not in ("MATCH", "rows-only")
        print(res, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
