"""Run queries in Spark and their oracle SQL in DuckDB; compare results.

Usable from pytest (``compare``) and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        # Exact: the driver hashes values, so floats must agree bit for bit.
        return "nan" if math.isnan(v) else v
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(records, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in idx) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str):
    df = fn(spark, sf_dir)
    spark_cols = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    duck_cols = [d[0] for d in res.description]
    duck_rows = res.fetchall()
    problems = []
    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns spark={sorted(spark_cols)} duck={sorted(duck_cols)}")
        return problems
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows spark={len(spark_rows)} duck={len(duck_rows)}")
    a, b = _rows(spark_rows, spark_cols), _rows(duck_rows, duck_cols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from promoscope.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = build_session("local[8]", 8, config={"spark.ui.enabled": "false",
                                                 "spark.sql.session.timeZone": "UTC"})
    con = duck(sf_dir)
    qs, oracles = queries(), oracle_sql()
    bad = 0
    for n in names:
        t0 = time.time()
        if n not in oracles:
            rows = qs[n](spark, sf_dir).count()
            print(f"{n:34s} rows-only {rows} rows {time.time() - t0:.1f}s", flush=True)
            continue
        try:
            problems = compare(spark, con, n, qs[n], oracles[n], sf_dir)
        except Exception as e:  # report and go on
            problems = [f"error {type(e).__name__}: {str(e)[:400]}"]
        status = "OK" if not problems else "FAIL " + "; ".join(problems)
        bad += bool(problems)
        print(f"{n:34s} {status} {time.time() - t0:.1f}s", flush=True)
    print(f"{bad} failing of {len(names)}")


if __name__ == "__main__":
    main(sys.argv)
