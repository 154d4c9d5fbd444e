"""Run registered queries against their SQL and report differences."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def difference(df, con, sql: str) -> str | None:
    """None when names, rows and values agree exactly."""
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    types = {c[0]: str(c[1]) for c in rel.description}
    spark_types = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    odd = {c: (t, types[c]) for c, t in df.dtypes if spark_types.get(types[c]) != t}
    if odd:
        return f"types differ: {odd}"
    pick = [names.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in pick) for r in rel.fetchall()]
    if len(rows) != len(want):
        return f"{len(rows)} rows vs {len(want)}"
    rows.sort(key=_key), want.sort(key=_key)
    bad = [(a, b) for a, b in zip(rows, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    qs, sqls = e.queries(), e.oracle_sql()
    names = [n for n in qs if not argv or n in argv]
    fails = 0
    for n in names:
        t = time.time()
        try:
            df = qs[n](spark, sf)
            if n in sqls:
                msg = difference(df, con, sqls[n])
            else:
                msg = None if df.count() > 0 else "no rows"
        except Exception as err:
            msg = f"{type(err).__name__}: {str(err)[:400]}"
        fails += msg is not None
        print(f"{'ok  ' if msg is None else 'FAIL'} {'S' if n in sqls else 'R'} {time.time() - t:6.2f}s {n}"
              + (f"\n       {msg}" if msg else ""), flush=True)
    print(f"{len(names)} queries, {fails} failures")
    spark.stop()
    return fails


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
