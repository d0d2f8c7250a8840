"""Run registered queries and their SQL side by side: python tests/check_oracles.py [sf_dir] [name ...]"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    return str(v) if not isinstance(v, int) else v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql):
    """None if equal, else a short description of the first difference."""
    mine = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = canon(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        only = [(n, x, y) for n, x, y in zip(sorted(names), *bad[0]) if x != y]
        return f"{len(bad)} of {len(mine)} rows differ, first: {only[:4]}"
    return None


def main(sf_dir, wanted):
    from pyspark.sql import SparkSession

    from creditmill.catalog import ORACLES, QUERIES

    width = os.environ.get("CHECK_PARTITIONS", "8")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", width)
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in wanted or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - start
        mark = "ok" if problem is None else "FAIL"
        print(f"{mark:4} {name:32} {took:6.1f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(main(folder, args))
