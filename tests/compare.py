"""Run queries against their SQL twins: ``python tests/compare.py [sf_dir] [name ...]``."""

import sys
import time
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def in_order(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(rows, key=repr)


def difference(con, df, sql):
    """None when both give the same rows; else what differs."""
    got = in_order(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = in_order([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    return f"{len(bad)} rows differ, first: {bad[0]!r}"[:1500] if bad else None


def main(sf, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = difference(con, query(spark, sf), entry.oracle_sql()[name])
        except Exception as e:
            problem = f"{type(e).__name__}: {e}"[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
