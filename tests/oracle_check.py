"""python tests/oracle_check.py [SF_DIR] NAME...: run queries beside their DuckDB twins and compare the rows."""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import __spark_entry__ as entry


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    norm = lambda v: None if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v) else float(v) if isinstance(v, int) and not isinstance(v, bool) else round(v, 6) if isinstance(v, float) else str(list(v)) if hasattr(v, "__len__") and not isinstance(v, (str, bytes, dict)) else v
    return sorted((tuple(norm(v) for v in r) for r in frame.astype(object).itertuples(index=False)), key=str)


def main() -> int:
    args = sys.argv[1:]
    d = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "10g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sql, all_queries, bad = entry.oracle_sql(), entry.queries(), 0
    for name in args or all_queries:
        t = time.time()
        got = all_queries[name](spark, d).toPandas()
        took = time.time() - t
        if name not in sql:
            print(f"{name}: {len(got)} rows in {took:.1f} s, no SQL twin", flush=True)
            continue
        con = duckdb.connect()
        for f in sorted(os.listdir(d)):
            con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{d}/{f}{'' if os.path.isfile(f'{d}/{f}') else '/*.parquet'}')")
        t = time.time()
        want = con.execute(sql[name]).fetchdf()
        a, b = rows(got), rows(want)
        same = sorted(got.columns) == sorted(want.columns) and a == b
        bad += not same
        print(f"{name}: {'same' if same else 'DIFFERENT'}, {len(a)} and {len(b)} rows, {took:.1f} and {time.time() - t:.1f} s", flush=True)
        if not same:
            print(sorted(got.columns), sorted(want.columns), *[x for x in zip(a, b) if x[0] != x[1]][:3], sep="\n  ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
