"""Time the DuckDB oracle SQL of the headline queries (single-node yardstick).

Usage: python tools/bench_oracle.py [sf_dir]; prints one JSON line.
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import oracle_sql_text  # noqa: E402
from bench import HEADLINE  # noqa: E402
from pacecast.sources.tables import TABLES  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"SET threads TO {int(os.environ.get('BENCH_CPUS', '8'))}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    sqls = oracle_sql_text.registry()
    out = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        con.sql(sqls[name]).fetchall()
        out[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": sf, "queries": out,
                      "value": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
