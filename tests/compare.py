"""Compare every named query with its SQL: python tests/compare.py [sf folder] [names]."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
        result = db.execute(sql)
        columns = [c[0] for c in result.description]
        return _sorted(columns, result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, bool):
        return ("bool", value)
    return value


def _sorted(columns: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda c: columns[c])
    return ([columns[c] for c in order],
            Counter(tuple(_plain(row[c]) for c in order) for row in rows))


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, bad = new_session(), []
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
            took = time.time() - started
            want = sql_rows(sf_dir, sql[name])
        except Exception as error:  # report, and go on with the others
            print(f"{name}: ERROR {str(error)[:1500]}", flush=True)
            bad.append(name)
            continue
        same = got == want
        print(f"{name}: {'ok' if same else 'DIFFERS'} rows={sum(got[1].values())} {took:.1f}s",
              flush=True)
        if not same:
            bad.append(name)
            print("  columns", got[0], want[0])
            print("  only spark", list((got[1] - want[1]).items())[:3])
            print("  only sql  ", list((want[1] - got[1]).items())[:3])
    print(f"{len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
