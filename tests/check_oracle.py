"""Compare registered queries with their SQL at a scale factor: python tests/check_oracle.py DIR [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in frame.collect())


def duck_rows(con, sql):
    found = con.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    names = [found.columns[i] for i in order]
    return names, Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def compare(spark, con, name, sf_dir):
    started = time.time()
    names, got = spark_rows(queries()[name](spark, sf_dir))
    spent = time.time() - started
    want_names, want = duck_rows(con, oracle_sql()[name])
    return names == want_names and got == want, names, want_names, got, want, spent


def main() -> int:
    from tickspark.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in chosen or queries():
        if name not in oracle_sql():
            print(f"-- {name}: no SQL")
            continue
        try:
            ok, names, want_names, got, want, spent = compare(spark, con, name, sf_dir)
        except Exception as error:  # keep going, report all
            print(f"!! {name}: {str(error)[:900]}")
            bad += 1
            continue
        print(f"{'ok' if ok else 'XX'} {name} rows={sum(got.values())} {spent:.1f}s", flush=True)
        if not ok:
            bad += 1
            if names != want_names:
                print("   columns", names, want_names)
            print("   want rows", sum(want.values()))
            print("   only spark", list((got - want).items())[:2])
            print("   only duck ", list((want - got).items())[:2])
    return bad


if __name__ == "__main__":
    sys.exit(main())
