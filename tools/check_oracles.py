"""Run registered queries beside their SQL twins and compare the results.

usage: python tools/check_oracles.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def rows_of(frame_rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(normal(r[i]) for i in order) for r in frame_rows]
    return sorted(rows, key=repr), [names[i] for i in order]


def close(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


def main() -> int:
    import duckdb

    from plumbline.plans import ORACLES, QUERIES, load_all
    from plumbline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    load_all()
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    spark = local_session(8)
    bad = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            got = df.collect()
        except Exception as error:  # report and go on
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}", flush=True)
            continue
        spent = time.time() - start
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} ({spent:.1f}s)", flush=True)
            continue
        try:
            con_result = con.execute(ORACLES[name])
            sql_names = [d[0] for d in con_result.description]
            expected = con_result.fetchall()
        except Exception as error:
            bad += 1
            print(f"FAIL {name} (sql): {str(error)[:600]}", flush=True)
            continue
        a, a_names = rows_of(got, df.columns)
        b, b_names = rows_of(expected, sql_names)
        if a_names != b_names:
            bad += 1
            print(f"DIFF {name}: columns {a_names} vs {b_names}")
        elif a == b:
            print(f"same {name}: {len(a)} ({spent:.1f}s)", flush=True)
        else:
            bad += 1
            near = len(a) == len(b) and all(all(close(x, y) for x, y in zip(r, s)) for r, s in zip(a, b))
            off = [(r, s) for r, s in zip(a, b) if r != s][:3]
            print(f"DIFF {name}: rows {len(a)} vs {len(b)} near={near} {a_names}", flush=True)
            for r, s in off:
                print("   spark", r)
                print("   sql  ", s)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
