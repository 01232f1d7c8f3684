"""Run queries and their check SQL side by side: ``python check.py [sf_dir] [name-part ...]``."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from queries import load_all  # noqa: E402
from queries.registry import ORACLES, QUERIES, TABLES  # noqa: E402
from shelfmark.session import local_session  # noqa: E402


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, (Decimal, float)):
        return f"{float(value):.6f}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.6f}"
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return str(value)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    got = table([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        return "rows only", len(got[1]), None
    result = con.execute(ORACLES[name])
    want = table(result.fetchall(), [d[0] for d in result.description])
    if got == want:
        return "ok", len(got[1]), None
    if got[0] != want[0]:
        return "COLUMNS", len(got[1]), (got[0], want[0])
    differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
    return "DIFFERS", len(got[1]), (len(got[1]), len(want[1]), got[0], differing)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = local_session()
    load_all()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = []
    for name in QUERIES:
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            status, n, detail = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            status, n, detail = "ERROR", 0, str(error)[:1500]
        print(f"{status:10} {name:40} rows={n} {time.time() - start:.1f}s", flush=True)
        if status not in ("ok", "rows only"):
            bad.append(name)
            print("   ", detail, flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
