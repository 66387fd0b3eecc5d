"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/check_oracle.py [SF_DIR] [name-substring ...]
Comparison mirrors the driver: columns sorted by name, row count, and an
order-insensitive multiset of normalised row values.
"""
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from fieldlens.registry import QUERIES  # noqa: E402
from fieldlens.session import get_session  # noqa: E402
from fieldlens.sources.fixtures import RAW_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in args if not a.startswith("/")]
    import os
    tz = os.environ.get("SPARK_SESSION_TZ")
    spark = get_session("local[8]", shuffle_partitions=8)
    if tz:  # check independence from the session time zone
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name, (fn, sql) in QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.sql(sql)
            dcols, drows = res.columns, res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sm = rows_multiset(scols, srows)
        dc, dm = rows_multiset(dcols, drows)
        if sc != dc:
            print(f"FAIL {name}: columns differ\n  spark {sc}\n  duck  {dc}")
            bad += 1
        elif sm != dm:
            only_s = list((sm - dm).items())[:3]
            only_d = list((dm - sm).items())[:3]
            print(f"FAIL {name}: values differ (spark {len(srows)} rows, duck {len(drows)})\n  spark-only {only_s}\n  duck-only  {only_d}")
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
            ok += 1
    print(f"{ok} ok, {bad} failed")
    spark.stop()


if __name__ == "__main__":
    main()
