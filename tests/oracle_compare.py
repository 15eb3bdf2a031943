"""Run a registered query on Spark and its SQL on DuckDB, compare results.

Columns are sorted by name, rows compared as a multiset. Usage:
    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry
    q = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = rows_of(s_cols, s_rows)
    dc, dr = rows_of(d_cols, d_rows)
    res["cols_match"] = sc == dc
    res["match"] = sc == dc and sr == dr
    if not res["match"]:
        res["spark_cols"], res["oracle_cols"] = sc, dc
        missing = [r for r in dr if r not in set(sr)][:3]
        extra = [r for r in sr if r not in set(dr)][:3]
        res["only_oracle"], res["only_spark"] = missing, extra
    return res


def main(argv):
    from visitlens.session import build_session
    import __spark_entry__ as entry
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"name": n, "error": repr(exc)[:500]}
        ok = r.get("match") or r.get("oracle") == "none"
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
