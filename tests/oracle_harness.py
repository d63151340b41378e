"""Side-by-side check of a registered Spark query against its DuckDB oracle.

Compares row count, column names and an order-insensitive hash of the values
(columns sorted by name; floats compared after rounding to 9 significant
digits -- or exactly with ORACLE_EXACT=1 --, dates/timestamps as ISO text).
"""

from __future__ import annotations

import hashlib
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == 0:
            return "0"
        return repr(v) if os.environ.get("ORACLE_EXACT") else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s
    if isinstance(v, bool):
        return str(v).lower()
    try:
        if float(v) == int(float(v)) and not isinstance(v, str):
            return str(int(v))
    except (TypeError, ValueError, OverflowError):
        pass
    try:
        if not isinstance(v, str):
            return f"{float(v):.9g}"
    except (TypeError, ValueError):
        pass
    return str(v)


def table_hash(rows: list[dict], cols: list[str]) -> str:
    cols = sorted(cols)
    lines = sorted("|".join(_norm(r[c]) for c in cols) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def spark_rows(df) -> tuple[list[str], list[dict]]:
    cols = df.columns
    return cols, [r.asDict(recursive=True) for r in df.collect()]


def duck_rows(con, sql: str) -> tuple[list[str], list[dict]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, [dict(zip(cols, r)) for r in cur.fetchall()]


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = False) -> dict:
    import __spark_entry__ as E
    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    scols, srows = spark_rows(q(spark, sf_dir))
    out = {"query": name, "spark_rows": len(srows)}
    if sql is None:
        out["oracle"] = "none"
        return out
    con = con or duck_conn(sf_dir)
    dcols, drows = duck_rows(con, sql)
    out.update(oracle_rows=len(drows),
               cols_match=sorted(scols) == sorted(dcols),
               rows_match=len(srows) == len(drows))
    out["hash_match"] = out["cols_match"] and table_hash(srows, scols) == table_hash(drows, dcols)
    if verbose and not out["hash_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
        if out["cols_match"]:
            c = sorted(scols)
            a = sorted("|".join(_norm(r[k]) for k in c) for r in srows)
            b = sorted("|".join(_norm(r[k]) for k in c) for r in drows)
            out["cols"] = "|".join(c)
            out["only_spark"] = [x for x in a if x not in set(b)][:3]
            out["only_oracle"] = [x for x in b if x not in set(a)][:3]
    return out


if __name__ == "__main__":
    from panelsight.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    spark = get_spark()
    con = duck_conn(sf)
    bad = 0
    for n in names or list(E.queries()):
        try:
            r = compare(spark, n, sf, con, verbose=True)
        except Exception as e:  # noqa: BLE001
            r = {"query": n, "error": repr(e)[:400]}
        ok = r.get("hash_match", r.get("oracle") == "none")
        bad += not ok
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)
