"""Side-by-side check of a Spark query against its DuckDB oracle.

Same idea as the driver's gate: row count, column names, and an
order-insensitive hash of the values. Used by the tests and by hand::

    python -m editstream.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir.rstrip('/')}/{t}.parquet"
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
        except duckdb.Error:
            pass
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer() and abs(v) < 2 ** 53:
            return str(int(v))
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def value_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("\x1f".join(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))
    return hashlib.sha256("\x1e".join(rows).encode()).hexdigest()[:16]


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> dict:
    out = {
        "rows": (len(spark_df), len(oracle_df)),
        "cols_match": sorted(spark_df.columns) == sorted(oracle_df.columns),
    }
    if out["cols_match"]:
        out["hash_match"] = value_hash(spark_df) == value_hash(oracle_df)
    else:
        out["cols"] = (sorted(spark_df.columns), sorted(oracle_df.columns))
        out["hash_match"] = False
    out["ok"] = out["cols_match"] and out["hash_match"] and out["rows"][0] == out["rows"][1]
    return out


def diff_rows(spark_df: pd.DataFrame, oracle_df: pd.DataFrame, n: int = 5) -> str:
    cols = sorted(spark_df.columns)
    a = {"\x1f".join(_norm(v) for v in r) for r in spark_df[cols].astype(object).itertuples(index=False)}
    b = {"\x1f".join(_norm(v) for v in r) for r in oracle_df[cols].astype(object).itertuples(index=False)}
    only_a = sorted(a - b)[:n]
    only_b = sorted(b - a)[:n]
    return f"cols={cols}\nspark-only={only_a}\noracle-only={only_b}"


def main(argv: list[str]) -> int:
    import importlib.util
    import os

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spec = importlib.util.spec_from_file_location("entry", os.path.join(root, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from editstream.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        sdf = qs[name](spark, sf_dir).toPandas()
        if name not in oracles:
            print(f"{name:28s} rows={len(sdf)} (no oracle)")
            continue
        odf = con.execute(oracles[name]).df()
        res = compare(sdf, odf)
        print(f"{name:28s} {'OK ' if res['ok'] else 'BAD'} {res}")
        if not res["ok"]:
            bad += 1
            if res["cols_match"]:
                print(diff_rows(sdf, odf))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
