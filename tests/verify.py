"""Oracle comparison used by the tests and ``scripts/oracle_check.py``:
run a registered query on Spark and its SQL on DuckDB over the same parquet
folder; compare row count, column names and an order-insensitive hash."""

from __future__ import annotations

import hashlib

import pandas as pd

from wellspring.tables import TABLES


def norm(v) -> str:
    """Strict on purpose: a date never equals a timestamp and an int never
    equals a float, so outputs survive any client-side conversion."""
    if v is None or v is pd.NaT or (not isinstance(v, (str, bytes, list)) and pd.isna(v)):
        return "∅"
    if hasattr(v, "item") and not isinstance(v, pd.Timestamp):
        v = v.item()
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, float):
        return "f" + repr(round(v, 6) + 0.0)
    if isinstance(v, int):
        return "i" + str(v)
    if isinstance(v, pd.Timestamp):
        return "t" + v.to_pydatetime().isoformat(sep=" ")
    if type(v).__name__ == "datetime":
        return "t" + v.isoformat(sep=" ")
    if type(v).__name__ == "date":
        return "d" + v.isoformat()
    return repr(v)


def rows(pdf: pd.DataFrame) -> list[str]:
    cols = sorted(pdf.columns)
    return sorted("|".join(norm(r[c]) for c in cols) for r in pdf.to_dict("records"))


def digest(pdf: pd.DataFrame) -> str:
    return hashlib.sha256("\n".join(rows(pdf)).encode()).hexdigest()[:16]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> dict:
    same_cols = sorted(spark_pdf.columns) == sorted(oracle_pdf.columns)
    out = {
        "columns": same_cols,
        "rows": len(spark_pdf) == len(oracle_pdf),
        "hash": same_cols and digest(spark_pdf) == digest(oracle_pdf),
    }
    out["ok"] = all(out.values())
    if same_cols and not out["hash"]:
        a, b = rows(spark_pdf), rows(oracle_pdf)
        sa, sb = set(a), set(b)
        out["spark_only"] = [x for x in a if x not in sb][:3]
        out["oracle_only"] = [x for x in b if x not in sa][:3]
    return out
