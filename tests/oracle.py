"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: same column names, same row count, and equal
values after sorting columns by name and rows by value.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from attrition.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v)


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                            for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, tol: float = 0.0) -> str | None:
    """None when equal, else a short reason."""
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return f"rows {len(spark_pdf)} != {len(duck_pdf)}"
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if isinstance(x, float) and isinstance(y, (int, float)) and not isinstance(y, bool):
                if x != y and abs(x - y) > tol * max(1.0, abs(x)):
                    return f"value {x!r} != {y!r} in {ra} vs {rb}"
            elif isinstance(y, float) and isinstance(x, int):
                if float(x) != y:
                    return f"value {x!r} != {y!r}"
            elif x != y:
                return f"value {x!r} != {y!r} in {ra} vs {rb}"
    return None
