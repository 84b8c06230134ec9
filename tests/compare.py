"""Value comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import duckdb
import pandas as pd

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""

    def text(value) -> str:
        if value is None or value is pd.NaT or value is pd.NA or value != value:
            return "~"
        if isinstance(value, pd.Timestamp):
            return value.tz_localize(None).isoformat() if value.tzinfo else value.isoformat()
        if isinstance(value, bool):
            return str(value)
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, bool):
            return str(value)
        if isinstance(value, (int, float)):
            return repr(float(value))
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return str(value)

    out = pd.DataFrame({c: [text(x) for x in df[c].tolist()] for c in sorted(df.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True) if len(out) else out


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides hold the same rows, otherwise what differs."""
    mine = normal(spark_df.toPandas())
    theirs = normal(con.execute(sql).df())
    if list(mine.columns) != list(theirs.columns):
        return f"columns {set(mine.columns) ^ set(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    unequal = (mine != theirs).any(axis=1)
    if unequal.any():
        columns = [c for c in mine.columns if (mine[c] != theirs[c]).any()]
        first = unequal.idxmax()
        return f"{int(unequal.sum())} rows differ in {columns}: {mine.loc[first, columns].tolist()} / {theirs.loc[first, columns].tolist()}"
    return ""
