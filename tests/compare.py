"""Side-by-side comparison of a Spark result with DuckDB on the same Parquet tables."""

from pathlib import Path

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(value) -> str:
        if value is None or (not isinstance(value, str) and pd.isna(value)):
            return "NULL"
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        return repr(value.item() if hasattr(value, "item") else value)

    return sorted(tuple(map(text, row)) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None))


def differences(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> list[str]:
    """Empty when both hold the same columns and the same bag of rows."""
    if sorted(spark_frame.columns) != sorted(duck_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} != {sorted(duck_frame.columns)}"]
    ours, theirs = _rows(spark_frame), _rows(duck_frame)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    return [f"{a} != {b}" for a, b in zip(ours, theirs) if a != b][:5]
