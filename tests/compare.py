"""Compare a Spark result with its DuckDB text, exactly."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def open_duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(by=list(frame.columns), key=lambda s: s.astype(str), kind="stable").reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, duck_frame: pd.DataFrame) -> list[str]:
    left, right = normal(spark_frame), normal(duck_frame)
    if list(left.columns) != list(right.columns):
        return [f"columns {list(left.columns)} vs {list(right.columns)}"]
    found = []
    for name in left.columns:
        if str(left[name].dtype) != str(right[name].dtype):
            found.append(f"type of {name}: {left[name].dtype} vs {right[name].dtype}")
    if len(left) != len(right):
        return [*found, f"rows {len(left)} vs {len(right)}"]
    for name in left.columns:
        one, two = left[name], right[name]
        both_null = one.isna() & two.isna()
        unequal = ~(both_null | (one.astype(object) == two.astype(object)))
        if unequal.any():
            at = unequal.idxmax()
            found.append(f"{name}: {int(unequal.sum())} differ, first {one[at]!r} vs {two[at]!r}")
    return found
