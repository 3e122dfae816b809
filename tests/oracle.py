"""Side-by-side run of a catalogue query and its DuckDB SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        files = f"{path}/*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def bag(columns: list[str], rows) -> Counter:
    """Rows as a multiset, columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> tuple[int, str]:
    """(rows, '') when equal, else (rows, what differs)."""
    rel = con.execute(sql)
    want_cols = [c[0] for c in rel.description]
    want = bag(want_cols, rel.fetchall())
    got_cols = spark_df.columns
    got = bag(got_cols, spark_df.collect())
    if sorted(got_cols) != sorted(want_cols):
        return sum(got.values()), f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    if got != want:
        extra, lacking = got - want, want - got
        return sum(got.values()), (
            f"{sum(extra.values())} extra, {sum(lacking.values())} lacking; "
            f"e.g. {list(extra)[:3]} / {list(lacking)[:3]}"
        )
    return sum(got.values()), ""
