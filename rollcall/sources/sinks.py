"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.operators.audit import counted
from rollcall.operators.publish import in_batch_order


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_counted(df: DataFrame, path: str, **more: Column) -> dict[str, int]:
    """Writes the rows and returns their number (``n_rows``) and ``more`` aggregates, observed while they are written."""
    seen, observed = counted(df, **more)
    seen.write.mode("overwrite").parquet(path)
    return observed.get


def write_report(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """CSV with header; sorted reports are range-partitioned, files in order, nulls last."""
    rows = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]) if order_by else df
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_batches(lines: DataFrame, path: str, parts: int | None = None) -> None:
    """Payload lines in batch order; filters on the batch column skip files."""
    in_batch_order(lines, parts).write.mode("overwrite").parquet(path)


def write_dictionary(df: DataFrame, path: str, kind: str = "json", order_by: str = "position") -> None:
    rows = df.orderBy(order_by).drop(order_by)
    if kind == "csv":
        rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        rows.write.mode("overwrite").json(path)
