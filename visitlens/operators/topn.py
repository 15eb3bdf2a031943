"""Top-k (T1) and top-n per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order_by: list, k: int) -> DataFrame:
    """Global top-k: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject
    (each task keeps k rows; no full sort, no single hot task)."""
    return df.orderBy(*order_by).limit(k)


def top_n_per_group(df: DataFrame, group_by: list, order_by: list, n: int,
                    rank_col: str | None = None) -> DataFrame:
    """``row_number() over (partition by g order by o) <= n``.

    ``n`` is a constant, so Catalyst inserts WindowGroupLimit: a partial limit
    runs before the shuffle, so a hot group ships at most ``n`` rows per map
    task instead of all its rows. ``order_by`` should end in a unique
    tie-breaker (Q9).
    """
    w = Window.partitionBy(*group_by).orderBy(*order_by)
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(n))
    return out if rank_col else out.drop(name)
