"""Sinks K1-K11: run-id append, merge meanings, text, day and managed tables.

The merge meanings of the reference's MySQL upserts are plain DataFrame
functions (``merge_overwrite``, ``merge_add``, ``replace_groups``,
``append_new``); ``visitlens.sinks.stored`` applies them to stored tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --- merge meanings -------------------------------------------------------------

def merge_overwrite(old: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """K3/K4/K7: rows of ``delta`` replace rows of ``old`` with equal keys."""
    kept = old.join(delta.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(delta.select(*old.columns))


def merge_add(old: DataFrame, delta: DataFrame, keys: list[str], value: str) -> DataFrame:
    """K2: values of equal keys are added; new keys are inserted. One
    aggregation over the union (partial combine, one shuffle)."""
    both = old.select(*keys, value).unionByName(delta.select(*keys, value))
    return (both.groupBy(*keys).agg(F.sum(value).cast(old.schema[value].dataType).alias(value))
            .select(*old.columns))


def replace_groups(old: DataFrame, delta: DataFrame, group_keys: list[str]) -> DataFrame:
    """K5: every group present in ``delta`` is deleted from ``old`` and
    replaced by the group's rows in ``delta``."""
    kept = old.join(delta.select(*group_keys).distinct(), group_keys, "left_anti")
    return kept.unionByName(delta.select(*old.columns))


def append_new(old: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """K6 with set semantics (Q17 fixed): only keys not present are added."""
    fresh = delta.select(*old.columns).dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh)


def with_run_id(df: DataFrame, run_id: str | None = None, column: str = "taskid") -> DataFrame:
    """K1: tag a result with the run id (random UUID unless given, F20)."""
    return df.withColumn(column, F.lit(run_id or str(uuid.uuid4())))


def append_result(df: DataFrame, path: str, run_id: str | None = None, fmt: str = "parquet") -> None:
    """K1: append a tagged result to a table path."""
    with_run_id(df, run_id).write.mode("append").format(fmt).save(path)


def append_jdbc(df: DataFrame, url: str, table: str, run_id: str | None = None,
                properties: dict | None = None) -> None:
    """K1 to a database table (needs the driver jar on the classpath)."""
    with_run_id(df, run_id).write.mode("append").jdbc(url, table, properties=properties or {})


def write_text(df: DataFrame, path: str, files: int | None = None) -> None:
    """K8: one text column to files. ``files`` coalesces the output (the
    reference writes 3); leave it unset at scale so every task writes."""
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").text(path)


def write_day_table(df: DataFrame, path: str, day_col: str = "dt", sep: str = "\t") -> None:
    """K9: tab-delimited table partitioned by day; a rerun replaces only the
    days it writes (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("sep", sep).partitionBy(day_col).csv(path))


def save_table(df: DataFrame, name: str) -> None:
    """Drop and recreate a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K11."""
    df.createOrReplaceTempView(name)
    return df
