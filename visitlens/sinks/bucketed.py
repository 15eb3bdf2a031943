"""Managed tables bucketed by a key (K10), so that folds by that key and joins on
it read their buckets side by side and shuffle nothing.

A bucket is read by one task. Keys that hold more than a bucket's even share of
the rows, and rows without a key, would make one bucket the largest of all: they
go to a second, plain table, where a fold shuffles partial aggregates as usual.
The two tables share no key, so a fold by the key is the union of both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_bounded

#: buckets of a table: as many as keep one of them at about the size of a scan split
BUCKETS = 16


class BucketedTable:
    """``name`` (bucketed by ``key``) and ``name``_hot (hot keys and null ones)."""

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int = BUCKETS):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets
        self.hot_name = f"{name}_hot"

    def save(self, rows: DataFrame) -> "BucketedTable":
        """Drop and recreate both tables from ``rows``. A key is hot from more
        than rows / buckets rows on: fewer keys than buckets are, so their list
        is broadcast. ``rows`` is read three times: to count, and for each table."""
        sizes = rows.where(F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
        share = rows.agg(F.count(F.lit(1)) / F.lit(self.buckets)).scalar()
        hot = broadcast_bounded(sizes.where(F.col("_n") > share).select("_hot"), self.buckets)
        same = F.col(self.key) == F.col("_hot")
        # a bucket is one file: rows are dealt as bucketBy deals them
        (rows.where(F.col(self.key).isNotNull()).join(hot, same, "left_anti").repartition(self.buckets, self.key)
         .write.mode("overwrite").bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self.name))
        (rows.join(hot, same, "left").where(F.col("_hot").isNotNull() | F.col(self.key).isNull()).drop("_hot")
         .write.mode("overwrite").saveAsTable(self.hot_name))
        return self

    def read(self) -> DataFrame:
        """All rows."""
        return self.spark.table(self.name).unionByName(self.spark.table(self.hot_name))

    def fold(self, by_key: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``by_key``, which groups by the key (and more), over all rows: without
        an exchange over the buckets."""
        return by_key(self.spark.table(self.name)).unionByName(by_key(self.spark.table(self.hot_name)))
