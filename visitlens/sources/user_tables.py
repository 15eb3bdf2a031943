"""A user's own tables, in the reference's shapes, as the jobs' input.

Every job takes the folder of the driver's tables or a ``UserTables``; the
readers in ``fixtures`` hand over to it. Nothing is collected or inferred:
columns that a report does not use are pruned, date ranges are pushed down.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.sources.logs import read_text


@dataclass(frozen=True)
class UserTables:
    """Where the tables are: files of ``fmt`` under ``folder/<name>``, or with
    ``fmt`` "table" catalog tables ``<folder>.<name>``. ``names`` renames
    tables. Logs (``ad_log``, ``course_log``) are text files, a line a row."""

    folder: str
    fmt: str = "parquet"
    names: dict[str, str] = field(default_factory=dict)

    def _place(self, name: str) -> str:
        return self.names.get(name, name)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        place = self._place(name)
        if self.fmt == "table":
            return spark.table(f"{self.folder}.{place}" if self.folder else place)
        reader = spark.read.format(self.fmt)
        if self.fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(f"{self.folder.rstrip('/')}/{place}")

    def log(self, spark: SparkSession, name: str) -> DataFrame:
        return read_text(spark, f"{self.folder.rstrip('/')}/{self._place(name)}")

    def actions(self, spark, start_date=None, end_date=None) -> DataFrame:
        """``user_visit_action``; actions of one session at the same time are
        ordered by ``action_id``, or if there is none by a hash of the row."""
        t = self.read(spark, "user_visit_action")
        if start_date:
            t = t.where(F.col("date") >= start_date)
        if end_date:
            t = t.where(F.col("date") <= end_date)
        numbers = ["user_id", "page_id", "click_category_id", "click_product_id", "city_id"]
        t = t.withColumns({c: F.col(c).cast("bigint") for c in numbers})
        if "action_id" not in t.columns:
            t = t.withColumn("action_id", F.xxhash64(*t.columns))
        return t.withColumn("action_time", F.col("action_time").cast("timestamp"))

    def users(self, spark) -> DataFrame:
        return self.read(spark, "user_info").withColumns(
            {"user_id": F.col("user_id").cast("bigint"), "age": F.col("age").cast("int")})

    def products(self, spark) -> DataFrame:
        return self.read(spark, "product_info").withColumn("product_id", F.col("product_id").cast("bigint"))

    def course_table(self, spark, day=None) -> DataFrame:
        """``user_behavior``; a day prunes the ``dt`` partition."""
        t = self.read(spark, "user_behavior").withColumn("dt", F.col("dt").cast("int"))
        return t if day is None else t.where(F.col("dt") == int(day.replace("-", "")))

    def course_lines(self, spark, start_date=None, end_date=None) -> DataFrame:
        return self.log(spark, "course_log")

    def ad_click_lines(self, spark, start_date=None, end_date=None) -> DataFrame:
        return self.log(spark, "ad_log")

    def initial_blacklist(self, spark) -> DataFrame:
        return self.read(spark, "ad_blacklist").select(F.col("userid").cast("bigint").alias("userid"))

    def vip_users(self, spark) -> DataFrame:
        return self.read(spark, "vip_user").select("id", F.col("uid").cast("bigint").alias("uid"))

    def ip_ranges(self, spark) -> DataFrame:
        """(start_num, end_num, region), addresses as numbers, both ends included."""
        return self.read(spark, "ip_ranges").select(
            F.col("start_num").cast("bigint").alias("start_num"), F.col("end_num").cast("bigint").alias("end_num"), "region")


def or_user_table(fixture):
    """Let a reader over the driver's tables take a ``UserTables`` instead of
    their folder: its method of the same name answers."""
    @functools.wraps(fixture)
    def read(spark: SparkSession, where=None, *args, **kwargs) -> DataFrame:
        if isinstance(where, UserTables):
            return getattr(where, fixture.__name__)(spark, *args, **kwargs)
        return fixture(spark, where, *args, **kwargs)
    return read
