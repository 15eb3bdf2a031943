"""Batch twins of the ad-click stream jobs B13-B16.

The stream (``visitlens.streaming.ads``) applies exactly these transforms to
each micro-batch; the twins apply them to the whole log at once so the
DuckDB oracle can check them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import format_date_key
from visitlens.operators.joins import drop_members
from visitlens.operators.topn import top_n_per_group
from visitlens.sources import fixtures as src
from visitlens.sources.logs import parse_ad_lines

USER_CLICK_COLUMNS = ["date", "userid", "adid", "click_count"]
AD_STAT_COLUMNS = ["date", "province", "city", "adid", "click_count"]
PROVINCE_TOP_COLUMNS = ["date", "province", "adid", "click_count"]
TREND_COLUMNS = ["date", "hour", "minute", "adid", "click_count"]


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ad_lines(src.ad_click_lines(spark, sf_dir))


def remove_blacklisted(clicks_df: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Drop clicks of listed users (anti join; the list is data-sized,
    so AQE picks broadcast or shuffle)."""
    return drop_members(clicks_df, blacklist.select("userid"), "userid")


def user_click_counts(clicks_df: DataFrame) -> DataFrame:
    """Clicks by (day, user, ad)."""
    return (clicks_df.groupBy(format_date_key("ts").alias("date"), "userid", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def over_threshold_users(totals: DataFrame, blacklist: DataFrame, threshold: int) -> DataFrame:
    """Users with any (day, ad) total above ``threshold`` who are not listed
    yet (set semantics, Q17 fixed)."""
    over = totals.where(F.col("click_count") > threshold).select("userid").distinct()
    return drop_members(over, blacklist.select("userid"), "userid")


def ad_stat(clicks_df: DataFrame) -> DataFrame:
    """Clicks by (day, province, city, ad)."""
    return (clicks_df.groupBy(format_date_key("ts").alias("date"), "province", "city", "adid")
            .agg(F.count(F.lit(1)).alias("click_count")))


def province_top3(stat: DataFrame, n: int = 3) -> DataFrame:
    """A14 + W2: roll (day, province, city, ad) up to (day, province, ad), keep
    the ``n`` ads with most clicks per (day, province); ties by ad id."""
    rolled = stat.groupBy("date", "province", "adid").agg(F.sum("click_count").alias("click_count"))
    return top_n_per_group(rolled, ["date", "province"], [F.desc("click_count"), F.asc("adid")], n) \
        .select(*PROVINCE_TOP_COLUMNS)


def click_trend(clicks_df: DataFrame) -> DataFrame:
    """A per-minute event-time count per ad, split into date / hour / minute
    text (P17). Readers take the last 60 minutes (Q26 fixed)."""
    minute = F.date_trunc("minute", F.col("ts"))
    per_minute = clicks_df.groupBy(minute.alias("minute_ts"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
    return per_minute.select(F.date_format("minute_ts", "yyyyMMdd").alias("date"),
                             F.date_format("minute_ts", "HH").alias("hour"),
                             F.date_format("minute_ts", "mm").alias("minute"),
                             "adid", "click_count")


# --- registered twins (one batch, the initial blacklist) -------------------------

def blacklist_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B13 twin, table ``ad_user_click_count`` after one batch."""
    kept = remove_blacklisted(clicks(spark, sf_dir), src.initial_blacklist(spark, sf_dir))
    return user_click_counts(kept).select(*USER_CLICK_COLUMNS)


def blacklist_after_batch(spark: SparkSession, sf_dir: str, threshold: int = 100) -> DataFrame:
    """B13 twin, table ``ad_blacklist`` after one batch: listed users plus
    users over the threshold."""
    listed = src.initial_blacklist(spark, sf_dir)
    totals = blacklist_user_counts(spark, sf_dir)
    return listed.unionByName(over_threshold_users(totals, listed, threshold))


def ad_stat_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B14 twin."""
    kept = remove_blacklisted(clicks(spark, sf_dir), src.initial_blacklist(spark, sf_dir))
    return ad_stat(kept).select(*AD_STAT_COLUMNS)


def province_top3_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B15 twin."""
    return province_top3(ad_stat_twin(spark, sf_dir))


def click_trend_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B16 twin: every minute."""
    kept = remove_blacklisted(clicks(spark, sf_dir), src.initial_blacklist(spark, sf_dir))
    return click_trend(kept).select(*TREND_COLUMNS)


def click_trend_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B16 as a reader sees it: the 60 minutes up to the latest click."""
    listed = src.initial_blacklist(spark, sf_dir)
    # one value: the latest minute; its hour can begin the day before
    latest = remove_blacklisted(clicks(spark, sf_dir), listed).agg(
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:00"), F.date_format(F.max("ts") - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd")).first()
    recent = parse_ad_lines(src.ad_click_lines(spark, sf_dir, latest[1]))  # the scan skips earlier days
    minute = F.date_trunc("minute", F.col("ts"))
    hour = recent.where(minute > F.lit(latest[0]).cast("timestamp") - F.expr("INTERVAL 60 MINUTES"))
    return click_trend(remove_blacklisted(hour, listed)).select(*TREND_COLUMNS)
