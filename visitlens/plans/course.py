"""Course behaviour jobs: B11 daily study counts, B12 log cleaning, and the
batch twins of the order-page (B17) and new-VIP (B18) streams."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import format_date, join_tabs, mask_phone, strip_line_breaks
from visitlens.operators.joins import drop_members
from visitlens.operators.rangejoin import ipv4_to_long, range_lookup, range_sweep
from visitlens.sources import fixtures as src
from visitlens.sources.logs import F_PHONE, F_USERNAME, course_fields, parse_course_lines

#: days of the new-VIP report
RECENT_DAYS = 2
STUDY_COLUMNS = ["watch_video_count", "complete_video_count", "dt"]


def _day_int(day: str) -> int:
    return int(day.replace("-", ""))


def _completed():
    """The video was watched to the end."""
    return (F.col("event_key") == "endVideo") & \
        ((F.col("end_video_time") - F.col("start_video_time")) >= F.col("video_length"))


def _for_day(behaviour: DataFrame, day: str | None) -> DataFrame:
    return behaviour if day is None else behaviour.where(F.col("dt") == _day_int(day))


def study_counts(behaviour: DataFrame, day: str | None) -> DataFrame:
    """B11 (A11): distinct users who started a video and who completed one,
    for partition ``dt = day`` (every day when ``day`` is None). Two flags per
    (day, user), then their sums; a day without either event has no row."""
    started, done = F.col("event_key") == "startVideo", F.coalesce(_completed(), F.lit(False))
    users = (_for_day(behaviour, day).where(started | done).groupBy("dt", "uid")
             .agg(F.max(started & F.col("uid").isNotNull()).alias("started"),
                  F.max(done & F.col("uid").isNotNull()).alias("done")))
    return (users.groupBy("dt")
            .agg(F.count_if("started").alias("watch_video_count"), F.count_if("done").alias("complete_video_count"))
            .select(*STUDY_COLUMNS))


def study_counts_union(behaviour: DataFrame, day: str | None) -> DataFrame:
    """B11 in the reference's form (U1): two zero-padded measures, UNION ALL,
    then a sum by day."""
    t = _for_day(behaviour, day)
    watch = (t.where(F.col("event_key") == "startVideo").groupBy("dt")
             .agg(F.count_distinct("uid").alias("watch_video_count"))
             .withColumn("complete_video_count", F.lit(0).cast("bigint")))
    done = (t.where(_completed()).groupBy("dt")
            .agg(F.count_distinct("uid").alias("complete_video_count"))
            .withColumn("watch_video_count", F.lit(0).cast("bigint")))
    return (watch.unionByName(done).groupBy("dt")
            .agg(F.sum("watch_video_count").alias("watch_video_count"),
                 F.sum("complete_video_count").alias("complete_video_count"))
            .select(*STUDY_COLUMNS))


def daily_study(spark: SparkSession, sf_dir: str, day: str | None = "2024-01-05",
                union_form: bool = False) -> DataFrame:
    """B11 for one day, or for every day of the log when ``day`` is None."""
    t = src.course_table(spark, sf_dir, day)
    return study_counts_union(t, day) if union_form else study_counts(t, day)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Keep 17-field lines, mask the phone (field 9, Q13 fixed), strip
    line breaks from the user name (field 1). Output column ``line``."""
    fields = F.transform("fields", lambda x, i: F.when(i == F_PHONE, mask_phone(x))
                         .when(i == F_USERNAME, strip_line_breaks(x)).otherwise(x))
    return course_fields(lines).select(join_tabs(fields).alias("line"))


def clean_course_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(src.course_lines(spark, sf_dir))


# --- batch twins of the course streams -------------------------------------------

def frequent_order_page_users(orders: DataFrame, vip: DataFrame, window: str = "4 days",
                              slide: str = "2 days", min_visits: int = 2) -> DataFrame:
    """B17 twin: (uid, phone) with more than ``min_visits`` order-page visits
    in some sliding window, minus VIP users (J8). ``orders`` holds parsed
    ``enterOrderPage`` rows with ``ts``."""
    counted = (orders.groupBy(F.window("ts", window, slide), "uid", "phone")
               .agg(F.count(F.lit(1)).alias("visits"))
               .where(F.col("visits") > min_visits))
    users = counted.select("uid", "phone").distinct()
    return drop_members(users, vip.select("uid"), "uid")


def unpaid_followups(spark: SparkSession, sf_dir: str, window: str = "4 days", slide: str = "2 days",
                     min_visits: int = 2) -> DataFrame:
    orders = parse_course_lines(src.course_lines(spark, sf_dir)).where(F.col("event_key") == "enterOrderPage")
    return frequent_order_page_users(orders, src.vip_users(spark, sf_dir), window, slide, min_visits)


def with_region(df: DataFrame, ranges: DataFrame, ranges_bound: int | None = None) -> DataFrame:
    """Province by IP (J9); unknown addresses get the fixed unknown label. A range
    table of unknown size is swept in order; a stream has no sorted sweep, so it
    takes the buckets."""
    keyed = df.withColumn("_ip_num", ipv4_to_long(F.col("ip")))
    table = ranges.select("start_num", "end_num", "region")
    if ranges_bound is None and not df.isStreaming:
        joined = range_sweep(keyed, "_ip_num", table)
    else:
        joined = range_lookup(keyed, "_ip_num", table, ranges_bound=ranges_bound)
    return (joined.withColumn("province", F.coalesce(F.col("region"), F.lit(src.UNKNOWN_REGION)))
            .drop("_ip_num", "start_num", "end_num", "region"))


def vip_increment(orders: DataFrame, ranges: DataFrame, as_of: str | None = None,
                  recent_days: int = RECENT_DAYS, ranges_bound: int | None = None) -> DataFrame:
    """B18 twin: ``completeOrder`` rows per (day, province); with ``as_of``
    only days whose start is less than ``recent_days`` before it (P11)."""
    if as_of is not None:  # first, so that older rows are not looked up
        age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.date_trunc("day", "ts"))
        orders = orders.where(age < recent_days * 86400)
    daily = with_region(orders, ranges, ranges_bound).withColumn("dt", format_date("ts"))
    counts = daily.groupBy("province", "dt").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select("province", "cnt", "dt")


def new_vips(spark: SparkSession, sf_dir: str, as_of: str | None = None, swept: bool = False) -> DataFrame:
    """B18 over the log; ``swept``: with the range table as one of unknown size."""
    # the first day that still counts; the log's own scan skips what is older
    first = None
    if as_of is not None:
        first = (datetime.datetime.fromisoformat(as_of) - datetime.timedelta(days=RECENT_DAYS)).date().isoformat()
    orders = parse_course_lines(src.course_lines(spark, sf_dir, first)).where(F.col("event_key") == "completeOrder")
    # the IP table: a few rows per range after the bucket explode
    bound = None if swept else src.ranges_bound(sf_dir)
    return vip_increment(orders, src.ip_ranges(spark, sf_dir), as_of, ranges_bound=bound)
