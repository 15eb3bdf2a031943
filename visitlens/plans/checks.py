"""Queries that run single functions and sinks over whole tables: the scalar
functions F1-F13 over columns derived from the log, and the sinks K1-K11 as
write, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions import columns as C
from visitlens.operators.rangejoin import range_sweep
from visitlens.plans import ads, course
from visitlens.session import checkpoint_dir
from visitlens.sinks import tables as K
from visitlens.sinks.stored import KeyedTable
from visitlens.sources import fixtures as src


def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F2, F3, F4, F5 (date keys), F6 over every event; every seventh text
    is no time."""
    ev = src.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    text = F.when(F.col("event_id") % 7 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd H:mm:ss"))
    noon = F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOURS")
    return ev.select(
        "event_id", C.format_time(C.parse_time(text)).alias("parsed"), C.format_minute_key("ts").alias("minute_key"),
        C.date_hour_key("ts").alias("date_hour"), C.is_before("ts", noon).alias("before_noon"), C.is_after("ts", noon).alias("after_noon"),
        C.seconds_between(F.date_trunc("day", "ts"), "ts").alias("second_of_day"),
        F.date_format(C.parse_date_key(C.format_date_key("ts")), "yyyy-MM-dd").alias("day_of_key"),
        F.date_format(C.epoch_seconds_to_date(F.unix_seconds("ts")), "yyyy-MM-dd").alias("day_of_epoch"))


def relative_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how many days every event's day lies before today and yesterday,
    as a difference that does not change with the day of the run."""
    ev = src.events(spark, sf_dir)
    return ev.select("event_id", (F.date_diff(C.today(), F.to_date("ts")) - F.date_diff(C.yesterday(), F.to_date("ts"))).alias("days_apart"))


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10-F13 over texts made from every event."""
    ev = src.events(spark, sf_dir)
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    pairs = F.concat(F.lit("id="), eid, F.lit("|user="), uid, F.lit("|none="))
    return ev.select(
        "event_id", C.trim_commas(F.concat(F.lit(",,"), eid, F.lit(","), uid, F.when(F.col("event_id") % 2 == 0, ",,,").otherwise(""))).alias("trimmed"),
        C.pad2(F.col("event_id") % 24).alias("padded"), C.kv_field(pairs, "user").alias("user_value"), C.kv_field(pairs, "none").alias("no_value"),
        C.kv_field(pairs, "other").alias("missing_value"), C.kv_set(pairs, "user", F.lit("x")).alias("set_value"))


def swept_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 over every event: the customer whose range of positions, narrow or wide,
    holds the event's; a third of the events share one position."""
    wide = F.col("c_custkey") % 1000
    ranges = src.table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") * 1000).alias("first"), (F.col("c_custkey") * 1000 + wide).alias("last"))
    ev = src.events(spark, sf_dir)
    at = F.when(F.col("event_id") % 3 == 0, 77_077).otherwise(F.col("user_id") * 1000 + F.col("event_id") * 7919 % 1000)
    found = range_sweep(ev.select("event_id", at.cast("bigint").alias("position")), "position", ranges, "first", "last")
    return found.select("event_id", "position", "c_custkey")


def _days(spark: SparkSession, sf_dir: str, parity: int | None = None) -> DataFrame:
    """Clicks by (day, province): all, or those of event ids of one parity."""
    ev = src.events(spark, sf_dir).where(F.col("event_type") == "click")
    if parity is not None:
        ev = ev.where(F.col("event_id") % 2 == parity)
    return (ev.groupBy(C.format_date("ts").alias("date"), F.concat(F.lit("P"), (F.col("user_id") % 10).cast("string")).alias("province"))
            .agg(F.count(F.lit(1)).alias("n")))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/visitlens-checks/{name}-{uuid.uuid4().hex}"


def appended_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: two runs appended to one table, read back by run."""
    path = _folder(spark, "k1")
    for parity in (0, 1):
        K.append_result(_days(spark, sf_dir, parity), path, f"run-{parity}")
    return spark.read.parquet(path).select("taskid", "date", "province", "n")


def overwritten_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4, K7: rows of odd events replace those of even ones with the same key."""
    return K.merge_overwrite(_days(spark, sf_dir, 0), _days(spark, sf_dir, 1), ["date", "province"])


def replaced_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the days on which a click of user 0 modulo 50 fell hold those users' clicks only."""
    few = _days_of(spark, sf_dir)
    return K.replace_groups(_days(spark, sf_dir), few, ["date"])


DAY_SCHEMA = "date string, province string, n long"


def _day_table(spark: SparkSession, name: str, **how) -> KeyedTable:
    return KeyedTable(spark, _folder(spark, name), T.StructType.fromDDL(DAY_SCHEMA), ["date", "province"], "date", buckets=2, **how)


def stored_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the counts of even, of odd and again of all events added to a stored
    table; the second merge is run twice with its number, and counts once."""
    table = _day_table(spark, "k2")
    for number, parity in enumerate((0, 1, 1, None)):
        table.add(_days(spark, sf_dir, parity), "n", number - (number > 1))
    return table.read()


def stored_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K7: rows of even, then of odd events written to a stored table by key."""
    table = _day_table(spark, "k3")
    for parity in (0, 1):
        table.upsert(_days(spark, sf_dir, parity))
    return table.read()


def stored_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: clicks by minute of even, then of odd events, stored under the four
    columns that make up the minute's key."""
    schema = T.StructType.fromDDL("date string, hour string, minute string, adid long, click_count long")
    table = KeyedTable(spark, _folder(spark, "k4"), schema, ["date", "hour", "minute", "adid"], "date", buckets=2)
    for parity in (0, 1):
        ev = src.events(spark, sf_dir).where((F.col("event_type") == "click") & (F.col("event_id") % 2 == parity))
        table.upsert(ads.click_trend(ev.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 5).alias("adid"))))
    return table.read()


def stored_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: as ``replaced_groups``, in a stored table."""
    table = _day_table(spark, "k5", bucket_by=["date"])
    table.upsert(_days(spark, sf_dir))
    table.replace(_days_of(spark, sf_dir), ["date"])
    return table.read()


def _days_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = src.events(spark, sf_dir).where((F.col("event_type") == "click") & (F.col("user_id") % 50 == 0))
    return (ev.groupBy(C.format_date("ts").alias("date"), F.concat(F.lit("P"), (F.col("user_id") % 10).cast("string")).alias("province"))
            .agg(F.count(F.lit(1)).alias("n")))


def written_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: the cleaned course log, written as text and read back."""
    path = _folder(spark, "k8")
    K.write_text(course.clean_course_log(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


def written_day_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: the daily study table, written for every day, then one day written
    again, which replaces that day alone."""
    path = _folder(spark, "k9")
    K.write_day_table(course.daily_study(spark, sf_dir, None), path)
    K.write_day_table(course.daily_study(spark, sf_dir, "2024-01-05"), path)
    schema = "watch_video_count long, complete_video_count long, dt int"
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table, dropped and made again, read through a view."""
    name = f"visitlens_k10_{uuid.uuid4().hex}"
    K.save_table(_days(spark, sf_dir, 0), name)
    K.save_table(_days(spark, sf_dir), name)
    K.register_view(spark.table(name).where("n > 1"), f"{name}_view")
    return spark.table(f"{name}_view")
