"""Course streams: unpaid-order follow-ups (B17) and daily new VIPs.

B17 is a stateful sliding-window aggregation on event time; the watermark
drops a window's state once it can no longer change (Q18 fixed). Spark
still aggregates a late row whose window is in state, and a row arriving
after eviction starts a window holding only late rows: that can only
under-count, so the follow-up set never gains a false member.

B18 keeps no stream state: each micro-batch adds its counts per (province,
day) to a table that readers sum. A late row then adds to its own day exactly,
where an evicted window re-created by a late row would have overwritten a full
count with a partial one. ``start_vip_state_stream`` is the form with state, for
logs whose rows come within a watermark.

Lines that the parser drops go to a table of their own (``start_rejects_stream``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens.functions.columns import format_date
from visitlens.operators.joins import drop_members
from visitlens.plans.course import with_region
from visitlens.sinks.stored import MERGE_EVERY, BatchTable, KeyedTable
from visitlens.sources.logs import course_rejects, parse_course_lines
from visitlens.streaming.batches import start_batches

UNPAID_SCHEMA = T.StructType([T.StructField("uid", T.LongType(), True),
                              T.StructField("phone", T.StringType(), True)])
VIP_SCHEMA = T.StructType([T.StructField("province", T.StringType(), True),
                           T.StructField("cnt", T.LongType(), True),
                           T.StructField("dt", T.StringType(), True)])


REJECT_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True),
                              T.StructField("lines", T.LongType(), True)])


def unpaid_table(spark: SparkSession, path: str, merge_every: int = MERGE_EVERY) -> BatchTable:
    return BatchTable(spark, path, UNPAID_SCHEMA, bucket_by=["uid"], merge_every=merge_every)


def vip_table(spark: SparkSession, path: str, merge_every: int = MERGE_EVERY) -> BatchTable:
    return BatchTable(spark, path, VIP_SCHEMA, ["province", "dt"], "cnt", "dt", buckets=1, merge_every=merge_every)


def vip_state_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, VIP_SCHEMA, ["province", "dt"], "dt", buckets=1)


def reject_table(spark: SparkSession, path: str, merge_every: int = MERGE_EVERY) -> BatchTable:
    """Lines that are no course lines, and how often each came."""
    return BatchTable(spark, path, REJECT_SCHEMA, ["value"], "lines", merge_every=merge_every)


def start_unpaid_stream(lines: DataFrame, vip: Callable[[], DataFrame], table: BatchTable, checkpoint: str,
                        window: str = "4 days", slide: str = "2 days", min_visits: int = 2,
                        *, watermark: str, available_now: bool = False,
                        processing_time: str | None = "10 seconds") -> StreamingQuery:
    """(uid, phone) with more than ``min_visits`` order-page visits in a
    sliding event-time window (ST3), minus VIPs (J8), kept as a set (K7).
    ``vip`` reads the VIP table and is called in every batch, so a VIP added
    meanwhile counts. ``watermark``: how late a visit may come; state is kept
    that much longer, and visits that are later still are lost to windows that
    have closed. A batch adds its members; the table reads as a set."""
    orders = (parse_course_lines(lines).where(F.col("event_key") == "enterOrderPage")
              .withWatermark("ts", watermark))
    counts = (orders.groupBy(F.window("ts", window, slide), "uid", "phone")
              .agg(F.count(F.lit(1)).alias("visits")))

    def sink(batch: DataFrame, run: str, batch_id: int) -> None:
        table.merge_log(run, batch_id)
        hits = batch.where(F.col("visits") > min_visits).select("uid", "phone").distinct()
        table.append(drop_members(hits, vip().select("uid"), "uid"), run, batch_id)

    return start_batches(counts, sink, checkpoint, "update", available_now, processing_time)


def start_vip_stream(lines: DataFrame, ranges: DataFrame, table: BatchTable, checkpoint: str,
                     ranges_bound: int | None = None, available_now: bool = False,
                     processing_time: str | None = "10 seconds") -> StreamingQuery:
    """Running count of ``completeOrder`` rows per (day, province)
    (ST5); province by IP range (J9), looked up batch by batch. Each batch adds
    its counts (K2)."""
    orders = parse_course_lines(lines).where(F.col("event_key") == "completeOrder")

    def sink(batch: DataFrame, run: str, batch_id: int) -> None:
        table.merge_log(run, batch_id)
        counts = with_region(batch, ranges, ranges_bound).groupBy("province", format_date("ts").alias("dt")).agg(F.count(F.lit(1)).alias("cnt"))
        table.append(counts, run, batch_id)

    return start_batches(orders, sink, checkpoint, "append", available_now, processing_time)


def start_vip_state_stream(lines: DataFrame, ranges: DataFrame, table: KeyedTable, checkpoint: str, watermark: str,
                           ranges_bound: int | None = None, available_now: bool = False,
                           processing_time: str | None = "10 seconds") -> StreamingQuery:
    """ST5, B18 from stream state: the running count per day and province in
    event-time windows of a day; a batch overwrites the rows that changed (K3).
    State is dropped ``watermark`` after its day, and rows that are later still
    are not counted (the query's progress has their number)."""
    orders = parse_course_lines(lines).where(F.col("event_key") == "completeOrder").withWatermark("ts", watermark)
    counts = (with_region(orders, ranges, ranges_bound).groupBy(F.window("ts", "1 day").alias("w"), "province")
              .agg(F.count(F.lit(1)).alias("cnt")))
    rows = counts.select("province", "cnt", format_date("w.start").alias("dt"))
    return start_batches(rows, lambda df, run, n: table.upsert(df), checkpoint, "update", available_now, processing_time)


def start_rejects_stream(lines: DataFrame, table: BatchTable, checkpoint: str, available_now: bool = False,
                         processing_time: str | None = "10 seconds") -> StreamingQuery:
    """The lines that B17 and B18 drop, counted by line. A query of its own
    beside theirs, so that it needs no state and no watermark."""
    def sink(batch: DataFrame, run: str, batch_id: int) -> None:
        table.merge_log(run, batch_id)
        table.append(batch.groupBy("value").agg(F.count(F.lit(1)).alias("lines")), run, batch_id)

    return start_batches(course_rejects(lines), sink, checkpoint, "append", available_now, processing_time)


def recent_days(vip_table: DataFrame, as_of: str, days: int = 2) -> DataFrame:
    """P11 on read: days that started less than ``days`` before ``as_of``."""
    age = F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.to_timestamp("dt"))
    return vip_table.where(age < days * 86400)
