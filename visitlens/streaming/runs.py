"""Drive the streams over lines derived from the driver tables.

Lines are staged as text files in the session's checkpoint folder and consumed
with ``availableNow``, a share of the files per micro-batch, so a run goes
through several batches. Results that depend on the order of the lines are
tested with hand-made files, not here. Used by the ``st_*`` registered queries.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from visitlens.session import checkpoint_dir
from visitlens.sources import fixtures as src
from visitlens.sources.logs import read_text_stream
from visitlens.sinks.stored import MERGE_EVERY
from visitlens.streaming.ads import (
    AdTables, start_ad_stream, start_stat_stream, start_trend_stream, stat_state_table, trend_state_table,
)
from visitlens.streaming.orders import (
    reject_table, start_rejects_stream, start_unpaid_stream, start_vip_state_stream, start_vip_stream, unpaid_table,
    vip_state_table, vip_table,
)
from visitlens.streaming.visits import VisitTables, start_visit_stream

#: micro-batches of a run, and lines of a staged file, about
BATCHES = 3
FILE_LINES = 1_000_000
#: partitions of a day in the runs' tables: a day of the driver's log is small
DAY_BUCKETS = 2


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/visitlens-streams/{name}-{uuid.uuid4().hex[:12]}"


def stage_lines(lines: DataFrame, path: str) -> int:
    """Write lines as text files of about ``FILE_LINES`` lines, at least one a
    micro-batch; returns the number of files that make up a share."""
    files = max(BATCHES, -(-lines.count() // FILE_LINES))
    lines.select("value").repartition(files).write.mode("overwrite").text(path)
    return -(-files // BATCHES)


def run_ad_stream(spark: SparkSession, sf_dir: str, threshold: int = 100,
                  slices: tuple[tuple[str | None, str | None], ...] = ((None, None),), merge_every: int = MERGE_EVERY) -> AdTables:
    """The ad stream over the click lines; ``slices`` (first day, last day) are
    delivered one after the other, each to a stream that goes on from the
    same checkpoint. ``merge_every``: batches after which logs are merged."""
    root = scratch(spark, "ads")
    tables = AdTables.at(spark, f"{root}/tables", merge_every, DAY_BUCKETS)
    tables.seed_blacklist(src.initial_blacklist(spark, sf_dir))
    for i, (first, last) in enumerate(slices):
        share = stage_lines(src.ad_click_lines(spark, sf_dir, first, last), f"{root}/input/{i}")
        if len(slices) > 1:  # a slice is one micro-batch
            share *= BATCHES
        start_ad_stream(read_text_stream(spark, f"{root}/input/*", share), tables, f"{root}/checkpoint",
                        threshold, available_now=True).awaitTermination()
    return tables


def run_unpaid_stream(spark: SparkSession, sf_dir: str, watermark: str) -> DataFrame:
    """``watermark``: at least the time span of the lines, as the files are in no order of time."""
    root = scratch(spark, "unpaid")
    share = stage_lines(src.course_lines(spark, sf_dir), f"{root}/input")
    table = unpaid_table(spark, f"{root}/unpayment_record")
    start_unpaid_stream(read_text_stream(spark, f"{root}/input", share), lambda: src.vip_users(spark, sf_dir), table,
                        f"{root}/checkpoint", watermark=watermark, available_now=True).awaitTermination()
    return table.read()


def run_visit_stream(spark: SparkSession, sf_dir: str, watermark: str, slices: tuple[tuple[str | None, str | None], ...],
                     merge_every: int = MERGE_EVERY) -> VisitTables:
    """The follow-ups with late visits kept; ``slices`` as in ``run_ad_stream``,
    in any order of time."""
    root = scratch(spark, "visits")
    tables = VisitTables.at(spark, f"{root}/tables", merge_every, DAY_BUCKETS)
    for i, (first, last) in enumerate(slices):
        share = BATCHES * stage_lines(src.course_lines(spark, sf_dir, first, last), f"{root}/input/{i}")
        start_visit_stream(read_text_stream(spark, f"{root}/input/*", share), lambda: src.vip_users(spark, sf_dir), tables,
                           f"{root}/checkpoint", watermark=watermark, available_now=True).awaitTermination()
    return tables


def run_vip_stream(spark: SparkSession, sf_dir: str, merge_every: int = MERGE_EVERY) -> DataFrame:
    root = scratch(spark, "vip")
    share = stage_lines(src.course_lines(spark, sf_dir), f"{root}/input")
    table = vip_table(spark, f"{root}/vip_increment_analysis", merge_every)
    start_vip_stream(read_text_stream(spark, f"{root}/input", share), src.ip_ranges(spark), table,
                     f"{root}/checkpoint", ranges_bound=len(src.IP_REGIONS), available_now=True).awaitTermination()
    return table.read()


def run_state_stream(spark: SparkSession, sf_dir: str, what: str, watermark: str) -> DataFrame:
    """The stream ``what`` (trend, stat or vip) with its counts in stream state;
    ``watermark`` as in ``run_unpaid_stream``."""
    root = scratch(spark, f"state-{what}")
    lines = src.course_lines(spark, sf_dir) if what == "vip" else src.ad_click_lines(spark, sf_dir)
    share = stage_lines(lines, f"{root}/input")
    stream, checkpoint = read_text_stream(spark, f"{root}/input", share), f"{root}/checkpoint"
    if what == "vip":
        table = vip_state_table(spark, f"{root}/vip")
        query = start_vip_state_stream(stream, src.ip_ranges(spark), table, checkpoint, watermark, len(src.IP_REGIONS), available_now=True)
    else:
        made, start = {"trend": (trend_state_table, start_trend_stream), "stat": (stat_state_table, start_stat_stream)}[what]
        table = made(spark, f"{root}/{what}")
        query = start(stream, src.initial_blacklist(spark, sf_dir), table, checkpoint, watermark, available_now=True)
    query.awaitTermination()
    return table.read()


def run_rejects_stream(spark: SparkSession, sf_dir: str, merge_every: int = 1) -> DataFrame:
    """The course lines' reject table, from lines of which some are spoiled."""
    root = scratch(spark, "rejects")
    share = stage_lines(src.spoiled_course_lines(spark, sf_dir).where("value IS NOT NULL"), f"{root}/input")
    table = reject_table(spark, f"{root}/course_rejects", merge_every)
    start_rejects_stream(read_text_stream(spark, f"{root}/input", share), table, f"{root}/checkpoint", available_now=True).awaitTermination()
    return table.read()
