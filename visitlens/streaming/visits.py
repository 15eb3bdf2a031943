"""B17 with its late visits kept: the follow-up stream as one ``foreachBatch``
that splits every batch into visits in time and late ones.

Spark's own watermark drops late rows inside the stateful operator, where no
query can see them (``orders.start_unpaid_stream``). Here the greatest event time
of the batches before is a stored row, so the split is made before the counts:
each visit is either counted in all its windows or stands in the late table, and
the two add up to all visits.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens.functions.columns import format_date
from visitlens.operators.joins import drop_members, keep_members
from visitlens.sinks.stored import BUCKETS, MERGE_EVERY, BatchTable, KeyedTable
from visitlens.sources.logs import parse_course_lines
from visitlens.streaming.batches import start_batches
from visitlens.streaming.orders import unpaid_table

COUNT_SCHEMA = "window_start long, uid long, phone string, visits long, dt string"
LATE_SCHEMA = "uid long, phone string, event_time long, visits long, dt string"
#: per run: the batch it last saw, and the greatest event time before and with it
MARK_SCHEMA = "run string, batch long, before long, seen long"


@dataclass
class VisitTables:
    counts: BatchTable  #: visits by window and user, partitioned by the window's first day
    late: BatchTable  #: late visits by second
    members: BatchTable  #: the follow-ups, a set
    marks: KeyedTable

    @classmethod
    def at(cls, spark: SparkSession, root: str, merge_every: int = MERGE_EVERY, buckets: int = BUCKETS) -> "VisitTables":
        root = root.rstrip("/")

        def added(name: str, schema: str, keys: list[str]) -> BatchTable:
            return BatchTable(spark, f"{root}/{name}", T.StructType.fromDDL(schema), keys, "visits", "dt", ["uid"], buckets, merge_every)

        return cls(added("visit_counts", COUNT_SCHEMA, ["dt", "window_start", "uid", "phone"]),
                   added("late_visits", LATE_SCHEMA, ["dt", "uid", "phone", "event_time"]),
                   unpaid_table(spark, f"{root}/unpayment_record", merge_every),
                   KeyedTable(spark, f"{root}/visit_marks", T.StructType.fromDDL(MARK_SCHEMA), ["run"], buckets=1))

    def added(self) -> list[BatchTable]:
        return [self.counts, self.late, self.members]

    def seen_before(self, run: str, batch: int, latest: int | None) -> int | None:
        """Greatest event time of the run's batches before this one, whose own is
        ``latest``; a replay gets the same answer."""
        row = self.marks.read().where(F.col("run") == run).first()
        if row is not None and row["batch"] == batch:
            return row["before"]
        before = None if row is None else row["seen"]
        seen = max((t for t in (before, latest) if t is not None), default=None)
        self.marks.upsert(self.marks.spark.createDataFrame([(run, batch, before, seen)], MARK_SCHEMA))
        return before


def process_visit_batch(tables: VisitTables, lines: DataFrame, vip: DataFrame, batch_id: int, window: str, slide: str,
                        min_visits: int, watermark: str, run: str = "direct") -> None:
    """One micro-batch. A visit is late if it is more than ``watermark`` before the
    greatest event time of earlier batches. The batch's counts are added; of the
    totals only the partitions of its own windows and users are read."""
    if any(t.has(run, batch_id) for t in tables.added()):
        return
    with ThreadPoolExecutor(max_workers=3) as pool:
        list(pool.map(lambda table: table.merge_log(run, batch_id), tables.added()))
    visits = (parse_course_lines(lines).where(F.col("event_key") == "enterOrderPage")
              .select("uid", "phone", "event_time", "ts").persist())
    try:
        before = tables.seen_before(run, batch_id, visits.agg(F.max("event_time")).first()[0])
        late = F.lit(False) if before is None else F.col("ts") < F.timestamp_seconds(F.lit(before)) - F.expr(f"INTERVAL {watermark}")
        if before is not None:  # no empty folder per table
            tables.late.append(visits.where(late).groupBy("uid", "phone", "event_time", format_date("ts").alias("dt"))
                               .agg(F.count(F.lit(1)).alias("visits")), run, batch_id)
        delta = (visits.where(~late).groupBy(F.window("ts", window, slide).alias("w"), "uid", "phone")
                 .agg(F.count(F.lit(1)).alias("visits"))
                 .select(F.unix_seconds("w.start").alias("window_start"), "uid", "phone", "visits",
                         format_date("w.start").alias("dt"))).persist()
        try:
            table = tables.counts
            table.append(delta, run, batch_id)
            earlier = table.rows(run, batch_id, table.held.parts_of(delta)).select(*delta.columns)
            totals = table.merged(keep_members(earlier, delta.select(*table.keys), table.keys).unionByName(delta))
            hits = totals.where(F.col("visits") > min_visits).select("uid", "phone").distinct()
            tables.members.append(drop_members(hits, vip.select("uid"), "uid"), run, batch_id)
        finally:
            delta.unpersist()
    finally:
        visits.unpersist()


def start_visit_stream(lines: DataFrame, vip: Callable[[], DataFrame], tables: VisitTables, checkpoint: str,
                       window: str = "4 days", slide: str = "2 days", min_visits: int = 2, *, watermark: str,
                       available_now: bool = False, processing_time: str | None = "10 seconds") -> StreamingQuery:
    """B17 on a stream of text lines; ``vip`` is read anew in every batch."""
    def batch(df: DataFrame, run: str, batch_id: int) -> None:
        process_visit_batch(tables, df, vip(), batch_id, window, slide, min_visits, watermark, run)

    return start_batches(lines, batch, checkpoint, available_now=available_now, processing_time=processing_time)
