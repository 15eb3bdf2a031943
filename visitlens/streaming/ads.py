"""Ad-click stream (B13-B16): blacklist filter and upkeep, running counts by
day/province/city/ad, top-3 ads per province, per-minute trend.

One ``foreachBatch`` runs the steps in the reference's order (ST6, ST9):
the blacklist as of the previous batch removes clicks first, the batch's counts
are added, users over the threshold are listed for the next batch on, and the
top-3 lists of the (day, province) groups that got clicks are replaced. The
counts are ``BatchTable``s: a batch writes its own under its id and reads of the
running totals only the partitions of its keys; a batch replayed after a failure
leaves the same tables.

``start_trend_stream`` and ``start_stat_stream`` keep the same counts in stream
state instead (ST2, ST4) and overwrite the rows of changed keys.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from visitlens.functions.columns import format_date_key
from visitlens.operators.joins import keep_members
from visitlens.plans import ads
from visitlens.sinks.stored import BUCKETS, MERGE_EVERY, BatchTable, KeyedTable
from visitlens.sources.logs import ad_rejects, parse_ad_lines
from visitlens.streaming.batches import start_batches

S, L = T.StringType(), T.LongType()


def _schema(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


BLACKLIST_SCHEMA = _schema(("userid", L))
USER_CLICK_SCHEMA = _schema(("date", S), ("userid", L), ("adid", L), ("click_count", L))
AD_STAT_SCHEMA = _schema(("date", S), ("province", S), ("city", S), ("adid", L), ("click_count", L))
TOP_SCHEMA = _schema(("date", S), ("province", S), ("adid", L), ("click_count", L))
REJECT_SCHEMA = _schema(("value", S), ("batch_id", L), ("lines", L))
TREND_SCHEMA = _schema(("date", S), ("hour", S), ("minute", S), ("adid", L), ("click_count", L))



@dataclass
class AdTables:
    blacklist: BatchTable
    user_clicks: BatchTable
    ad_stat: BatchTable
    trend: BatchTable
    top3: KeyedTable
    reject_log: BatchTable

    @classmethod
    def at(cls, spark: SparkSession, root: str, merge_every: int = MERGE_EVERY, buckets: int = BUCKETS) -> "AdTables":
        root = root.rstrip("/")
        n, often = "click_count", {"merge_every": merge_every, "buckets": buckets}
        return cls(BatchTable(spark, f"{root}/ad_blacklist", BLACKLIST_SCHEMA, **often),
                   BatchTable(spark, f"{root}/ad_user_click_count", USER_CLICK_SCHEMA, ["date", "userid", "adid"], n, "date", ["userid"], **often),
                   BatchTable(spark, f"{root}/ad_stat", AD_STAT_SCHEMA, ["date", "province", "city", "adid"], n, "date", ["province"], **often),
                   BatchTable(spark, f"{root}/ad_click_trend", TREND_SCHEMA, ["date", "hour", "minute", "adid"], n, "date", **often),
                   KeyedTable(spark, f"{root}/ad_province_top3", TOP_SCHEMA, ["date", "province", "adid"], "date", ["province"], buckets),
                   BatchTable(spark, f"{root}/ad_rejects", REJECT_SCHEMA, ["value", "batch_id"], "lines", **often))

    def added(self) -> list[BatchTable]:
        return [self.blacklist, self.user_clicks, self.ad_stat, self.trend, self.reject_log]

    def province_top3(self) -> DataFrame:
        """The stored top ads of every (day, province)."""
        return self.top3.read()

    def recent_trend(self, minutes: int = 60) -> DataFrame:
        """Reader of ``ad_click_trend``: the last ``minutes`` minutes present, from
        the partitions of the last days alone."""
        rows = self.trend.rows()
        last = rows.agg(F.max("date")).first()[0]
        first = F.date_format(F.to_date(F.lit(last), "yyyyMMdd") - F.expr(f"INTERVAL {int(minutes) // 1440 + 1} DAYS"), "yyyyMMdd")
        return recent_trend(self.trend.merged(rows.where(F.col("date") >= first)), minutes)

    def rejects(self) -> DataFrame:
        """Malformed lines, the batch that delivered them and how often."""
        return self.reject_log.read()

    def seed_blacklist(self, users: DataFrame) -> None:
        """Initial ``ad_blacklist``."""
        self.blacklist.append(users.select("userid").distinct(), "seed", 0)

    def seeded(self) -> bool:
        """Whether the initial list is there."""
        return self.blacklist.has("seed", 0) or not self.blacklist.rows().where("run = 'seed'").isEmpty()


def _counts_and_blacklist(tables: AdTables, kept: DataFrame, listed: DataFrame, run: str, batch_id: int, threshold: int) -> None:
    """The batch's (day, user, ad) counts; then users whose total, earlier
    batches included, is over the threshold. Of the totals only the partitions
    of this batch's users and days are read."""
    delta = ads.user_click_counts(kept).persist()
    try:
        table = tables.user_clicks
        table.append(delta, run, batch_id)
        earlier = table.rows(run, batch_id, table.held.parts_of(delta)).select(*delta.columns)
        totals = table.merged(keep_members(earlier, delta.select(*table.keys), table.keys).unionByName(delta))
        tables.blacklist.append(ads.over_threshold_users(totals, listed, threshold), run, batch_id)
    finally:
        delta.unpersist()


def _stat_and_top3(tables: AdTables, kept: DataFrame, run: str, batch_id: int) -> None:
    """The batch's (day, province, city, ad) counts. B15: only the (day,
    province) groups in them are ranked anew, from the running totals of their
    partitions, and replaced (K5)."""
    delta = ads.ad_stat(kept).persist()
    try:
        table, group = tables.ad_stat, ["date", "province"]
        table.append(delta, run, batch_id)
        rows = table.rows(run, batch_id + 1, table.held.parts_of(delta))
        touched = keep_members(rows.select(*delta.columns), delta.select(*group).distinct(), group)
        tables.top3.replace(ads.province_top3(table.merged(touched)), group)
    finally:
        delta.unpersist()


def process_ad_batch(tables: AdTables, lines: DataFrame, batch_id: int, threshold: int = 100, run: str = "direct") -> None:
    """One micro-batch of B13-B16.

    First the tables whose log is long enough merge it. The blacklist as of the
    previous batch filters; then the three independent tables (B13, B14/B15, B16)
    are written by concurrent Spark jobs from driver threads. Each only reads
    earlier batches and writes its own rows, so the order in which they finish
    does not matter. A batch that the totals have is passed over.
    """
    if any(t.has(run, batch_id) for t in tables.added()):
        return
    with ThreadPoolExecutor(max_workers=len(tables.added())) as pool:
        list(pool.map(lambda table: table.merge_log(run, batch_id), tables.added()))
    lines = lines.persist()
    clicks = parse_ad_lines(lines)
    rejects = ad_rejects(lines).groupBy("value").agg(F.count(F.lit(1)).alias("lines")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    listed = tables.blacklist.read(run, batch_id)
    kept = ads.remove_blacklisted(clicks, listed).persist()
    try:
        if not rejects.isEmpty():  # P6 reject output; no empty folder per batch
            tables.reject_log.append(rejects, run, batch_id)
        if kept.isEmpty():  # no table changes
            return
        with ThreadPoolExecutor(max_workers=3) as pool:
            jobs = [pool.submit(_counts_and_blacklist, tables, kept, listed, run, batch_id, threshold),
                    pool.submit(_stat_and_top3, tables, kept, run, batch_id),
                    pool.submit(tables.trend.append, ads.click_trend(kept), run, batch_id)]
            for job in jobs:
                job.result()  # re-raises a failed one; the batch is then retried whole
    finally:
        kept.unpersist()
        lines.unpersist()


def start_ad_stream(lines: DataFrame, tables: AdTables, checkpoint: str, threshold: int = 100,
                    processing_time: str | None = "5 seconds", available_now: bool = False) -> StreamingQuery:
    """Start B13-B16 on a stream of text lines (Kafka or files)."""
    def batch(df: DataFrame, run: str, batch_id: int) -> None:
        process_ad_batch(tables, df, batch_id, threshold, run)

    return start_batches(lines, batch, checkpoint, available_now=available_now, processing_time=processing_time)


def trend_state_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, TREND_SCHEMA, ["date", "hour", "minute", "adid"], "date")


def stat_state_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, AD_STAT_SCHEMA, ["date", "province", "city", "adid"], "date", ["province"])


def start_trend_stream(lines: DataFrame, listed: DataFrame, table: KeyedTable, checkpoint: str, watermark: str,
                       available_now: bool = False, processing_time: str | None = "5 seconds") -> StreamingQuery:
    """ST2, B16 from stream state: clicks per minute and ad in event-time
    windows; each batch overwrites the rows of the minutes that changed (K4), so a
    replay changes nothing. State is dropped ``watermark`` after its minute: a
    click that is later than that is not counted (the query's progress has their
    number, ``numRowsDroppedByWatermark``). ``listed``: users to leave out."""
    clicks = ads.remove_blacklisted(parse_ad_lines(lines), listed).withWatermark("ts", watermark)
    counts = clicks.groupBy(F.window("ts", "1 minute").alias("w"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
    minute = F.col("w.start")
    rows = counts.select(F.date_format(minute, "yyyyMMdd").alias("date"), F.date_format(minute, "HH").alias("hour"),
                         F.date_format(minute, "mm").alias("minute"), "adid", "click_count")
    return start_batches(rows, lambda df, run, n: table.upsert(df), checkpoint, "update", available_now, processing_time)


def start_stat_stream(lines: DataFrame, listed: DataFrame, table: KeyedTable, checkpoint: str, watermark: str,
                      available_now: bool = False, processing_time: str | None = "5 seconds") -> StreamingQuery:
    """ST4, B14 from stream state: clicks per day, province, city and ad; as
    ``start_trend_stream`` with windows of a day (K3)."""
    clicks = ads.remove_blacklisted(parse_ad_lines(lines), listed).withWatermark("ts", watermark)
    counts = (clicks.groupBy(F.window("ts", "1 day").alias("w"), "province", "city", "adid")
              .agg(F.count(F.lit(1)).alias("click_count")))
    rows = counts.select(F.date_format("w.start", "yyyyMMdd").alias("date"), "province", "city", "adid", "click_count")
    return start_batches(rows, lambda df, run, n: table.upsert(df), checkpoint, "update", available_now, processing_time)


def recent_trend(trend: DataFrame, minutes: int = 60) -> DataFrame:
    """Reader of ``ad_click_trend``: the last ``minutes`` minutes present."""
    minute_ts = F.to_timestamp(F.concat("date", "hour", "minute"), "yyyyMMddHHmm")
    latest = trend.agg(F.max(minute_ts)).scalar()
    return trend.where(minute_ts > latest - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
