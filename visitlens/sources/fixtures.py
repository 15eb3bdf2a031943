"""Reference input shapes derived from the driver tables (FIXTURES.md §3).

Every function is lazy: it returns a DataFrame over the parquet scan, so
Catalyst prunes unused columns and pushes the date range into the scan.
The same derivations are written in SQL in ``visitlens.oracle`` so Spark
and the DuckDB oracle see identical rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.columns import format_date_key
from visitlens.sources.user_tables import UserTables, or_user_table

# --- fixed values -----------------------------------------------------------
# City dimension of the area report: (city_id, city_name, area). Fixed values
# that must equal the reference's inline table.
CITY_ROWS = [
    (0, "北京", "华北"), (1, "上海", "华东"), (2, "南京", "华东"),
    (3, "广州", "华南"), (4, "三亚", "华南"), (5, "武汉", "华中"),
    (6, "长沙", "华中"), (7, "西安", "西北"), (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]
# Region names of the six /16 IP ranges 10.0.x.x ... 10.5.x.x (our IP table,
# a stand-in for the IP library file), and the label for an unknown address.
IP_REGIONS = ["北京", "上海", "广东", "浙江", "江苏", "四川"]
UNKNOWN_REGION = "未知"
# Course event names by driver event type.
COURSE_EVENT = {"view": "startVideo", "click": "endVideo",
                "signup": "enterOrderPage", "purchase": "completeOrder"}
VIDEO_LENGTH = 300
# ---------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_bounds(start_date: str | None, end_date: str | None):
    """Inclusive day range -> half-open timestamp bounds as NTZ literals."""
    lo = hi = None
    if start_date:
        lo = F.lit(f"{start_date} 00:00:00").cast("timestamp_ntz")
    if end_date:
        nxt = _dt.date.fromisoformat(end_date) + _dt.timedelta(days=1)
        hi = F.lit(f"{nxt.isoformat()} 00:00:00").cast("timestamp_ntz")
    return lo, hi


def events(spark: SparkSession, sf_dir: str, start_date: str | None = None,
           end_date: str | None = None) -> DataFrame:
    """Driver events, restricted to whole days (S1: the predicate reaches the
    parquet scan as PushedFilters on ``ts``)."""
    ev = table(spark, sf_dir, "events")
    lo, hi = _day_bounds(start_date, end_date)
    if lo is not None:
        ev = ev.where(F.col("ts") >= lo)
    if hi is not None:
        ev = ev.where(F.col("ts") < hi)
    return ev


@or_user_table
def actions(spark: SparkSession, sf_dir: str, start_date: str | None = None,
            end_date: str | None = None) -> DataFrame:
    """``user_visit_action`` rows (plus ``action_id`` for tie-breaking)."""
    ev = events(spark, sf_dir, start_date, end_date)
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    day = F.to_date("ts")
    sod = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    day_start = F.unix_timestamp(day.cast("timestamp"))
    action_time = F.timestamp_seconds(day_start + (uid % 24) * 3600 + F.floor(sod / 30))
    return ev.select(
        eid.alias("action_id"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        uid.alias("user_id"),
        F.concat_ws("_", uid.cast("string"), format_date_key(F.col("ts"))).alias("session_id"),
        (eid % 10).alias("page_id"),
        action_time.alias("action_time"),
        F.when(etype == "view", F.concat(F.lit("kw"), (eid % 10).cast("string"))).alias("search_keyword"),
        F.when(etype == "click", eid % 20).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(etype == "click", (eid * 7) % 100).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(etype == "signup", F.concat_ws(",", (eid % 20).cast("string"),
                                              ((eid + 3) % 20).cast("string"))).alias("order_category_ids"),
        F.when(etype == "signup", F.concat_ws(",", ((eid * 7) % 100).cast("string"),
                                              (((eid + 3) * 7) % 100).cast("string"))).alias("order_product_ids"),
        F.when(etype == "purchase", ((eid + 5) % 20).cast("string")).alias("pay_category_ids"),
        F.when(etype == "purchase", (((eid + 5) * 7) % 100).cast("string")).alias("pay_product_ids"),
        (uid % 10).alias("city_id"),
    )


@or_user_table
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info`` from customer."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(18) + key % 43).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


@or_user_table
def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_info`` from part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"),
                 F.lit("}")).alias("extend_info"),
    )


def ranges_bound(sf_dir) -> int | None:
    """Rows of the IP table, if they are known."""
    return None if isinstance(sf_dir, UserTables) else len(IP_REGIONS)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table built on the JVM side (no Python worker, no RDD);
    its row count is known when the plan is built."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))


def city_dim(spark: SparkSession) -> DataFrame:
    """The 10-row city dimension (a literal, so its size is fixed)."""
    schema = T.StructType([
        T.StructField("city_id", T.LongType(), False),
        T.StructField("city_name", T.StringType(), False),
        T.StructField("area", T.StringType(), False),
    ])
    return literal_table(spark, CITY_ROWS, schema)


@or_user_table
def ip_ranges(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """IP range table (start_num, end_num, region): six /16 ranges."""
    rows = [((10 << 24) + (i << 16), (10 << 24) + (i << 16) + 65535, name)
            for i, name in enumerate(IP_REGIONS)]
    schema = T.StructType([
        T.StructField("start_num", T.LongType(), False),
        T.StructField("end_num", T.LongType(), False),
        T.StructField("region", T.StringType(), False),
    ])
    return literal_table(spark, rows, schema)


@or_user_table
def vip_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vip_user(id, uid)``: customers with key divisible by 5."""
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 5 == 0)
    return c.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("uid"))


@or_user_table
def initial_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ad_blacklist(userid)`` before any stream batch."""
    c = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 50 == 7)
    return c.select(F.col("c_custkey").alias("userid"))


@or_user_table
def ad_click_lines(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                   end_date: str | None = None) -> DataFrame:
    """Ad click log lines ``timestamp_ms province city userid adid`` (column
    ``value``), one per click event, as a Kafka or file source delivers them."""
    ev = events(spark, sf_dir, start_date, end_date).where(F.col("event_type") == "click")
    uid = F.col("user_id")
    line = F.concat_ws(
        " ",
        F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
        F.concat(F.lit("P"), (uid % 10).cast("string")),
        F.concat(F.lit("C"), (uid % 30).cast("string")),
        uid.cast("string"),
        (F.col("event_id") % 5).cast("string"),
    )
    return ev.select(line.alias("value"))


def _course_columns(ev: DataFrame) -> DataFrame:
    """Typed course behaviour columns from driver events (all event types)."""
    uid, eid, etype = F.col("user_id"), F.col("event_id"), F.col("event_type")
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    event_key = F.coalesce(*[F.when(etype == src, F.lit(dst)) for src, dst in COURSE_EVENT.items()],
                           etype)
    return ev.select(
        uid.alias("uid"),
        eid.alias("event_id"),
        etype.alias("event_type"),
        event_key.alias("event_key"),
        F.concat(F.lit("10."), (uid % 8).cast("string"), F.lit("."),
                 (eid % 4).cast("string"), F.lit(".1")).alias("ip"),
        F.concat(F.lit("199000"), F.lpad(uid.cast("string"), 5, "0")).alias("phone"),
        F.lit(VIDEO_LENGTH).cast("bigint").alias("video_length"),
        epoch.alias("start_video_time"),
        F.when(etype == "click", epoch + 6 * k).otherwise(F.lit(0)).cast("bigint").alias("end_video_time"),
        epoch.alias("event_time"),
    )


@or_user_table
def course_table(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """``dwd.user_behavior``: uid, event_key, start/end video time,
    video_length, dt (int yyyyMMdd). ``day`` (yyyy-MM-dd) prunes the scan."""
    ev = events(spark, sf_dir, day, day).where(F.col("event_type") != "error")
    cols = _course_columns(ev)
    return cols.select(
        "uid", "event_key", "start_video_time", "end_video_time", "video_length",
        F.date_format(F.timestamp_seconds("event_time"), "yyyyMMdd").cast("int").alias("dt"),
    )


@or_user_table
def course_lines(spark: SparkSession, sf_dir: str, start_date: str | None = None,
                 end_date: str | None = None) -> DataFrame:
    """Raw 17-field tab lines of the course log (column ``value``).

    Error events become a 16-field line that the validity check must reject.
    """
    c = _course_columns(events(spark, sf_dir, start_date, end_date))
    return c.select(_course_line(c).alias("value"))


def _course_line(c: DataFrame):
    """The tab line of ``_course_columns``' rows; 16 fields for error events."""
    uid = F.col("uid")
    fields = [
        uid.cast("string"),                                        # 0 uid
        F.concat(F.lit("user"), uid.cast("string")),               # 1 username
        F.when(uid % 2 == 0, "F").otherwise("M"),                   # 2 gender
        F.lit("1"), F.lit("0"),                                    # 3, 4
        F.lit("ios"), F.lit("auto"), F.lit("wifi"),                # 5 os, 6 channel, 7 network
        F.col("ip"),                                               # 8 ip
        F.col("phone"),                                            # 9 phone
        (F.col("event_id") % 2).cast("string"),                    # 10 video id
        F.col("video_length").cast("string"),                      # 11
        F.col("start_video_time").cast("string"),                  # 12
        F.col("end_video_time").cast("string"),                    # 13
        F.lit("1.0"),                                              # 14 version
    ]
    full = F.concat_ws("\t", *fields, F.col("event_key"), F.col("event_time").cast("string"))
    short = F.concat_ws("\t", *fields, F.col("event_key"))
    return F.when(F.col("event_type") == "error", short).otherwise(full)


# The n-th kind of damage goes to lines of event ids with event_id % 11 == n.

def _spoiled(ev: DataFrame, line, damage: list) -> DataFrame:
    kind = F.col("event_id") % 11
    value = line
    for n, broken in enumerate(damage):
        value = F.when(kind == n, broken).otherwise(value)
    return ev.select(value.alias("value"))


def spoiled_ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad lines of all click events, some of them spoiled: a time beyond every
    timestamp, a negative time, no number, one field less or more, an empty
    line, no line at all, an id that is no number."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "click")
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    uid = F.col("user_id")
    rest = [F.concat(F.lit("P"), (uid % 10).cast("string")), F.concat(F.lit("C"), (uid % 30).cast("string")), uid.cast("string")]
    ad = (F.col("event_id") % 5).cast("string")

    def line(*fields):
        return F.concat_ws(" ", *fields)

    return _spoiled(ev, line(ms, *rest, ad), [
        line(F.lit("9223372036854775807"), *rest, ad), line(F.lit("-1"), *rest, ad), line(F.lit("now"), *rest, ad),
        line(ms, *rest), line(ms, *rest, ad, ad), F.lit(""), F.lit(None).cast("string"), line(ms, *rest, F.lit("ad7"))])


def spoiled_course_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course lines of all events, some of them spoiled in their time, user or
    number of fields; error events have 16 fields anyway."""
    c = _course_columns(events(spark, sf_dir))
    c = c.select("event_id", _course_line(c).alias("line"))
    line = F.col("line")

    def last(text):
        return F.regexp_replace(line, "[^\t]+$", text)

    return _spoiled(c, line, [last("9223372036854775807"), last("-5"), last("soon"), last(""), F.concat(line, F.lit("\tmore")),
                              F.lit(""), F.lit(None).cast("string"), F.regexp_replace(line, "^[^\t]+", "nobody")])
