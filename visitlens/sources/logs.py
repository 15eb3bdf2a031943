"""Log line parsing (P6, P7) and text / Kafka / file-stream readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.functions.columns import split_tabs

COURSE_FIELDS = 17
# Positions of the named fields of a course line.
F_UID, F_USERNAME, F_IP, F_PHONE = 0, 1, 8, 9
F_VIDEO_LENGTH, F_START_VIDEO, F_END_VIDEO = 11, 12, 13
F_EVENT_KEY, F_EVENT_TIME = 15, 16

TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line in column ``value``."""
    return spark.read.text(path)


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A directory of text files as a stream (tests and file drops)."""
    reader = spark.readStream.schema(TEXT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str | None = None,
                      assign_json: str | None = None, starting_offsets: str = "latest") -> DataFrame:
    """Kafka values as text. Needs the spark-sql-kafka package on the
    classpath (not present in this image). The stream position lives in the
    query checkpoint, so no offset table is kept."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("startingOffsets", starting_offsets))
    if assign_json:
        reader = reader.option("assign", assign_json)
    else:
        reader = reader.option("subscribe", topic)
    return reader.load().select(F.col("value").cast("string").alias("value"))


# Times in log lines count from 1970 up to the end of the year 9999.
MAX_SECOND = 253_402_300_799


def log_time(text: Column, per_second: int = 1) -> Column:
    """Timestamp of a number of seconds (or of 1 / ``per_second`` s) written as
    text; NULL unless it is a whole number between 1970 and 9999."""
    n = text.try_cast("bigint")
    n = F.when(n.between(0, MAX_SECOND * per_second + per_second - 1), n)
    return F.timestamp_millis(n) if per_second == 1000 else F.timestamp_seconds(n)


def _ad_columns() -> tuple[dict[str, Column], Column]:
    """The columns of an ad line, and whether the line is valid (never NULL)."""
    parts = F.split(F.col("value"), " ")
    cols = {"ts": log_time(F.get(parts, 0), 1000), "province": F.get(parts, 1), "city": F.get(parts, 2),
            "userid": F.get(parts, 3).try_cast("bigint"), "adid": F.get(parts, 4).try_cast("bigint")}
    ok = (F.size(parts) == 5) & cols["ts"].isNotNull() & cols["userid"].isNotNull() & cols["adid"].isNotNull()
    return cols, F.coalesce(ok, F.lit(False))


def parse_ad_lines(lines: DataFrame) -> DataFrame:
    """``timestamp_ms province city userid adid`` -> typed columns.

    Malformed lines are dropped; ``ad_rejects`` returns them.
    """
    cols, ok = _ad_columns()
    return lines.where(ok).select(*[c.alias(n) for n, c in cols.items()])


def ad_rejects(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_ad_lines`` drops, NULL lines included."""
    return lines.where(~_ad_columns()[1])


def _split_once(lines: DataFrame) -> DataFrame:
    """``value`` and its tab fields as the array ``fields``. The array comes out
    of a generator of one element, through which Catalyst does not push the tests
    on it: as a plain column the split would be repeated in every one of them."""
    return lines.select("value", F.explode(F.array(split_tabs("value"))).alias("fields"))


def _course_valid() -> Column:
    """17 tab fields. Trailing empty fields are not counted, as in a JVM
    ``split`` (Q30), so a line whose last field is empty fails."""
    f = F.col("fields")
    longer = F.size(F.split(F.rtrim(F.col("value"), F.lit("\t")), "\t", -1)) == COURSE_FIELDS
    return F.coalesce(F.when(F.size(f) == COURSE_FIELDS, F.get(f, COURSE_FIELDS - 1) != "").otherwise(longer), F.lit(False))


def course_fields(lines: DataFrame) -> DataFrame:
    """Keep lines with exactly 17 tab fields; adds ``fields`` (array)."""
    return _split_once(lines).where(_course_valid())


def _course_keyed() -> Column:
    """Whether a line's user id and event time are usable (never NULL)."""
    f = F.col("fields")
    ok = F.get(f, F_UID).try_cast("bigint").isNotNull() & log_time(F.get(f, F_EVENT_TIME)).isNotNull()
    return F.coalesce(ok, F.lit(False))


def parse_course_lines(lines: DataFrame) -> DataFrame:
    """Valid course lines -> uid, username, ip, phone, video columns,
    event_key, event_time (epoch s) and ``ts``. Lines without 17 fields, a
    whole user id or an event time in range are dropped; ``course_rejects``
    returns them."""
    f = F.col("fields")
    return course_fields(lines).where(_course_keyed()).select(
        F.get(f, F_UID).try_cast("bigint").alias("uid"),
        F.get(f, F_USERNAME).alias("username"),
        F.get(f, F_IP).alias("ip"),
        F.get(f, F_PHONE).alias("phone"),
        F.get(f, F_VIDEO_LENGTH).try_cast("bigint").alias("video_length"),
        F.get(f, F_START_VIDEO).try_cast("bigint").alias("start_video_time"),
        F.get(f, F_END_VIDEO).try_cast("bigint").alias("end_video_time"),
        F.get(f, F_EVENT_KEY).alias("event_key"),
        F.get(f, F_EVENT_TIME).try_cast("bigint").alias("event_time"),
        log_time(F.get(f, F_EVENT_TIME)).alias("ts"),
    )


def course_rejects(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_course_lines`` drops, NULL lines included."""
    return _split_once(lines).where(~(_course_valid() & _course_keyed())).select("value")
