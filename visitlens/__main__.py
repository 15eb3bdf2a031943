"""Command line: ``python -m visitlens <job> --data DIR --out DIR [options]``.

Batch jobs: ``session``, ``page``, ``page-rounded``, ``area``, ``study`` (needs
``--day``), ``clean`` (text output). Parameters use the reference's JSON
task keys (startDate, endDate, startAge, ...).

Streams: ``ads``, ``unpaid``, ``vip``. Lines come from text files that are
dropped into ``--lines`` or from Kafka (``--kafka`` servers, ``--topic``);
``--once`` works off what is there and ends.

``--data`` is a folder of the driver's tables; with ``--tables FORMAT`` it
holds tables in the reference's shapes (user_visit_action, user_info,
product_info, user_behavior, vip_user, ad_blacklist, ip_ranges; text files
course_log), as files of that format or, for ``table``, in that catalog schema.
"""

from __future__ import annotations

import argparse

from visitlens.params import TaskParams
from visitlens.plans import course, jobs
from visitlens.session import build_session
from visitlens.sinks.tables import write_day_table, write_text
from visitlens.sources import fixtures as src
from visitlens.sources.logs import read_kafka_stream, read_text_stream
from visitlens.sources.user_tables import UserTables
from visitlens.streaming.ads import AdTables, start_ad_stream
from visitlens.streaming.orders import (
    recent_days, reject_table, start_rejects_stream, start_unpaid_stream, start_vip_stream, unpaid_table, vip_table,
)
from visitlens.streaming.visits import VisitTables, start_visit_stream

STREAMS = ("ads", "unpaid", "vip")


def _stream(spark, a, data) -> None:
    if a.kafka:
        lines = read_kafka_stream(spark, a.kafka, a.topic, a.assign, a.starting_offsets)
    else:
        lines = read_text_stream(spark, a.lines, a.files_per_batch)
    out, checkpoint = a.out.rstrip("/"), f"{a.out.rstrip('/')}/checkpoint-{a.job}"
    often = {"available_now": a.once, "processing_time": a.every}
    if a.job == "ads":
        tables = AdTables.at(spark, out)
        if not tables.seeded():
            tables.seed_blacklist(src.initial_blacklist(spark, data))
        query = start_ad_stream(lines, tables, checkpoint, a.threshold, **often)
    elif a.job == "unpaid" and a.keep_late:
        query = start_visit_stream(lines, lambda: src.vip_users(spark, data), VisitTables.at(spark, out), checkpoint,
                                   a.window, a.slide, a.min_visits, watermark=a.watermark, **often)
    elif a.job == "unpaid":
        query = start_unpaid_stream(lines, lambda: src.vip_users(spark, data), unpaid_table(spark, f"{out}/unpayment_record"),
                                    checkpoint, a.window, a.slide, a.min_visits, watermark=a.watermark, **often)
    else:
        table = vip_table(spark, f"{out}/vip_increment_analysis")
        query = start_vip_stream(lines, src.ip_ranges(spark, data), table, checkpoint, src.ranges_bound(data), **often)
    if a.job != "ads":  # the ad stream writes its rejects itself
        rejects = start_rejects_stream(lines, reject_table(spark, f"{out}/course_rejects"), f"{checkpoint}-rejects", **often)
        rejects.awaitTermination() if a.once else None
    query.awaitTermination()
    if a.job == "vip" and a.as_of:
        recent_days(table.read(), a.as_of).write.mode("overwrite").parquet(f"{out}/vip_increment_recent")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="visitlens")
    ap.add_argument("job", choices=["session", "page", "page-rounded", "area", "study", "clean", *STREAMS])
    ap.add_argument("--data", required=True, help="folder (or catalog schema) with the input tables")
    ap.add_argument("--tables", default=None, metavar="FORMAT", help="parquet, orc, csv, ... or table: --data has the reference's shapes")
    ap.add_argument("--out", required=True)
    ap.add_argument("--params", default="{}", help="task parameters as JSON")
    ap.add_argument("--day", default=None, help="yyyy-MM-dd for the study job")
    ap.add_argument("--files", type=int, default=None, help="output files of the clean job")
    ap.add_argument("--master", default=None)
    s = ap.add_argument_group("streams")
    s.add_argument("--lines", help="folder of text files")
    s.add_argument("--files-per-batch", type=int, default=None)
    s.add_argument("--kafka", help="bootstrap servers")
    s.add_argument("--topic")
    s.add_argument("--assign", default=None, metavar="JSON", help='partitions instead of a topic: {"topic": [0, 1]}')
    s.add_argument("--starting-offsets", default="latest", help='earliest, latest or JSON: {"topic": {"0": 23}}; a checkpoint goes before')
    s.add_argument("--once", action="store_true")
    s.add_argument("--every", default="5 seconds", help="time between micro-batches")
    s.add_argument("--threshold", type=int, default=100, help="clicks of one ad on a day that list a user")
    s.add_argument("--window", default="4 days")
    s.add_argument("--slide", default="2 days")
    s.add_argument("--min-visits", type=int, default=2)
    s.add_argument("--watermark", default="4 days", help="how late an order-page visit may come")
    s.add_argument("--keep-late", action="store_true", help="write later visits to a table of their own")
    s.add_argument("--as-of", default=None, help="yyyy-MM-dd HH:mm:ss: also write the days that are recent by then")
    a = ap.parse_args(argv)
    if a.job in STREAMS and not (a.kafka and (a.topic or a.assign)) and not a.lines:
        ap.error("a stream needs --lines or --kafka and --topic or --assign")
    spark = build_session(a.master)
    data = UserTables(a.data, a.tables) if a.tables else a.data
    params = TaskParams.from_json(a.params)
    if a.job == "session":
        print(jobs.run_session_job(spark, data, a.out, params))
    elif a.job in ("page", "page-rounded"):
        print(jobs.run_page_job(spark, data, a.out, params, rounded=a.job == "page-rounded"))
    elif a.job == "area":
        print(jobs.run_area_job(spark, data, a.out, params))
    elif a.job == "study":
        write_day_table(course.daily_study(spark, data, a.day), f"{a.out}/app_course_study_analysis")
    elif a.job == "clean":
        write_text(course.clean_course_log(spark, data), f"{a.out}/cleaned", a.files)
    else:
        _stream(spark, a, data)
    spark.stop()


if __name__ == "__main__":
    main()
