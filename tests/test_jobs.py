"""Whole jobs: the checkpointed multi-report run equals the single reports."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from visitlens.operators.session_fold import length_ratios, observed_lengths, observed_ratios
from visitlens.params import TaskParams
from visitlens.plans import course, jobs, session
from visitlens.session import checkpoint_dir
from visitlens.sinks.tables import write_day_table, write_text

from conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_session_reports_equal_single_queries(spark):
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-03")
    rep = jobs.session_reports(spark, SF_SMALL, p)
    assert _rows(rep["session_ratio"]) == _rows(session.length_report(spark, SF_SMALL, p))
    assert _rows(rep["session_extract"]) == _rows(session.session_sample(spark, SF_SMALL, p))
    assert _rows(rep["session_detail"]) == _rows(session.sample_detail(spark, SF_SMALL, p))
    assert _rows(rep["top10_category"]) == _rows(session.top_categories(spark, SF_SMALL, p))
    assert _rows(rep["top10_session"]) == _rows(session.top_sessions(spark, SF_SMALL, p))


def test_lengths_observed_while_writing(spark):
    """Counts of the write's own pass equal those of a pass of their own, no session included."""
    rows = [(i % 2000, i % 70) for i in range(5000)]
    df = spark.createDataFrame(rows, "visit_length long, step_length long").repartition(7)
    for sessions in (df, df.where("visit_length < 0"), df.limit(0)):
        observed, counted = observed_lengths(sessions)
        observed.write.parquet(f"{checkpoint_dir(spark)}/observed-{uuid.uuid4().hex}")
        assert _rows(observed_ratios(spark, counted)) == _rows(length_ratios(sessions))


def test_run_session_job_appends_with_run_id(spark):
    out = f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    p = TaskParams.from_json(json.dumps({"startDate": "2024-01-01", "endDate": "2024-01-02",
                                         "startAge": 20, "endAge": 50, "professionals": ""}))
    rid = jobs.run_session_job(spark, SF_SMALL, out, p, run_id="r1")
    df = spark.read.parquet(f"{out}/top10_category")
    assert rid == "r1" and df.where("taskid = 'r1'").count() == df.count() > 0


def test_day_table_and_text_sinks(spark):
    out = f"{checkpoint_dir(spark)}/sink-{uuid.uuid4().hex}"
    write_day_table(course.daily_study(spark, SF_SMALL, "2024-01-05"), f"{out}/study")
    back = spark.read.option("sep", "\t").csv(f"{out}/study")
    assert back.count() == 1 and "dt" in back.columns
    write_text(course.clean_course_log(spark, SF_SMALL), f"{out}/clean", files=3)
    assert spark.read.text(f"{out}/clean").count() == course.clean_course_log(spark, SF_SMALL).count()


def test_params_from_reference_json():
    p = TaskParams.from_json('{"startDate": "2020-02-01", "endDate": "2020-02-29", "startAge": 20, '
                             '"endAge": "", "categoryIds": "1,2", "targetPageFlow": "1,2,3"}')
    assert p.end_age is None and p.list_of("category_ids") == ["1", "2"] and p.page_flow() == [1, 2, 3]


def test_scale_conf_sizes_partitions():
    from visitlens.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB
    assert int(scale_conf(2**30, 64)["spark.sql.shuffle.partitions"]) == 192  # three waves



def test_checkpoint_dir_comes_from_the_session(tmp_path):
    """A session started with spark.checkpoint.dir uses exactly that folder
    (own process: the setting is fixed when the context starts)."""
    import os
    import subprocess
    import sys
    shared = str(tmp_path / "shared")
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from visitlens.session import build_session, checkpoint_dir\n"
            "s = build_session('local[1]', extra={'spark.checkpoint.dir': %r})\n"
            "print('DIR=' + checkpoint_dir(s)); s.stop()\n") % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), shared)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert f"DIR={shared}" in out.stdout, out.stderr[-2000:]


def test_cli_page_job(spark, tmp_path):
    """``python -m visitlens page`` writes the rows and the text form."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = str(tmp_path / "out")
    params = json.dumps({"startDate": "2024-01-01", "endDate": "2024-01-30", "targetPageFlow": "1,2,3"})
    run = subprocess.run([sys.executable, "-m", "visitlens", "page", "--data", SF_SMALL, "--out", out,
                          "--params", params, "--master", "local[2]"],
                         cwd=repo, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    rows = spark.read.parquet(f"{out}/page_split_convert_rate").collect()
    assert sorted(r.step for r in rows) == [1, 2] and len({r.taskid for r in rows}) == 1
    text = spark.read.parquet(f"{out}/page_split_convert_rate_text").collect()[0].convert_rate
    assert text.startswith("1_2=") and "|2_3=" in text


@pytest.fixture(scope="module")
def own_tables(spark):
    """The derived tables, written in the reference's shapes."""
    from visitlens.sources import fixtures as src
    from visitlens.sources.user_tables import UserTables
    root = f"{checkpoint_dir(spark)}/own-{uuid.uuid4().hex}"
    text = {"action_time": F.date_format("action_time", "yyyy-MM-dd HH:mm:ss")}
    src.actions(spark, SF_SMALL).withColumns(text).write.parquet(f"{root}/user_visit_action")
    src.users(spark, SF_SMALL).write.parquet(f"{root}/user_info")
    src.products(spark, SF_SMALL).write.parquet(f"{root}/product_info")
    src.course_table(spark, SF_SMALL).write.partitionBy("dt").parquet(f"{root}/user_behavior")
    src.vip_users(spark, SF_SMALL).write.parquet(f"{root}/vip_user")
    src.initial_blacklist(spark, SF_SMALL).write.parquet(f"{root}/ad_blacklist")
    src.ip_ranges(spark).write.parquet(f"{root}/ip_ranges")
    src.course_lines(spark, SF_SMALL).write.text(f"{root}/course_log")
    src.ad_click_lines(spark, SF_SMALL).write.text(f"{root}/ad_log")
    return UserTables(root)


OWN = ["b1_session_profile", "b3_length_ratios", "b4_session_sample_all_days", "b5_sample_detail", "b6_top10_categories", "b7_top10_sessions",
       "b8_page_conversion", "b10_area_top3", "b11_daily_study_all_days", "b12_clean_course_log", "b13_ad_user_click_count", "b14_ad_stat",
       "b15_province_top3", "b16_click_trend", "b17_unpaid_followups", "b18_new_vips", "b18_new_vips_recent"]


@pytest.mark.parametrize("name", OWN)
def test_jobs_over_own_tables(spark, own_tables, name):
    from visitlens import registry
    run = registry.queries()[name]
    got, want = (sorted(map(str, run(spark, where).collect())) for where in (own_tables, SF_SMALL))
    assert got == want and want


def _cli(*args):
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-m", "visitlens", *args, "--master", "local[2]"], cwd=repo, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]


def test_cli_streams_over_own_tables(spark, own_tables, tmp_path):
    from visitlens import registry
    from visitlens.streaming.ads import AdTables
    from visitlens.streaming.orders import unpaid_table, vip_table
    data, out = ["--data", own_tables.folder, "--tables", "parquet"], f"file://{tmp_path}/out"
    log = f"{own_tables.folder}/course_log"
    _cli("ads", *data, "--lines", f"{own_tables.folder}/ad_log", "--out", out, "--once")
    _cli("unpaid", *data, "--lines", log, "--out", out, "--once", "--watermark", "60 days")
    _cli("vip", *data, "--lines", log, "--out", out, "--once", "--as-of", registry.VIP_AS_OF)
    tables = AdTables.at(spark, out)
    for name, got in [("b13_ad_user_click_count", tables.user_clicks.read()), ("b14_ad_stat", tables.ad_stat.read()),
                      ("b15_province_top3", tables.province_top3()), ("b16_click_trend", tables.trend.read()),
                      ("b17_unpaid_followups", unpaid_table(spark, f"{out}/unpayment_record").read()),
                      ("b18_new_vips", vip_table(spark, f"{out}/vip_increment_analysis").read()),
                      ("b18_new_vips_recent", spark.read.parquet(f"{out}/vip_increment_recent"))]:
        want = registry.queries()[name](spark, SF_SMALL)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), name


def test_cli_cleans_a_text_log(spark, own_tables, tmp_path):
    from visitlens import registry
    _cli("clean", "--data", own_tables.folder, "--tables", "parquet", "--out", f"file://{tmp_path}/out", "--files", "1")
    got = sorted(r.value for r in spark.read.text(f"file://{tmp_path}/out/cleaned").collect())
    assert got == sorted(r.line for r in registry.queries()["b12_clean_course_log"](spark, SF_SMALL).collect())
