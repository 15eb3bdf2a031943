"""Whole jobs as a user runs them: task parameters in, result tables out.

``session_job`` runs B3, B4, B5, B6, B7 over one filtered session profile.
The profile (one shuffle of the action log) is written once in the shared
checkpoint folder and every report reads it, instead of folding the actions
again per report; the length bins (B3) are counted while it is written. Results are appended with
the run id (K1).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import format_date, format_time
from visitlens.operators.joins import broadcast_bounded
from visitlens.operators.sample import stratified_sample
from visitlens.operators.session_fold import observed_lengths, observed_ratios
from visitlens.params import TaskParams
from visitlens.plans import page, product
from visitlens.plans.session import (DETAIL_COLUMNS, SAMPLE_COLUMNS, filter_sessions,
                                     kept_category_counts, rank_categories, rank_sessions)
from visitlens.session import checkpoint_dir, configure
from visitlens.sinks.tables import append_result
from visitlens.sources import fixtures as src


def session_reports(spark: SparkSession, sf_dir: str, params: TaskParams, sample_total: int = 100,
                    seed: str = "visitlens", k: int = 10, n: int = 10) -> dict[str, DataFrame]:
    """B3-B7 from one materialised profile of the filtered sessions."""
    configure(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/visitlens-jobs/profile-{uuid.uuid4().hex}"
    acts = src.actions(spark, sf_dir, params.start_date, params.end_date)
    filtered = (filter_sessions(acts, src.users(spark, sf_dir), params)
                .select("session_id", "start_ts", "start_time", "visit_length", "step_length",
                        "search_keywords", "click_category_ids"))
    observed, lengths = observed_lengths(filtered)
    observed.write.parquet(path)
    filtered = spark.read.schema(filtered.schema).parquet(path)
    ratios = observed_ratios(spark, lengths)
    sample = stratified_sample(filtered.withColumn("_day", format_date("start_ts"))
                               .withColumn("_hour", F.hour("start_ts")),
                               "_day", "_hour", "session_id", sample_total, seed,
                               params.days_in_range()).select(*SAMPLE_COLUMNS)
    detail = (acts.join(broadcast_bounded(sample.select("session_id"), sample_total), "session_id", "left_semi")
              .withColumn("action_time", format_time("action_time")).select(*DETAIL_COLUMNS))
    counts = kept_category_counts(acts, filtered)
    top = rank_categories(counts, k)
    top_sessions = rank_sessions(counts, top, k, n)
    return {"session_ratio": ratios, "session_extract": sample, "session_detail": detail,
            "top10_category": top, "top10_session": top_sessions}


def run_session_job(spark: SparkSession, sf_dir: str, out_dir: str, params: TaskParams,
                    run_id: str | None = None) -> str:
    """Session job: every report appended under ``out_dir/<table>`` with the
    run id. Returns the run id."""
    run_id = run_id or str(uuid.uuid4())
    for name, df in session_reports(spark, sf_dir, params).items():
        append_result(df, f"{out_dir.rstrip('/')}/{name}", run_id)
    return run_id


def run_page_job(spark: SparkSession, sf_dir: str, out_dir: str, params: TaskParams,
                 rounded: bool = False, run_id: str | None = None) -> str:
    """Page conversion job (B8, or B9 when ``rounded``): rows and text form."""
    configure(spark)
    run_id = run_id or str(uuid.uuid4())
    name = "page_split_convert_rate" + ("_rounded" if rounded else "")
    append_result(page.page_conversion(spark, sf_dir, params, rounded), f"{out_dir}/{name}", run_id)
    append_result(page.page_conversion_text(spark, sf_dir, params, rounded), f"{out_dir}/{name}_text", run_id)
    return run_id


def run_area_job(spark: SparkSession, sf_dir: str, out_dir: str, params: TaskParams,
                 run_id: str | None = None) -> str:
    """Area top-3 job."""
    configure(spark)
    run_id = run_id or str(uuid.uuid4())
    append_result(product.area_top3(spark, sf_dir, params), f"{out_dir}/area_top3_product", run_id)
    return run_id
