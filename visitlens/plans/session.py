"""Session jobs B1-B7: profile, filter, length ratios, sample, category and
session top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import format_date, format_time, sorted_distinct_text, split_ids
from visitlens.functions.predicates import action_tests, all_of, user_filter
from visitlens.operators.joins import broadcast_bounded
from visitlens.operators.sample import stratified_sample
from visitlens.operators.session_fold import fold_sessions, length_ratios
from visitlens.operators.session_values import PART_VALUES, session_values
from visitlens.operators.topn import top_k, top_n_per_group
from visitlens.params import TaskParams
from visitlens.sources import fixtures as src

PROFILE_COLUMNS = ["session_id", "user_id", "start_time", "visit_length", "step_length",
                   "search_keywords", "click_category_ids", "age", "professional", "sex", "city"]
SAMPLE_COLUMNS = ["session_id", "start_time", "search_keywords", "click_category_ids"]
DETAIL_COLUMNS = ["user_id", "session_id", "page_id", "action_time", "search_keyword",
                  "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
                  "pay_category_ids", "pay_product_ids", "city_id"]
TOP_CATEGORY_COLUMNS = ["categoryid", "click_count", "order_count", "pay_count"]
TOP_SESSION_COLUMNS = ["categoryid", "session_id", "click_count"]


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """A session fold joined with the user's attributes (J1, inner: sessions
    without a user are dropped, Q23). Keeps the internal list and time
    columns for filters and later reports.

    The user side grows with the data, so the join is left to AQE:
    broadcast when measured small, otherwise sort-merge with skew splitting
    of hot user keys.
    """
    u = users.select("user_id", "age", "professional", "sex", "city")
    return (sessions.join(u, "user_id", "inner")
            .withColumn("start_time", format_time("start_ts"))
            .withColumn("search_keywords", sorted_distinct_text(F.col("search_keyword_list")))
            .withColumn("click_category_ids", sorted_distinct_text(F.col("click_category_list"))))


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return src.actions(spark, sf_dir, params.start_date, params.end_date)


def session_profile(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams()) -> DataFrame:
    """B1: one row per session in the date range."""
    return with_users(fold_sessions(_actions(spark, sf_dir, params)), src.users(spark, sf_dir)).select(*PROFILE_COLUMNS)


def session_lists(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(), part_values: int = PART_VALUES) -> DataFrame:
    """A1: the distinct keywords and categories of every session in the date
    range, in parts of bounded size, as text."""
    return (session_values(_actions(spark, sf_dir, params), part_values)
            .select("session_id", "kind", "part", "n_values", F.array_join("value_list", ",").alias("values_text")))


def passing(sessions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions, folded with ``action_tests(params)``, that pass every set
    parameter (P4)."""
    tests = action_tests(params)
    return with_users(sessions, users).where(all_of([user_filter(params), *map(F.col, tests)])).drop(*tests)


def filter_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """The sessions of ``actions`` that pass every set parameter. Keywords and
    categories are tested on the actions within the fold, so the lists are
    gathered only where a report shows them."""
    return passing(fold_sessions(actions, **action_tests(params)), users, params)


def filtered_frame(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return filter_sessions(_actions(spark, sf_dir, params), src.users(spark, sf_dir), params)


def filtered_sessions(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams()) -> DataFrame:
    """B2: sessions passing every set parameter predicate."""
    return filtered_frame(spark, sf_dir, params).select(*PROFILE_COLUMNS)


def length_report(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams()) -> DataFrame:
    """Visit- and step-length ratios of the filtered sessions."""
    return length_ratios(filtered_frame(spark, sf_dir, params))


def session_sample(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(),
                   total: int = 100, seed: str = "visitlens") -> DataFrame:
    """Stratified sample of filtered sessions by start day and hour."""
    f = (filtered_frame(spark, sf_dir, params)
         .withColumn("_day", format_date("start_ts"))
         .withColumn("_hour", F.hour("start_ts")))
    return stratified_sample(f, "_day", "_hour", "session_id", total, seed,
                             params.days_in_range()).select(*SAMPLE_COLUMNS)


def sample_detail(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(),
                  total: int = 100, seed: str = "visitlens") -> DataFrame:
    """Actions of the sampled sessions (the sample has at most ``total``
    rows, so it is broadcast)."""
    chosen = session_sample(spark, sf_dir, params, total, seed).select("session_id")
    acts = src.actions(spark, sf_dir, params.start_date, params.end_date)
    return (acts.join(broadcast_bounded(chosen, total), "session_id", "left_semi")
            .withColumn("action_time", format_time("action_time"))
            .select(*DETAIL_COLUMNS))


def session_category_counts(actions: DataFrame) -> DataFrame:
    """A4-A7 + J3 in one pass: every action is tagged with the categories it
    clicked, ordered or paid (lists exploded, F17), then one aggregation
    counts the three kinds per (session, category). A category with any action
    of any kind is a candidate (Q7)."""
    tag = lambda ids, kind: F.transform(ids, lambda x: F.struct(x.alias("cat"), F.lit(kind).alias("kind")))
    click = F.when(F.col("click_category_id") != -1, F.array(F.col("click_category_id")))
    tags = F.concat(
        F.coalesce(tag(click, "c"), F.array().cast("array<struct<cat:bigint,kind:string>>")),
        F.coalesce(tag(split_ids("order_category_ids"), "o"), F.array().cast("array<struct<cat:bigint,kind:string>>")),
        F.coalesce(tag(split_ids("pay_category_ids"), "p"), F.array().cast("array<struct<cat:bigint,kind:string>>")),
    )
    return (actions.select("session_id", F.explode(tags).alias("t"))
            .groupBy("session_id", F.col("t.cat").alias("categoryid"))
            .agg(F.count_if(F.col("t.kind") == "c").alias("click_count"),
                 F.count_if(F.col("t.kind") == "o").alias("order_count"),
                 F.count_if(F.col("t.kind") == "p").alias("pay_count")))


def kept_category_counts(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session, category) counts of the filtered sessions. The raw actions
    are counted where they lie; only counts meet the session list."""
    return session_category_counts(actions).join(sessions.select("session_id"), "session_id", "left_semi")


def _counts(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return kept_category_counts(_actions(spark, sf_dir, params), filtered_frame(spark, sf_dir, params))


def rank_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    """T1 over A4-A6: top ``k`` categories by click, then order, then pay
    count; ties by id (Q8, Q9). ``counts``: (session, category) counts."""
    kinds = ("click_count", "order_count", "pay_count")
    totals = counts.groupBy("categoryid").agg(*[F.sum(c).alias(c) for c in kinds])
    return top_k(totals, [*map(F.desc, kinds), F.asc("categoryid")], k).select(*TOP_CATEGORY_COLUMNS)


def rank_sessions(counts: DataFrame, top: DataFrame, k: int = 10, n: int = 10) -> DataFrame:
    """For each of the ``k`` top categories, the ``n`` sessions with most
    clicks on it (J4 semi join with the k-row list, A7, W5)."""
    cats = broadcast_bounded(top.select("categoryid"), k)
    clicks = counts.where(F.col("click_count") > 0).join(cats, "categoryid", "left_semi")
    return top_n_per_group(clicks, ["categoryid"], [F.desc("click_count"), F.asc("session_id")], n).select(*TOP_SESSION_COLUMNS)


def top_categories(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(), k: int = 10) -> DataFrame:
    """Top categories over the actions of the filtered sessions."""
    return rank_categories(_counts(spark, sf_dir, params), k)


def top_sessions(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(),
                 k: int = 10, n: int = 10) -> DataFrame:
    """Top sessions of each top category, both from the same counts."""
    counts = _counts(spark, sf_dir, params)
    return rank_sessions(counts, rank_categories(counts, k), k, n)
