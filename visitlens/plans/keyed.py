"""Session jobs over actions stored by session (K10): neither the session fold nor
the category counts shuffle an action. J1 and J2 still move what the fold leaves,
a row a session: to the user's key, and back to the session's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.predicates import action_tests
from visitlens.operators.session_fold import fold_sessions
from visitlens.params import TaskParams
from visitlens.plans.session import PROFILE_COLUMNS, passing, rank_categories, session_category_counts, with_users
from visitlens.sinks.bucketed import BUCKETS, BucketedTable
from visitlens.sources import fixtures as src


def store_actions(spark: SparkSession, sf_dir: str, name: str | None = None, buckets: int = BUCKETS) -> BucketedTable:
    """All actions, as managed tables bucketed by session."""
    name = name or f"visitlens_actions_{uuid.uuid4().hex}"
    return BucketedTable(spark, name, "session_id", buckets).save(src.actions(spark, sf_dir))


def _in_days(params: TaskParams) -> Column:
    return F.col("date").between(params.start_date, params.end_date)


def session_profile(stored: BucketedTable, users: DataFrame, params: TaskParams = TaskParams()) -> DataFrame:
    """B1 from stored actions."""
    sessions = stored.fold(lambda acts: fold_sessions(acts.where(_in_days(params))))
    return with_users(sessions, users).select(*PROFILE_COLUMNS)


def top_categories(stored: BucketedTable, users: DataFrame, params: TaskParams = TaskParams(), k: int = 10) -> DataFrame:
    """B6 from stored actions."""
    tests = action_tests(params)
    sessions = passing(stored.fold(lambda acts: fold_sessions(acts.where(_in_days(params)), **tests)), users, params)
    counts = stored.fold(lambda acts: session_category_counts(acts.where(_in_days(params))))
    return rank_categories(counts.join(sessions.select("session_id"), "session_id", "left_semi"), k)
