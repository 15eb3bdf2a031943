"""A1 session fold and A2/A3 bucketed counters with ratios."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import seconds_between

# Fixed bin edges (inclusive, in seconds / steps); None = no upper bound.
VISIT_BINS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30),
              ("30s_60s", 31, 60), ("1m_3m", 61, 180), ("3m_10m", 181, 600),
              ("10m_30m", 601, 1800), ("30m", 1801, None)]
STEP_BINS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30),
             ("30_60", 31, 60), ("60", 61, None)]


def fold_sessions(actions: DataFrame, **tests: F.Column) -> DataFrame:
    """One row per session: user, first/last action time, visit length in
    whole seconds, step count, distinct keywords and click categories
    (sorted arrays; exact distinct, Q1/Q2 fixed), and for each of ``tests``, a
    predicate over actions, whether any action passes it.

    A single hash aggregation: partial aggregates are built before the
    shuffle, so a session with very many actions ships one partial row per
    map task. A report that asks for the two lists gathers a session's distinct
    values in one row; lists that no report uses are pruned, and
    ``session_values`` gives them in parts of bounded size.
    """
    cat = F.when(F.col("click_category_id") != -1, F.col("click_category_id"))
    return (actions.groupBy("session_id")
            .agg(F.min("user_id").alias("user_id"),          # Q23: deterministic
                 F.min("action_time").alias("start_ts"),
                 F.max("action_time").alias("end_ts"),
                 F.count(F.lit(1)).alias("step_length"),
                 F.array_sort(F.collect_set("search_keyword")).alias("search_keyword_list"),
                 F.array_sort(F.collect_set(cat)).alias("click_category_list"),
                 *[F.coalesce(F.bool_or(test), F.lit(False)).alias(name) for name, test in tests.items()])
            .withColumn("visit_length", seconds_between("start_ts", "end_ts")))


def _in_bin(col: str, lo: int, hi: int | None):
    c = F.col(col)
    return (c >= lo) if hi is None else c.between(lo, hi)


def _bin_counts() -> list[F.Column]:
    return [F.count(F.lit(1)).alias("session_count"),
            *[F.count_if(_in_bin("visit_length", lo, hi)).alias(f"_v_{name}") for name, lo, hi in VISIT_BINS],
            *[F.count_if(_in_bin("step_length", lo, hi)).alias(f"_s_{name}") for name, lo, hi in STEP_BINS]]


def _shares(counts: DataFrame) -> DataFrame:
    total = F.col("session_count")
    cols = [total]
    for name, _, _ in VISIT_BINS:
        cols.append(F.round(F.try_divide(F.col(f"_v_{name}"), total), 2).alias(f"visit_length_{name}_ratio"))
    for name, _, _ in STEP_BINS:
        cols.append(F.round(F.try_divide(F.col(f"_s_{name}"), total), 2).alias(f"step_length_{name}_ratio"))
    return counts.select(*cols)


def length_ratios(sessions: DataFrame) -> DataFrame:
    """A2 + A3: one row with ``session_count`` and each bin's share, HALF_UP
    to two places. No session -> count 0 and NULL ratios (Q5 fixed). A visit
    of 0 s is in no bin (Q4)."""
    return _shares(sessions.agg(*_bin_counts()))


def observed_lengths(sessions: DataFrame) -> tuple[DataFrame, Observation]:
    """``sessions`` with the bins of ``length_ratios`` counted as a by-product
    of the pass that writes them. Observe rows on their way into one write: their
    tasks count once, also when run again, which tasks of earlier stages do not."""
    counted = Observation(f"lengths-{uuid.uuid4().hex}")
    return sessions.observe(counted, *_bin_counts()), counted


def observed_ratios(spark: SparkSession, counted: Observation) -> DataFrame:
    """A3 from the counts of ``observed_lengths``, once its write is done."""
    got = counted.get
    names = ["session_count", *[f"_v_{n}" for n, _, _ in VISIT_BINS], *[f"_s_{n}" for n, _, _ in STEP_BINS]]
    # a table found empty while planning leaves no counts
    return _shares(spark.range(1).select(*[F.lit(got.get(n, 0)).cast("bigint").alias(n) for n in names]))


RATIO_COLUMNS = (["session_count"] + [f"visit_length_{n}_ratio" for n, _, _ in VISIT_BINS]
                 + [f"step_length_{n}_ratio" for n, _, _ in STEP_BINS])
