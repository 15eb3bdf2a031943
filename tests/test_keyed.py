"""Distinct lists in parts, sessions filtered without lists, tables bucketed by key."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from visitlens.functions.predicates import action_tests, session_filter
from visitlens.operators.session_fold import fold_sessions
from visitlens.operators.session_values import session_values
from visitlens.params import TaskParams
from visitlens.plans import keyed, session
from visitlens.sinks.bucketed import BucketedTable
from visitlens.sources import fixtures as src

ACTIONS = "session_id string, user_id long, action_time timestamp, search_keyword string, click_category_id long"
T = dt.datetime(2024, 1, 1)


def some_actions(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "hot", "hot", *"abcdefgh"]), rng.randrange(5), T + dt.timedelta(seconds=rng.randrange(9999)),
             rng.choice([None, f"kw{rng.randrange(400)}"]), rng.choice([None, -1, rng.randrange(40)])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, ACTIONS).repartition(5)


@pytest.mark.parametrize("bound", [1, 7, 50, 10**6])
def test_session_values_parts_make_up_the_list(spark, bound):
    rows, df = some_actions(spark)
    want = {}
    for s, _, _, kw, cat in rows:
        if kw is not None:
            want.setdefault((s, "keyword"), set()).add(kw)
        if cat not in (None, -1):
            want.setdefault((s, "category"), set()).add(str(cat))
    got, parts = {}, {}
    for r in session_values(df, bound).collect():
        assert r.n_values == len(r.value_list) and r.value_list == sorted(r.value_list)
        got.setdefault((r.session_id, r.kind), []).extend(r.value_list)
        parts[r.session_id, r.kind] = parts.get((r.session_id, r.kind), 0) + 1
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}  # each value in one part
    assert all((parts[k] == 1) if len(v) <= bound else parts[k] > 1 or len(v) == 1 for k, v in want.items() if len(v) != bound + 1)
    assert session_values(df.where("false"), bound).count() == 0


def test_parts_of_a_long_session_are_short(spark):
    """200,000 distinct keywords in one session: no part is gathered far beyond the bound."""
    df = (spark.range(200_000).select(F.lit("hot").alias("session_id"), F.concat(F.lit("kw"), "id").alias("search_keyword"),
                                      F.lit(-1).cast("long").alias("click_category_id")))
    r = session_values(df, 1000).agg(F.max("n_values").alias("most"), F.sum("n_values").alias("all")).first()
    assert r["all"] == 200_000 and r["most"] <= 1000


@pytest.mark.parametrize("params", [
    TaskParams(keywords="kw1,kw3"), TaskParams(category_ids="1,2,3"), TaskParams(category_ids="-1"), TaskParams(),
    TaskParams(start_age=20, end_age=40, keywords="kw2", category_ids="4,-1", sex="male")])
def test_action_tests_equal_the_lists(spark, params):
    _, df = some_actions(spark, 300, 7)
    users = spark.createDataFrame([(i, 18 + 7 * i, "p", "male" if i % 2 else "female", f"city{i}") for i in range(5)],
                                  "user_id long, age int, professional string, sex string, city string")
    got = session.filter_sessions(df, users, params)
    want = session.with_users(fold_sessions(df), users).where(session_filter(params))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_filter_gathers_no_lists(spark):
    params = TaskParams(keywords="kw1", category_ids="3")
    assert len(action_tests(params)) == 2
    plan = session.length_report(spark, SF_SMALL, params)._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan


def name():
    return f"t_{uuid.uuid4().hex}"


def test_bucketed_fold_has_no_exchange(spark):
    stored = keyed.store_actions(spark, SF_SMALL, name(), 4)
    for by_key in (fold_sessions, session.session_category_counts):
        plan = by_key(spark.table(stored.name))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    rows = src.actions(spark, SF_SMALL)
    assert sorted(map(str, stored.read().select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_hot_and_null_keys_are_not_bucketed(spark):
    rows, df = some_actions(spark)
    stored = BucketedTable(spark, name(), "session_id", 8).save(df)
    hot = {r.session_id for r in spark.table(stored.hot_name).select("session_id").distinct().collect()}
    often = {s: sum(r[0] == s for r in rows) for s in {r[0] for r in rows}}
    assert hot == {s for s, n in often.items() if s is None or n > len(rows) / 8} and "hot" in hot
    assert stored.read().count() == len(rows)
    assert sorted(map(str, stored.fold(fold_sessions).collect())) == sorted(map(str, fold_sessions(df).collect()))


def test_bucketed_table_is_replaced_and_may_be_empty(spark):
    _, df = some_actions(spark, 200)
    stored = BucketedTable(spark, name(), "session_id", 4).save(df)
    stored.save(df.where("session_id = 'a'"))
    assert stored.read().count() == df.where("session_id = 'a'").count()
    stored.save(df.where("false"))
    assert stored.read().count() == 0 and stored.fold(fold_sessions).count() == 0
