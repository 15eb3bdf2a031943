"""Merge meanings and tables of micro-batches."""

import os
import uuid

import pytest
from pyspark.sql import types as T

from visitlens.session import checkpoint_dir
from visitlens.sinks.stored import BatchTable, KeyedTable
from visitlens.sinks.tables import append_new, merge_add, merge_overwrite, replace_groups


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merges(spark):
    old = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 1, 7)], "g string, k long, n long")
    delta = spark.createDataFrame([("a", 1, 2), ("c", 3, 4)], "g string, k long, n long")
    assert _rows(merge_add(old, delta, ["g", "k"], "n")) == [("a", 1, 7), ("a", 2, 1), ("b", 1, 7), ("c", 3, 4)]
    assert _rows(merge_overwrite(old, delta, ["g", "k"])) == [("a", 1, 2), ("a", 2, 1), ("b", 1, 7), ("c", 3, 4)]
    assert _rows(replace_groups(old, delta, ["g"])) == [("a", 1, 2), ("b", 1, 7), ("c", 3, 4)]
    dup = spark.createDataFrame([("a", 1, 9), ("d", 1, 1), ("d", 1, 2)], "g string, k long, n long")
    got = _rows(append_new(old, dup, ["g", "k"]))
    assert len(got) == 4 and ("a", 1, 5) in got  # existing key kept, new key once (Q17)


COUNTS = T.StructType([T.StructField("date", T.StringType()), T.StructField("k", T.LongType()), T.StructField("n", T.LongType())])


def _counts(spark, name="bt", **how):
    return BatchTable(spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}", COUNTS, ["date", "k"], "n", "date", **how)


def _delta(spark, *rows):
    return spark.createDataFrame(list(rows), COUNTS)


def test_batch_table_adds_and_replays(spark):
    t = _counts(spark)
    assert t.read().count() == 0
    t.append(spark.createDataFrame([("d1", 1, 5), ("d2", 1, 1)], COUNTS), "a", 0)
    t.append(spark.createDataFrame([("d2", 1, 2)], COUNTS), "a", 1)
    assert _rows(t.read()) == [("d1", 1, 5), ("d2", 1, 3)]
    assert _rows(t.read("a", 1)) == [("d1", 1, 5), ("d2", 1, 1)]
    t.append(spark.createDataFrame([("d2", 1, 4)], COUNTS), "a", 1)  # a replay replaces its batch alone
    assert _rows(t.read()) == [("d1", 1, 5), ("d2", 1, 5)]
    t.append(spark.createDataFrame([("d2", 1, 1)], COUNTS), "b", 0)  # a new checkpoint adds to what is there
    assert _rows(t.read()) == [("d1", 1, 5), ("d2", 1, 6)]
    copy = t.compacted(f"{t.path}-copy")
    assert _rows(copy.read()) == _rows(t.read()) and copy.rows().select("batch").distinct().count() == 1


def test_batch_writes_do_not_depend_on_the_table(spark):
    """The same batch over an empty table and over one with a large day writes the same bytes."""
    import os

    def size(t, batch):
        root = t.batch_path("a", batch).replace("file://", "")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)

    batch = spark.createDataFrame([("d1", i, 1) for i in range(20)], COUNTS).coalesce(1)
    empty, full = _counts(spark), _counts(spark)
    full.append(spark.range(200_000).selectExpr("'d1' as date", "id as k", "1L as n"), "a", 0)
    empty.append(batch, "a", 1)
    full.append(batch, "a", 1)
    assert size(empty, 1) == size(full, 1) < size(full, 0) / 10


def test_batch_table_as_a_set(spark):
    schema = T.StructType([T.StructField("x", T.LongType())])
    t = BatchTable(spark, f"{checkpoint_dir(spark)}/set-{uuid.uuid4().hex}", schema)
    t.append(spark.createDataFrame([(1,), (2,), (2,)], schema), "a", 0)
    t.append(spark.createDataFrame([(2,), (3,)], schema), "a", 1)
    assert _rows(t.read()) == [(1,), (2,), (3,)]


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
            for d, _, names in os.walk(path.removeprefix("file://")) for f in names if f.endswith(".parquet")}


def test_a_batch_replayed_after_a_merge_counts_once(spark):
    t = _counts(spark, merge_every=2)
    for n in range(5):
        t.merge_log("a", n)
        t.append(_delta(spark, ("d1", 1, 5)), "a", n)
    assert t.has("a", 1) and not t.has("a", 4)
    t.append(_delta(spark, ("d1", 1, 5)), "a", 1)  # held by the totals: passed over
    t.append(_delta(spark, ("d1", 1, 5)), "a", 4)  # in the log: replaced
    assert _rows(t.read()) == [("d1", 1, 25)]
    again = BatchTable(spark, t.path, COUNTS, ["date", "k"], "n", "date")  # as a new process sees it
    assert _rows(again.read()) == [("d1", 1, 25)] and again.has("a", 1)
    copy = t.compacted(f"{t.path}-copy")
    for n in range(5):
        copy.append(_delta(spark, ("d1", 1, 5)), "a", n)
    assert _rows(copy.read()) == [("d1", 1, 25)]
    copy.append(_delta(spark, ("d1", 1, 1)), "a", 5)
    assert _rows(copy.read()) == [("d1", 1, 26)]


def test_the_batch_under_way_is_not_merged(spark):
    """A batch that wrote, failed, and comes again with a merge before it."""
    t = _counts(spark, merge_every=1)
    t.append(_delta(spark, ("d1", 1, 1)), "a", 0)
    t.append(_delta(spark, ("d1", 1, 10)), "a", 1)
    assert t.merge_log("a", 1)
    assert _rows(t.read()) == [("d1", 1, 1)]
    t.append(_delta(spark, ("d1", 1, 10)), "a", 1)
    assert _rows(t.read()) == [("d1", 1, 11)] and _rows(t.read("a", 1)) == [("d1", 1, 1)]
    with pytest.raises(ValueError, match="already"):
        t.rows("a", 0)


def test_an_interrupted_merge_is_finished(spark, monkeypatch):
    t = _counts(spark, merge_every=1, buckets=1)
    t.append(_delta(spark, ("d1", 1, 1), ("d2", 1, 1)), "a", 0)
    t.merge_log("a", 1)
    t.append(_delta(spark, ("d1", 1, 1), ("d2", 1, 1)), "a", 1)
    add = t.held.add

    def half(delta, value, number=None, first=False):
        add(delta.where("date = 'd1'"), value, number, first)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(t.held, "add", half)
    with pytest.raises(RuntimeError, match="lost driver"):
        t.merge_log("a", 2)
    want = [("d1", 1, 2), ("d2", 1, 2)]
    assert _rows(t.read()) == want  # one partition holds the batch, the other does not
    again = BatchTable(spark, t.path, COUNTS, ["date", "k"], "n", "date", buckets=1, merge_every=1)
    assert _rows(again.read()) == want
    assert again.merge_log("a", 2) and _rows(again.read()) == want and again.state()["merging"] is None


def test_files_that_a_reader_lists_are_bounded(spark):
    t = _counts(spark, merge_every=3, buckets=2)
    seen = []
    for n in range(14):
        t.merge_log("a", n)
        t.append(_delta(spark, ("d1", n % 4, 1)).coalesce(1), "a", n)
        seen.append(len(set(t.rows().inputFiles())))
    assert max(seen) <= 2 + 4 + 1 and max(seen[7:]) <= max(seen[:7]) + 1
    assert sum(n for _, _, n in _rows(t.read())) == 14
    assert len(os.listdir(f"{t.path}/log".removeprefix("file://"))) <= 4  # dead generations are removed


def test_rows_read_for_some_keys_do_not_grow_with_the_batches(spark):
    """Totals, not the batches that made them, and only the keys' partitions."""
    t = _counts(spark, merge_every=1, buckets=8)
    few = _delta(spark, ("d1", 3, 1))
    read = []
    for n in range(6):
        t.merge_log("a", n)
        t.append(_delta(spark, *[("d1", k, 1) for k in range(64)]), "a", n)
        t.merge_log("a", n + 1, always=True)
        read.append(t.rows("a", n + 1, t.held.parts_of(few)).count())
    assert len(set(read)) == 1 and read[0] < 30


def test_two_runs_share_a_table(spark):
    t = _counts(spark, merge_every=1)
    t.append(_delta(spark, ("d1", 1, 1)), "a", 0)
    t.append(_delta(spark, ("d1", 1, 2)), "a", 1)
    t.merge_log("b", 0, always=True)
    t.append(_delta(spark, ("d1", 1, 4)), "b", 0)
    assert t.has("a", 1) and not t.has("b", 0)
    assert _rows(t.read()) == [("d1", 1, 7)] and _rows(t.read("b", 0)) == [("d1", 1, 3)]


def _keyed(spark, **how):
    return KeyedTable(spark, f"{checkpoint_dir(spark)}/kt-{uuid.uuid4().hex}", COUNTS, ["date", "k"], "date", **how)


def test_a_merge_rewrites_only_the_partitions_it_touches(spark):
    t = _keyed(spark, buckets=4)
    t.upsert(_delta(spark, *[(d, k, 1) for d in ("d1", "d2", "d3") for k in range(40)]))
    before = _files(t.path)
    t.upsert(_delta(spark, ("d2", 7, 9), ("d2", 99, 2), (None, 1, 1)))
    after = _files(t.path)
    gone = set(before) - set(after)
    assert gone and all("date=d2" in f for f in gone) and all(before[f] == after[f] for f in set(before) & set(after))
    assert len({os.path.dirname(f) for f in set(after) - set(before)}) <= 3
    want = {(d, k): 1 for d in ("d1", "d2", "d3") for k in range(40)} | {("d2", 7): 9, ("d2", 99): 2, (None, 1): 1}
    assert {(r["date"], r["k"]): r["n"] for r in t.read().collect()} == want
    scan = t.stored(t.parts_of(_delta(spark, ("d2", 7, 0))))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert scan.select("date", "bucket").distinct().count() == 1


def test_numbered_merges_count_once(spark):
    t = _keyed(spark)
    for number in (0, 0, 1, 1, 0):
        t.add(_delta(spark, ("d1", 1, 5), ("d1", 2, 1)), "n", number)
    assert _rows(t.read()) == [("d1", 1, 10), ("d1", 2, 2)]


def test_groups_and_new_rows(spark):
    t = _keyed(spark, bucket_by=["date"])
    t.upsert(_delta(spark, ("d1", 1, 1), ("d1", 2, 1), ("d2", 1, 1)))
    t.replace(_delta(spark, ("d1", 9, 9)), ["date"])
    assert _rows(t.read()) == [("d1", 9, 9), ("d2", 1, 1)]
    t.insert_new(_delta(spark, ("d1", 9, 1), ("d3", 1, 1)))
    assert _rows(t.read()) == [("d1", 9, 9), ("d2", 1, 1), ("d3", 1, 1)]
    with pytest.raises(ValueError, match="cut by"):
        _keyed(spark).replace(_delta(spark, ("d1", 9, 9)), ["date"])
    t.upsert(spark.createDataFrame([], COUNTS))  # nothing to do
    assert t.read().count() == 3
