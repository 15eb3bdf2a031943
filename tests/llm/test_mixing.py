import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitlens.llm import mixing


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(size):
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    total, stopped = sum(size.values()), set()
    while True:
        free = total - sum(3 * size[n] for n in stopped)
        heavy = sum(weight[n] for n in names if n not in stopped)
        target = {n: 3 * size[n] if n in stopped else free * weight[n] / heavy for n in names}
        over = {n for n in names if n not in stopped and target[n] > 3 * size[n]}
        if not over:
            return target
        stopped |= over


def check(docs):
    got = mixing.taken(docs).toPandas()
    want = docs.select("doc_id", "source", "text").collect()
    size = {}
    for r in want:
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
    target = brute_targets(size)
    key = lambda x: (-1 if x is None or x != x else int(x))
    assert sorted((key(r.doc_id), r.size) for r in got.itertuples()) == sorted((key(r.doc_id), len(words(r.text))) for r in want)
    by_size = {}
    for r in got.itertuples():
        by_size.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
        assert 0 <= r.taken <= 3 * r.size
    assert set(by_size) == {(n, round(float(target[s]), 6)) for s, n in size.items()}
    assert sum(got.taken) == pytest.approx(sum(target.values()), abs=len(size))
    return got


def test_whole_table(small):
    got = check(small)
    for _, rows in got.groupby(["source_size", "target"]):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) <= 0.5


def test_caps_are_shared_again(spark):
    rows = [(1, "s", "a " * 10), (2, "t", "b " * 1000), (3, "u", "c " * 5), (4, None, "d " * 50), (5, "é", "e"), (6, "z", None)]
    check(spark.createDataFrame(rows, "doc_id long, source string, text string"))


def test_edges_and_empty(edge_docs, no_docs):
    check(edge_docs)
    assert mixing.taken(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_reruns_agree(small):
    a, b = (sorted(map(tuple, mixing.taken(small.repartition(n)).collect())) for n in (2, 5))
    assert a == b


def test_tree_keeps_quotas_and_halves_evenly(spark):
    quotas = [1000, 3, 0, 77, 12345]
    frame = spark.createDataFrame(list(enumerate(quotas)), "source_no int, blocks long")
    got = np.array([r.quotas for r in mixing.splitting_tree(frame, 16).orderBy("shard").collect()])
    assert got.shape == (16, 5) and (got >= 0).all() and got.sum(axis=0).tolist() == quotas
    sizes = got.sum(axis=1)
    assert sizes.max() - sizes.min() <= 1


@pytest.mark.parametrize("marked,others,drawn", [(30, 50, 40), (5, 3, 4), (4000, 9000, 6500)])
def test_hypergeometric_draws(spark, marked, others, drawn):
    x = mixing.hypergeometric(F.lit(marked).cast("long"), F.lit(others).cast("long"), F.lit(drawn).cast("long"), F.col("id"))
    r = spark.range(4000).select(x.alias("x")).agg(F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")).first()
    n = marked + others
    mean, var = drawn * marked / n, drawn * marked / n * others / n * (n - drawn) / (n - 1)
    assert abs(r[0] - mean) < 5 * (var / 4000) ** 0.5 and abs(r[1] / var - 1) < 0.12
    assert r[2] >= max(0, drawn - others) and r[3] <= min(marked, drawn)


def test_blocks_are_disjoint(small):
    blocks = mixing.mix_blocks(mixing.mix_sizes(small)).toPandas()
    assert not blocks.duplicated(["source", "block"]).any()
    sizes = blocks.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1


def test_mixed_documents(small):
    got = mixing.mixed_documents(small)
    assert got.columns == small.columns
    size = {r[0]: r[1] for r in mixing.taken(small).groupBy("doc_id").agg(F.sum("taken")).collect()}
    text = {r.doc_id: r.text for r in small.collect()}
    have = {}
    for r in got.collect():
        assert text[r.doc_id].startswith(r.text)
        have[r.doc_id] = have.get(r.doc_id, 0) + len(words(r.text))
    assert have == {k: v for k, v in size.items() if v}


def draws(spark, marked, others, drawn, n=4000):
    df = spark.range(n).select(mixing.hypergeometric(*(F.lit(x).cast("long") for x in (marked, others, drawn)), F.col("id")).alias("k"))
    return np.array([r.k for r in df.collect()])


@pytest.mark.parametrize("marked,others,drawn", [(30, 50, 20), (500, 700, 300), (4_000, 1_000, 3_000), (70, 100_000, 60_000),
                                                 (3_000_000, 5_000_000, 4_000_000), (10**9, 10**9, 10**9)])
def test_draws_have_the_distribution(spark, marked, others, drawn):
    """Mean, variance and all quantiles, by inversion and by rejection."""
    got = draws(spark, marked, others, drawn)
    total = marked + others
    mean = drawn * marked / total
    var = mean * others / total * (total - drawn) / (total - 1)
    assert got.min() >= max(0, drawn - others) and got.max() <= min(marked, drawn)
    assert abs(got.mean() - mean) < 4.5 * (var / len(got)) ** 0.5
    assert abs(got.var() / var - 1) < 0.12
    # the largest gap between the distribution functions, Kolmogorov's bound at 1e-4
    lo, hi = int(max(0, mean - 8 * var**0.5)), int(min(marked, mean + 8 * var**0.5)) + 1
    k = np.unique(np.linspace(lo, hi, 400_000).astype(np.int64)) if hi - lo > 400_000 else np.arange(lo, hi + 1)
    ln = np.vectorize(lambda n: math.lgamma(n + 1))
    ok = (k <= marked) & (k <= drawn) & (drawn - k <= others) & (k >= 0)
    k = k[ok]
    w = -(ln(k) + ln(marked - k) + ln(drawn - k) + ln(others - drawn + k))
    cdf = np.cumsum(np.exp(w - w.max()))
    cdf /= cdf[-1]
    seen = np.searchsorted(np.sort(got), k, "right") / len(got)
    assert np.abs(seen - cdf).max() < 2.23 / len(got) ** 0.5


def test_joint_moments_of_the_tree(spark):
    """Sources' blocks in a shard covary as in a random deal."""
    quotas = spark.createDataFrame([(0, 3000), (1, 1500), (2, 500)], "source_no int, blocks long").coalesce(1)
    rows = []
    for seed in range(5):
        tree = mixing.splitting_tree(quotas, 64, seed).collect()
        table = np.array([r.quotas for r in sorted(tree)])
        assert table.sum(axis=0).tolist() == [3000, 1500, 500] and set(table.sum(axis=1)) <= {78, 79}
        rows.append(table)
    x = np.array(rows).reshape(-1, 3)
    p = np.array([0.6, 0.3, 0.1])
    want = 78.125 * (5000 - 78.125) / 4999 * (np.diag(p) - np.outer(p, p))
    assert np.abs(x.mean(axis=0) - 78.125 * p).max() < 1e-9
    assert (np.abs(np.cov(x.T) - want) < 0.35 * np.abs(want) + 1).all()


def test_many_sources_are_split_in_little_time(spark):
    quotas = spark.range(2000).select(F.col("id").cast("int").alias("source_no"), F.lit(100).cast("long").alias("blocks"))
    t = time.perf_counter()
    tree = mixing.splitting_tree(quotas).collect()
    took = time.perf_counter() - t
    table = np.array([r.quotas for r in tree])
    assert (table.sum(axis=0) == 100).all() and (table.sum(axis=1) == 3125).all()
    assert took < 60, took


def test_nodes_from_the_third_level_on_are_tasks(spark):
    quotas = spark.createDataFrame([(0, 3000), (1, 1500)], "source_no int, blocks long")
    parts = mixing.splitting_tree(quotas, 64).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == 8
