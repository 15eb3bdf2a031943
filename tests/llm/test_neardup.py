import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import neardup
from visitlens.llm.common import row_slices


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def alike(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 80 * (len(a) + len(b) - both)


def brute(rows, k=4):
    """{doc_id: (size, component)} by comparing every pair."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if find(i) != find(j) and 0.8 * max(len(a), len(b)) <= min(len(a), len(b)) and alike(a, b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (len(s), find(i)) for i, s in sets}


def check(docs, k=4):
    got = neardup.near_duplicates(docs, shingle=k).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    want = brute([r for r in rows if r[0] is not None], k)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
            assert r.kept == (r.doc_id == r.component_id)


def test_whole_table(small):
    check(small)


def chain(n, step, words=200, seed=3):
    """Copies of copies: each next one changes ``step`` words more."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [list(text)]
    for _ in range(n - 1):
        text = list(text)
        for _ in range(step):
            text[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        out.append(text)
    return [" ".join(t) for t in out]


def star(n, most, words=150, seed=5):
    """Copies of one text with 0 to ``most`` changed words: likeness on both sides of the limit."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(most)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("texts", [chain(60, 3), chain(40, 6), star(250, 12)], ids=["chain", "steep chain", "star"])
def test_links_between_copies(spark, texts):
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    check(spark.createDataFrame([(i, texts[k]) for i, k in enumerate(order)], "doc_id long, text string"))


@pytest.mark.parametrize("k", [5, 9])
def test_longer_shingles(spark, k):
    words = "a b c d e f g h i j k l".split()
    short = [" ".join(words[:n]) for n in range(len(words) + 1)]
    texts = short + [t.upper() for t in short] + star(80, 12, seed=k)
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), k)


def test_one_changed_word_among_43(spark):
    """40 shingles of four words, four of them changed: 36 of 44; of five words 34 of 44."""
    base = [f"w{i}" for i in range(43)]
    near = [*base[:20], "other", *base[21:]]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near))], "doc_id long, text string")
    assert [r.kept for r in neardup.near_duplicates(docs).orderBy("doc_id").collect()] == [True, False]
    assert [r.kept for r in neardup.near_duplicates(docs, shingle=5).orderBy("doc_id").collect()] == [True, True]


def test_short_texts(spark):
    texts = ["a b c", "A  b\nc", "a b", "a b c d", "a b c d e", "a b c d e f g h i j", "a b c d e f g h i j k", "b", "B", "", None, " \n"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_edges(edge_docs, no_docs, spark):
    got = neardup.near_duplicates(edge_docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == edge_docs.count()
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(10, 1, True)] and by[2] == [(10, 1, False)] * 2
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)] and by[None][0][2]
    assert neardup.near_duplicates(no_docs).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 40)), max_size=30), st.integers(1, 60))
def test_row_slices_keep_rows_and_bound(sizes, limit):
    texts = [None if n is None else "x" * n for n in sizes]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])
    parts = list(row_slices([b, b], "text", limit=limit))
    assert [r for p in parts for r in p.to_pylist()] == 2 * b.to_pylist()
    for p in parts:
        # a slice holds no more than the limit but for its last row that reaches over it
        held = [len(t or "") for t in p.column("text").to_pylist()]
        assert p.num_rows == 1 or sum(held) - held[0] < limit


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300))
def test_signature_holds_members_of_the_set(hashes):
    h = np.array(sorted(hashes), dtype=np.uint64)
    sig = neardup.signature(h)
    assert len(sig) == neardup.BINS and set(sig.tolist()) <= hashes


def test_signature_estimates_likeness():
    rng = np.random.default_rng(0)
    got = []
    for _ in range(60):
        pool = np.unique(rng.integers(0, 2**63, 1100).astype(np.uint64))
        got.append((neardup.signature(pool[:-100]) == neardup.signature(pool[100:])).mean())
    assert abs(np.mean(got) - 900 / 1100) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (300, 301)]
    got = dict(neardup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 200: 100, 150: 100, 300: 300, 301: 300}


T = "one two three four five six seven eight nine ten eleven twelve"
U = "a text of another kind that nothing else in here is like at all"
NEAR = T + " thirteen"


def kept_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text) for r in neardup.one_of_each(docs).collect()), key=str)


def test_rows_that_share_an_id_are_told_apart(spark):
    """A copy goes, the other text of its id stays; of equal rows one stays."""
    for rows, left in [([(1, T), (5, T), (5, U)], [(1, T), (5, U)]),
                       ([(5, T), (5, T), (5, U), (7, U)], [(5, T), (5, U)]),
                       ([(3, T), (None, NEAR), (None, NEAR), (None, U), (None, U)], [(3, T), (None, U)]),
                       ([(1, T), (2, NEAR), (3, U), (4, ""), (4, ""), (4, None)], [(1, T), (3, U), (4, ""), (4, ""), (4, None)])]:
        assert kept_rows(spark, rows) == sorted(left, key=str)


def test_rows_without_an_id_are_compared(spark):
    docs = spark.createDataFrame([(8, T), (None, NEAR), (None, U), (9, U), (9, T), (None, "q w e r t y")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(8, 8, True), (None, 8, False), (None, 9, False), (9, 9, True), (9, 8, False), (None, None, True)], key=str)
