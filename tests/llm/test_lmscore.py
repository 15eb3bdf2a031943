import collections
import math

import pytest

from visitlens.llm import lmscore


def brute(texts):
    docs = [(t or "").encode().lower().split() for t in texts]
    one = collections.Counter(w for ws in docs for w in ws)
    two = collections.Counter(p for ws in docs for p in zip(ws, ws[1:]))
    n = sum(one.values())
    out = []
    for ws in docs:
        own, pairs, rest = collections.Counter(ws), collections.Counter(zip(ws, ws[1:])), n - len(ws)
        total, backed = 0.0, 0
        for i, w in enumerate(ws):
            c = one[w] - own[w]
            s = c / rest if c else 0.4 / (rest + 1)
            if i:
                p = (ws[i - 1], w)
                if two[p] > pairs[p]:
                    s = (two[p] - pairs[p]) / (one[p[0]] - own[p[0]])
                else:
                    s, backed = 0.4 * s, backed + 1
            total += math.log(s)
        out.append((len(ws), total, backed))
    return out


def check(docs, **sizes):
    rows = docs.select("doc_id", "text").collect()
    got = lmscore.score(docs, **sizes).collect()
    want = sorted(zip((-1 if r.doc_id is None else r.doc_id for r in rows), brute([r.text for r in rows])))
    have = sorted(((-1 if r.doc_id is None else r.doc_id), (r.n_words, r.log_score, r.backed_off), r.mean_log) for r in got)
    assert len(have) == len(want)
    for (i, (n, s, b)), (j, (m, t, c), mean) in zip(want, have):
        assert (i, n, b) == (j, m, c) and t == pytest.approx(s, rel=1e-9, abs=1e-9)
        assert mean is None if n == 0 else mean == pytest.approx(s / n)


def test_whole_table(small):
    check(small, chunk_words=5000, bucket_grams=20000)


def test_production_sizes(small):
    check(small)


def test_edges_and_empty(edge_docs, no_docs):
    check(edge_docs, chunk_words=10, bucket_grams=50)
    assert lmscore.score(no_docs).count() == 0


def test_one_document_and_no_words(spark):
    check(spark.createDataFrame([(1, "alone and alone")], "doc_id long, text string"))
    check(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), chunk_words=1)
