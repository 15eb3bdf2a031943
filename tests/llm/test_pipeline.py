
import corpus_pipeline

from visitlens.llm.common import stage

from .conftest import DOCS, SF
from .test_mixing import brute_targets, words
from .test_neardup import brute as near_brute
from .test_packing import check as check_packing
from .test_secrets import brute as secret_spans


def test_stages_by_brute_force(spark, small):
    """Each stage on what its predecessor kept."""
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "near_dedup", "secret_scan", "source_mix", "pack"]
    docs, names = small, small.columns
    known = stage(steps["language_id"](spark, docs, SF), "t")
    assert known.columns == names
    # clean documents stay: all that the labels name and that have letters, but for 3 %
    assert known.count() >= 0.97 * docs.count()
    single = stage(steps["near_dedup"](spark, known, SF), "t")
    want = near_brute([(r.doc_id, r.text) for r in known.collect()], 5)
    assert single.columns == names
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    clean = stage(steps["secret_scan"](spark, single, SF), "t")
    before = {r.doc_id: r.text for r in single.collect()}
    assert clean.columns == names and clean.count() == single.count()
    for r in clean.collect():
        text, at = [], 0
        for a, _, b in secret_spans(before[r.doc_id]):
            if a >= at:
                text += [before[r.doc_id][at:a], "[SECRET]"]
            at = max(at, b)
        assert r.text == "".join(text) + before[r.doc_id][at:]
    mixed = stage(steps["source_mix"](spark, clean, SF), "t")
    size, taken = {}, {}
    for r in clean.collect():
        size[r.source] = size.get(r.source, 0) + len(words(r.text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
    assert mixed.columns == names
    assert all(abs(taken[s] - t) <= 0.5 for s, t in brute_targets(size).items())
    packed = steps["pack"](spark, mixed, SF)
    assert packed.agg({"length": "sum"}).first()[0] == sum(
        r.length for r in check_packing(mixed)[0].itertuples())


def test_edge_rows_go_through(spark, edge_docs, no_docs):
    docs = edge_docs
    for name, apply in corpus_pipeline.STAGES[:-1]:
        got = stage(apply(spark, docs, SF), "t")
        assert got.columns == docs.columns, name
        docs = got
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    empty = no_docs
    for name, apply in corpus_pipeline.STAGES:
        empty = apply(spark, empty, SF)
        assert empty.count() == 0, name


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:2] == ["doc_id", "start"] and got.count() > 0


def test_near_dedup_loses_no_unique_text(spark):
    """Rows, not ids, are compared: a copy's id may have a text of its own."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "a", 1), (5, text, "en", "a", 1), (5, "a text of its own that is nowhere else", "en", "b", 2)]
    docs = spark.createDataFrame(rows, DOCS)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    assert sorted(tuple(r) for r in got.collect()) == sorted([rows[0], rows[2]])
