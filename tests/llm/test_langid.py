import zlib

import numpy as np
import pytest

from visitlens.llm import langid
from visitlens.llm.common import arrow_rows


@pytest.fixture(scope="module")
def model(small):
    arrow_rows(small.sparkSession)
    return langid.train(small)


def test_held_out_accuracy(small):
    got = langid.language_report(small).toPandas().set_index("doc_id")
    true = small.select("doc_id", "lang").toPandas().set_index("doc_id").lang
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
    held = got[got.held_out]
    assert (held.lang_pred == true.loc[held.index]).mean() >= 0.97
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.03


def test_labels_of_the_fold_are_never_used(small):
    from pyspark.sql import functions as F
    changed = small.withColumn("lang", F.when(langid.fold(F.col("doc_id")) == 0, F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, langid.language_report(d).select("doc_id", "lang_pred").collect())) for d in (small, changed))
    assert a == b


def test_probabilities_add_up(model):
    """Interpolated Kneser-Ney: over the alphabet, every context's mass is 1."""
    alphabet = [ord(c) for c in " abcdefghijklmnopqrstuvwxyzäöüßéèàçêñóíáúœôîûëï"]
    known = set(model.levels[0].grams.tolist())
    letters = [c for c in range(32, 0x250) if langid.gram_hashes(np.array([c], np.uint64), 1)[0] in known]
    assert set(alphabet[:27]) <= set(letters)
    for context in ("th", "qx", "e ", " d"):
        chars = np.array([[*map(ord, context), c] for c in letters], np.uint64).ravel()
        ends = np.arange(len(letters)) * 3 + 2
        mass = np.exp(model._log_probs(chars, 3, ends)).sum(axis=0)
        assert (mass > 0.95).all() and (mass < 1.001).all()


def test_noise_is_rejected_and_text_is_kept(spark, model):
    rng = np.random.default_rng(1)
    noise = ["".join(map(chr, rng.integers(97, 123, 600))) for _ in range(20)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    got = langid.identify(rows, model, ["doc_id"]).collect()
    assert np.mean([r.rejected for r in got]) > 0.9


def test_edges_and_empty(edge_docs, no_docs):
    got = langid.language_report(edge_docs)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == edge_docs.count()
    for i in (3, 4, 5, 11):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == ("und", 0.0, True)
    assert rows[None].lang_pred in ("en", "de", "fr") and not rows[None].held_out
    assert langid.language_report(no_docs).count() == 0
    assert {r.lang_pred for r in langid.language_report(edge_docs.where("doc_id in (3, 7)")).collect()} <= {"und", "de"}


def test_nothing_to_learn(spark):
    rows = spark.createDataFrame([(1, "some text", None, None, 1), (2, None, "en", None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert {(r.lang_pred, r.rejected) for r in langid.language_report(rows).collect()} == {("und", True)}


def test_limits_do_not_depend_on_the_partitions(spark, small):
    one, many = langid.train(small.coalesce(1)), langid.train(small.repartition(13))
    assert one.langs == many.langs and np.allclose(one.limits, many.limits, rtol=1e-6, atol=0)


def test_clean_documents_stay_and_foreign_ones_go(spark):
    """On a table large enough that every length class is calibrated."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.language_report(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    clean = [r for r in out if r.held_out and r.lang is not None and any(c.isalpha() for c in r.text or "")]
    assert sum(not r.rejected for r in clean) >= 0.98 * len(clean)
    foreign = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava",
               "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben",
               "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    assert all(r.rejected for r in langid.identify(df, langid.train(docs), ["doc_id"]).collect())
