import hashlib
import re

from pyspark.sql import functions as F

from visitlens.llm import simhash


def pairs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [(w[0], None)] if len(w) == 1 else list(zip(w, w[1:]))


def fingerprints(spark, texts):
    terms = sorted({p for t in texts for p in pairs(t)}, key=str)
    rows = spark.createDataFrame(terms, "a string, b string").select("a", "b", F.xxhash64("a", "b").alias("h")).collect() if terms else []
    h = {(r.a, r.b): r.h & (1 << 64) - 1 for r in rows}
    out = []
    for t in texts:
        votes = [0] * 64
        for p in pairs(t):
            for b in range(64):
                votes[b] += h[p] >> b & 1
        out.append(sum(1 << b for b in range(64) if 2 * votes[b] > len(pairs(t))))
    return out


def check(spark, docs):
    rows = sorted({(r.doc_id, r.text or "") for r in docs.collect()}, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t for _, t in rows]
    edited = [t[:len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][:len(t) // 4] for i, t in enumerate(texts)]
    fp, efp = fingerprints(spark, texts), fingerprints(spark, edited)
    like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
    want = {}
    for i, (doc, t) in enumerate(rows):
        near = sum(0 < bin(fp[i] ^ x).count("1") <= 3 for x in set(fp)) if doc is not None and doc % 50 == 0 else None
        want[doc] = (len(t), hashlib.sha256(edited[i].encode()).hexdigest(), f"{fp[i]:016x}", f"{efp[i]:016x}",
                     like(fp[i], efp[i]), like(fp[i], fp[(i + 1) % len(rows)]), near)
    got = simhash.fingerprint_report(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r


def test_whole_table(spark, small):
    check(spark, small)


def test_edges_and_empty(spark, edge_docs, no_docs):
    check(spark, edge_docs)
    assert simhash.fingerprint_report(no_docs).count() == 0


def test_rows_of_one_id_follow_each_other(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "e f g h"), (1, "e f g h"), (2, "")], "doc_id long, text string")
    got = simhash.fingerprint_report(docs)
    assert got.count() == 4 and got.where("doc_id = 1").select("fingerprint").distinct().count() == 2


def test_long_texts_are_added_up_in_pieces(spark, monkeypatch):
    docs = spark.createDataFrame([(1, " ".join(f"w{i % 91}" for i in range(900)))], "doc_id long, text string")
    whole = simhash.fingerprints(docs, ["doc_id"]).first().fp
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprints(docs, ["doc_id"]).first().fp == whole


def test_radius_search_finds_all(spark):
    base = 0x0123456789ABCDEF
    near = [base ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in ((0, 21, 43), (63, 62, 61), (5, 5, 9), (10, 11, 12))]
    far = [base ^ 0xF, base ^ (0xF << 40)]
    signed = [x - (1 << 64) if x >> 63 else x for x in [base, *near, *far]]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r.other for r in simhash.within_radius(frame.limit(1), frame).collect()}
    assert got == set(signed[1:5])
    assert len(simhash.block_masks()) == 20


def test_edited_texts_are_nearer_than_the_next(small):
    r = simhash.fingerprint_report(small).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert r[0] > r[1] + 0.2


def test_near_documents_are_counted_and_linked(spark):
    """Two texts of one fingerprint, copies behind another one, a distant one;
    two white spaces make another text of the same terms."""
    base = " ".join(f"w{i % 91}" for i in range(900))
    rows = [(0, base), (1, base), (2, base.replace(" ", "  ", 1)), (3, base + " x y"), (4, base + " x y"), (5, "quite another text here"), (50, "alone for itself")]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.fingerprint_report(docs).collect()}
    fp = {i: int(r.fingerprint, 16) for i, r in got.items()}
    text = dict(rows)
    near = {i: {j for j in fp if bin(fp[i] ^ fp[j]).count("1") <= 3} for i in (0, 50)}
    assert fp[0] == fp[2] and near[0] >= {0, 1, 2}
    assert [got[i].n_within for i in (0, 50)] == [len([j for j in near[i] if text[j] != text[i]]) for i in (0, 50)]
    links = simhash.near_links(docs).collect()
    for i in (0, 50):
        others = {r.other_fingerprint: r for r in links if r.fingerprint == got[i].fingerprint}
        assert {j for j in fp if got[j].fingerprint in others} == near[i]
        assert all(r.n_documents == sum(got[j].fingerprint == f for j in fp) and r.distance == bin(fp[i] ^ int(f, 16)).count("1") for f, r in others.items())
