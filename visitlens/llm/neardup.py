"""Near-duplicates (operator 5): one-permutation MinHash with optimal
densification, banded buckets, star-shaped candidate edges.

Documents with equal shingle sets collapse to one class first. Each class gets
one hash permutation cut into ``BINS`` bins; an empty bin borrows from the bin
that its own hash sequence points to. Bands of bins are buckets; in a bucket
only the edges to one centre, the member with the most company, become
candidates, so pairs grow with members and not with their square. Edges are
confirmed on full sets, and confirmed edges are joined to components.

A star alone would miss a link between two members that are both unlike the
centre. Buckets of three or more that still hold several components are
therefore contested: their members are compared exactly by prefix filtering
(rarest shingles first, with length and position bounds), which finds every
pair of at least ``THRESHOLD`` percent, and components are joined again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, chunks, mix64, row_slices, stage, texts_as_bytes

SHINGLE = 4
THRESHOLD = 80  # percent of the union
BINS = 200
ROWS = 5
SEED = 1
#: words hashed before a worker's cache starts anew
CACHE_WORDS = 400_000
#: words handled together in one numpy pass
PASS_WORDS = 200_000
_U = np.uint64


# --- shingles and signatures -------------------------------------------------------

class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()
_MULT = np.array([0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                  0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
# more for shingles of five words and longer
_MULT = np.concatenate((_MULT, mix64(np.arange(1, 25, dtype=np.uint64)) | _U(1)))


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``k``-word shingles. Words
    are runs without white space, A-Z in lower case; fewer than ``k`` words are
    one shingle, none give an empty set."""
    out: list[np.ndarray] = []
    for part in chunks(([*t.lower().split()] for t in texts), len, PASS_WORDS):
        n = np.array([len(ws) for ws in part])
        flat = np.fromiter((_words[w] for ws in part for w in ws), dtype=np.uint64, count=int(n.sum()))
        starts = np.concatenate(([0], np.cumsum(n)))
        h = np.zeros(max(0, len(flat) - k + 1), dtype=np.uint64)
        for i in range(k):
            h += flat[i:i + len(h)] * _MULT[i]
        h = mix64(h)
        for a, m in zip(starts, n):
            if m >= k:
                out.append(np.unique(h[a:a + m - k + 1]))
            elif m:
                short = np.array([_U(int(m))], dtype=np.uint64)
                for i in range(m):
                    short += flat[a + i:a + i + 1] * _MULT[k + i]
                out.append(mix64(short))
            else:
                out.append(np.empty(0, dtype=np.uint64))
    return out


def _borrow_order(bins: int, tries: int = 64) -> np.ndarray:
    """For every bin, the bins it turns to, in order, when it is empty."""
    seeds = np.arange(bins * tries, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(SEED)
    return (mix64(seeds) % _U(bins)).astype(np.int64).reshape(bins, tries)


_ORDER = _borrow_order(BINS)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of a non-empty sorted set: the least hash in each
    of ``BINS`` equal ranges; an empty bin takes the value of the first bin
    with one along its own sequence (optimal densification)."""
    bins = ((hashes >> _U(32)) * _U(BINS)) >> _U(32)
    first = np.flatnonzero(np.diff(bins, prepend=_U(BINS)))
    filled = bins[first].astype(np.int64)
    sig = np.zeros(BINS, dtype=np.uint64)
    has = np.zeros(BINS, dtype=bool)
    sig[filled], has[filled] = hashes[first], True
    if len(filled) < BINS:
        empty = np.flatnonzero(~has)
        found = has[_ORDER[empty]]
        at = found.argmax(axis=1)
        source = _ORDER[empty, at]
        # a sequence that meets no filled bin goes on to the next filled one
        lost = ~found[np.arange(len(empty)), at]
        if lost.any():
            source[lost] = filled[np.searchsorted(filled, source[lost]) % len(filled)]
        sig[empty] = sig[source]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """64-bit bucket keys, one a band of ``ROWS`` bins."""
    rows = sig.reshape(-1, ROWS)
    h = np.arange(len(rows), dtype=np.uint64) + _U(1)
    for i in range(ROWS):
        h = mix64(h * _U(0x100000001B3) + rows[:, i])
    return h.view(np.int64)


def _describe(shingle: int):
    def run(batches):
        for b in row_slices(batches, "text"):
            n, key, keys = [], [], []
            for s in shingle_sets(texts_as_bytes(b), shingle):
                n.append(len(s))
                key.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                keys.append(bands(signature(s)) if len(s) else None)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([0 if k is None else len(k) for k in keys]))), pa.int32()),
                pa.array(np.concatenate([k for k in keys if k is not None] or [np.empty(0, np.int64)]), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), lists],
                                             names=["doc_id", "n_shingles", "set_key", "bands"])
    return run


def _sets(shingle: int):
    def run(batches):
        for b in row_slices(batches, "text"):
            sets = shingle_sets(texts_as_bytes(b), shingle)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["id", "n", "hashes"])
    return run


def _confirm(percent: int):
    def run(batches):
        for b in row_slices(batches, "h1", "h2"):
            keep = []
            for x, y in zip(b.column("h1").to_pylist(), b.column("h2").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])
    return run


# --- graph ------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id that ``edges`` (a, b) reach, for every id
    on an edge. Labels spread along edges and jump to their label's label, each
    round written out, until none changes; no link passes the driver."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        spread = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        after = stage(spread.join(jump, "next").select("id", F.col("component").alias("old"), F.least("next", "far").alias("component")), "labels")
        labels = after.select("id", "component")
        if not after.where("old <> component").limit(1).count():
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) whose sets are alike enough."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("hashes").alias("h1"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("hashes").alias("h2"))
    sizes = F.lit(100) * F.least("n1", "n2") >= F.lit(percent) * F.greatest("n1", "n2")
    # sizes first, on narrow rows; then the sets of pairs that can pass
    fit = pairs.join(one.drop("h1"), "a").join(two.drop("h2"), "b").where(sizes).select("a", "b")
    return fit.join(one, "a").join(two, "b").select("a", "b", "h1", "h2").mapInArrow(_confirm(percent), "a long, b long")


def _contested_pairs(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``sets`` (id, n, hashes) in different components that share a
    shingle within their prefixes, at places that still allow ``percent``.

    Shingles are ordered by how many of these sets hold them, rarest first. Two
    sets of sizes n >= m that are alike share a shingle within the first
    n - ceil(t n) + 1 of the one and the same of the other; the first one they
    share and what is left behind its places bound their overlap.
    """
    def rows(batches):
        for b in batches:
            for i, n, raw in zip(b.column("id").to_pylist(), b.column("n").to_pylist(), b.column("hashes").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array([n] * n, pa.int64()),
                                                  pa.array(np.frombuffer(raw, np.int64))], names=["id", "n", "h"])

    held = stage(sets.mapInArrow(rows, "id long, n long, h long"), "contested")
    often = held.groupBy("h").agg(F.count("*").alias("often")).where("often > 1")
    # shingles that one set alone holds stand first and match nothing: they count, but are not joined
    shared = held.join(often, "h")
    place = F.row_number().over(Window.partitionBy("id").orderBy("often", "h"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    placed = shared.withColumn("later", F.count("*").over(Window.partitionBy("id")) - place)
    placed = placed.withColumn("place", F.col("n") - F.col("later")).where(F.col("place") <= prefix)
    placed = stage(placed.join(labels, "id").select("id", "n", "h", "later", "component"), "prefixes")
    x, y = placed.alias("x"), placed.alias("y")
    both_n = F.col("x.n") + F.col("y.n")
    # true of the first shingle that an alike pair shares: nothing is shared before it
    can = (1 + F.least("x.later", "y.later")) * (100 + percent) >= percent * both_n
    return (x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id"))
                   & (F.col("x.component") != F.col("y.component"))
                   & (F.lit(100) * F.least("x.n", "y.n") >= F.lit(percent) * F.greatest("x.n", "y.n")) & can)
            .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct())


# --- the operator ------------------------------------------------------------------

def near_duplicates(docs: DataFrame, percent: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text, any more columns):
    doc_id, n_shingles, component_id, kept. Sets hold runs of ``shingle`` words
    (1 to 16).

    Texts without a word, null ones included, have 0 shingles and no links.
    Every row is compared: rows that share a doc_id each with their own text,
    rows without one too. ``component_id`` is the least doc_id of the component,
    null if its rows have none. ``kept``: doc_id = component_id; a row of a
    component without ids is kept. An empty table gives no rows."""
    rows = _labelled(*_identified(docs.select("doc_id", "text")), percent, shingle)
    return rows.select("doc_id", "n_shingles", "component_id",
                       F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = THRESHOLD, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` less all but one of every component, that of the
    least doc_id (rows without one last); rows without words all stay. Decided by
    row: rows that share a doc_id are told apart, and of equal rows one stays."""
    rows, own = _identified(docs)
    found = _labelled(rows, own, percent, shingle).where("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    kept = found.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("held")).where("held > 1")
    gone = (found.join(kept.select("component", F.col("first._row").alias("_first")), "component")
            .where(F.col("_row") != F.col("_first")).select("_row"))
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def _identified(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with ``_row``, a number of the row's own: its doc_id where those
    are there and distinct (True), else one given when the rows are written once."""
    ids = docs.select(F.col("doc_id").cast("long").alias("_row"))
    again = ids.groupBy("_row").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or _row is null")
    if again.isEmpty():
        return docs.withColumn("_row", docs["doc_id"].cast("long")), True
    return stage(docs.withColumn("_row", F.monotonically_increasing_id()), "identified"), False


def _labelled(rows: DataFrame, own: bool, percent: int, shingle: int) -> DataFrame:
    """(_row, doc_id, n_shingles, component, component_id): the component by the
    least row number in it (null without words), and by the least doc_id."""
    arrow_rows(rows.sparkSession)
    texts = rows.select(F.col("_row").alias("doc_id"), "text")
    described = stage(texts.mapInArrow(_describe(shingle), "doc_id long, n_shingles long, set_key binary, bands array<long>"), "signatures")
    # a class of equal sets is known by its least row
    classes = stage(described.where("set_key is not null").groupBy("set_key")
                    .agg(F.min("doc_id").alias("id"), F.min_by("bands", "doc_id").alias("bands")), "classes")
    labels = _linked(texts, classes, percent, shingle)
    named = classes.select("set_key", "id").join(labels, "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("component"))
    out = described.join(named, "set_key", "left").select(F.col("doc_id").alias("_row"), "n_shingles", "component")
    if own:
        return out.select("_row", F.col("_row").alias("doc_id"), "n_shingles", "component",
                          F.coalesce("component", "_row").alias("component_id"))
    out = stage(out.join(rows.select("_row", F.col("doc_id").cast("long").alias("doc_id")), "_row"), "labelled")
    least = out.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    return (out.join(least, "component", "left")
            .select("_row", "doc_id", "n_shingles", "component",
                    F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def _linked(texts: DataFrame, classes: DataFrame, percent: int, shingle: int) -> DataFrame:
    member = classes.select("id", F.explode("bands").alias("bucket"))
    crowd = member.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    member = stage(member.join(crowd, "bucket"), "buckets")
    company = member.groupBy("id").agg(F.sum("crowd").alias("company"))
    ranked = member.join(company, "id")
    centre = ranked.groupBy("bucket").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("c"))
    star = (member.join(centre.select("bucket", (-F.col("c.minus")).alias("centre")), "bucket").where("id <> centre")
            .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    star = stage(star, "stars")
    needed = member.select("id").distinct()
    # equal sets have equal texts up to case and white space: any row of the class's id with that set will do
    chosen = texts.join(needed, texts["doc_id"] == needed["id"]).select("id", "text")
    sets = stage(chosen.mapInArrow(_sets(shingle), "id long, n long, hashes binary").where("n > 0"), "sets")
    edges = stage(_verified(star, sets, percent), "links")
    labels = components(edges)
    member = member.join(labels, "id", "left").select("id", "bucket", "crowd", F.coalesce("component", "id").alias("component"))
    open_buckets = (member.where("crowd > 2").groupBy("bucket")
                    .agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("bucket"))
    contested = stage(member.join(open_buckets, "bucket", "left_semi").select("id", "component").distinct(), "contested-ids")
    pairs = _contested_pairs(sets.join(contested.select("id"), "id", "left_semi"), contested, percent)
    more = stage(_verified(pairs, sets, percent), "more-links")
    return components(edges.union(more))
