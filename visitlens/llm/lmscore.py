"""LM scoring (operator 6): stupid-backoff scores, computed relationally.

Words and word pairs of the whole corpus are counted in tables partitioned by
n-gram hash, joined back to the n-grams of every document and summed per
document. To keep the exchanged tables small, rows are packed: a chunk is a
few documents of one task with their words as numbers into the chunk's own
vocabulary; each chunk sends every n-gram it holds once, with its count, to the
n-gram's hash bucket, and gets the corpus count back. A frequent n-gram is one
entry a chunk, so no bucket depends on one key, and buckets grow in number,
not in size, with the corpus.

Counts leave the scored document itself out, so a document is judged by the
rest of the corpus: S(w | v) = c(v w) / c(v) if c(v w) > 0, else ALPHA S(w),
S(w) = c(w) / N if c(w) > 0, else ALPHA / (N + 1).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, mix64, stage, texts_as_bytes

ALPHA = 0.4
#: words of a chunk, about (a longer document is a chunk of its own)
CHUNK_WORDS = 1_500_000
#: n-grams of a bucket, about
BUCKET_GRAMS = 1_000_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: bits of an n-gram's hash that travel; the bucket has the others, more of them the more n-grams there are
_GRAM = np.uint64((1 << 48) - 1)


def _pack(grams: np.ndarray) -> bytes:
    """Six bytes each: the low four of all, then the high two of all."""
    return (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (grams >> np.uint64(32)).astype(np.uint16).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    return np.frombuffer(raw, np.uint32, n).astype(np.uint64) | np.frombuffer(raw, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)


def _chunk(chunk_words: int):
    """Rows (chunk, n, docs, sizes, vocab, words) of a task's documents."""
    def row(key, docs, sizes, vocab, parts):
        return pa.RecordBatch.from_arrays(
            [pa.array([key], pa.int64()), pa.array([sum(sizes)], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([np.fromiter(map(xxhash.xxh64_intdigest, vocab), np.uint64, len(vocab)).tobytes()], pa.binary()),
             pa.array([zstandard.compress(b"".join(parts), 3)], pa.binary())], names=["chunk", "n", "docs", "sizes", "vocab", "words"])

    def run(batches):
        from pyspark import TaskContext
        part, done = TaskContext.get().partitionId(), 0
        docs, sizes, vocab, parts, n = [], [], {}, [], 0
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), texts_as_bytes(b)):
                words = text.lower().split()
                number = vocab.setdefault
                parts.append(np.fromiter((number(w, len(vocab)) for w in words), np.uint32, len(words)).tobytes())
                docs.append(doc)
                sizes.append(len(words))
                n += len(words)
                if n >= chunk_words:
                    yield row(part << 32 | done, docs, sizes, vocab, parts)
                    done += 1
                    docs, sizes, vocab, parts, n = [], [], {}, [], 0
        if docs:
            yield row(part << 32 | done, docs, sizes, vocab, parts)
    return run


class _Chunk:
    """A chunk's words, pairs and distinct n-grams in bucket order."""

    def __init__(self, sizes: list[int], vocab: bytes, words: bytes, buckets: int):
        self.sizes = np.array(sizes, dtype=np.int64)
        self.hash = np.frombuffer(vocab, np.uint64)
        self.words = np.frombuffer(zstandard.decompress(words), np.uint32).astype(np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        v = max(1, len(self.hash))
        # places whose word has one before it in the same document
        self.second = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1
        pairs = self.words[self.second - 1] * v + self.words[self.second]
        unique, self.pair, self.pair_count = np.unique(pairs, return_inverse=True, return_counts=True)
        self.word_count = np.bincount(self.words, minlength=len(self.hash))
        pair_hash = mix64(self.hash[unique // v] * _M1 + self.hash[unique % v] * _M2) if len(unique) else np.empty(0, np.uint64)
        grams = np.concatenate((self.hash, pair_hash))
        bucket = (grams % np.uint64(buckets)).astype(np.int64)
        grams = (grams // np.uint64(buckets)) & _GRAM
        self.order = np.lexsort((grams, bucket))
        self.grams, self.bucket = grams[self.order], bucket[self.order]

    def counts(self) -> np.ndarray:
        return np.concatenate((self.word_count, self.pair_count))[self.order].astype(np.uint32)


def _send(buckets: int):
    def run(batches):
        for b in batches:
            for chunk, sizes, vocab, words in zip(*(b.column(c).to_pylist() for c in ("chunk", "sizes", "vocab", "words"))):
                c = _Chunk(sizes, vocab, words, buckets)
                counts = c.counts()
                ends = np.flatnonzero(np.diff(c.bucket, append=-1)) + 1
                starts = np.concatenate(([0], ends[:-1]))[:len(ends)]
                if len(ends):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.bucket[starts]), pa.array([chunk] * len(ends), pa.int64()),
                         pa.array([_pack(c.grams[a:z]) for a, z in zip(starts, ends)], pa.binary()),
                         pa.array([counts[a:z].tobytes() for a, z in zip(starts, ends)], pa.binary())],
                        names=["bucket", "chunk", "grams", "counts"])
    return run


def _total(table: pa.Table) -> pa.Table:
    """Corpus counts of a bucket's n-grams, in each chunk's own order."""
    grams = [_unpack(x) for x in table.column("grams").to_pylist()]
    counts = [np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()]
    distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
    width = np.uint32 if total.max() < 1 << 32 else np.uint64
    split = np.split(total[at].astype(width), np.cumsum([len(g) for g in grams])[:-1])
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                     "width": pa.array([np.dtype(width).itemsize] * len(grams), pa.int32()),
                     "totals": pa.array([x.tobytes() for x in split], pa.binary())})


def _score(buckets: int, corpus: int):
    names = ["doc_id", "n_words", "log_score", "mean_log", "backed_off"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = right.sort_by("bucket")
        totals = [np.frombuffer(x, np.uint32 if w == 4 else np.uint64).astype(np.int64)
                  for x, w in zip(got.column("totals").to_pylist(), got.column("width").to_pylist())]
        docs, sizes, vocab, words = (left.column(c).to_pylist()[0] for c in ("docs", "sizes", "vocab", "words"))
        c = _Chunk(sizes, vocab, words, buckets)
        count = np.empty(len(c.grams), dtype=np.int64)
        count[c.order] = np.concatenate(totals) if totals else np.empty(0, np.int64)
        v, m = len(c.hash), len(docs)

        def others(item: np.ndarray, doc: np.ndarray, total: np.ndarray) -> np.ndarray:
            """How often each item occurs outside its own document."""
            _, at, own = np.unique(doc * (int(item.max()) + 1 if len(item) else 1) + item, return_inverse=True, return_counts=True)
            return total[item] - own[at]

        word = others(c.words, c.doc, count[:v])
        rest = np.maximum(corpus - c.sizes, 0)[c.doc]
        logs = np.log(np.where(word > 0, word / np.maximum(rest, 1), ALPHA / (rest + 1)))
        pair = others(c.pair, c.doc[c.second], count[v:])
        seen = pair > 0
        logs[c.second] = np.where(seen, np.log(np.maximum(pair, 1) / np.maximum(word[c.second - 1], 1)), np.log(ALPHA) + logs[c.second])
        total = np.bincount(c.doc, weights=logs, minlength=m).astype(np.float64)
        backed = np.bincount(c.doc[c.second], weights=~seen, minlength=m).astype(np.int64)
        empty = c.sizes == 0
        mean = pa.array(total / np.maximum(c.sizes, 1), pa.float64(), mask=empty)
        return pa.table([pa.array(docs, kinds[0]), pa.array(c.sizes), pa.array(total), mean, pa.array(backed)], names=names)
    return run


def score(docs: DataFrame, chunk_words: int = CHUNK_WORDS, bucket_grams: int = BUCKET_GRAMS) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text, any more columns):
    doc_id, n_words, log_score (sum of log S over the words), mean_log (per
    word; null without words), backed_off (words whose pair with the word
    before occurs in no other row).

    Words are runs without white space, A-Z in lower case. A null text has no
    words. Rows of equal text are separate documents and count for each other;
    equal and null doc_ids change nothing. An empty table gives no rows."""
    arrow_rows(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    store = stage(texts.mapInArrow(_chunk(chunk_words), "chunk long, n long, docs array<long>, sizes array<long>, vocab binary, words binary"), "lm-chunks")
    arrow_rows(docs.sparkSession, 2)
    corpus = store.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-2 * corpus // bucket_grams))
    sent = store.mapInArrow(_send(buckets), "bucket long, chunk long, grams binary, counts binary")
    totals = sent.groupBy("bucket").applyInArrow(_total, "bucket long, chunk long, width int, totals binary")
    return store.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(
        _score(buckets, corpus), "doc_id long, n_words long, log_score double, mean_log double, backed_off long")
