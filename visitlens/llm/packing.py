"""Packing (operator 1): documents cut into pieces that fill fixed windows.

Method: every document is cut into whole windows and one tail. The tails'
length histogram (at most ``window - 1`` bins, whatever the corpus) goes to the
driver, where shallow length combinations that fill a window exactly get
repeat counts by non-negative least squares; the counts are rounded down and
what remains is packed greedily, cutting a tail where a gap is left. The plan
speaks of "the r-th tail of length l"; each row finds its own rank by one join
with per-task counts, so no text or id passes the driver and no length is
ever gathered in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_rows, chunks, stage, texts_as_bytes

WINDOW = 2048
EOS = 1
#: unpadded single sequences are planned at these powers of two
SINGLES = (256, 512, 1024)
#: third members of a combination are tried among so many frequent lengths
FREQUENT = 8
SWEEPS = 20
#: entries of a worker's word cache before it starts anew
CACHE_WORDS = 400_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


# --- tokenizing -------------------------------------------------------------------

class WordEncoder:
    """Token ids of whole texts by ``tokenizers``, word by word with a cache.

    Only for tokenizers that drop white space and never look across it (such
    as word_bpe_49k): a text's ids are then those of its words in order. Words
    not in the cache are encoded together, joined by spaces, and told apart by
    offsets. If the tokenizer puts letters in lower case and gives a run of
    them to a byte-level BPE model, a run of plain Latin letters goes straight
    to that model; a probe on start-up finds out whether it does.
    """

    PROBE = ("abc", "the", "straße", "über", "çentión", "naïvely", "x", "qzxjkvw")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        #: the characters that stand for bytes in byte-level vocabularies
        self.byte_chars = {b: chr(256 + i) for i, b in enumerate(hidden)}
        full = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in self.PROBE]
        upper = [self.tokenizer.encode(w.upper(), add_special_tokens=False).ids for w in ("ABC", "THE")]
        marked = [self.tokenizer.encode("ab" + m, add_special_tokens=False).ids for m in ".,!?;:"]
        apart = [self.tokenizer.encode("ab " + m, add_special_tokens=False).ids for m in ".,!?;:"]
        self.plain = (upper == full[:2] and marked == apart
                      and all(self._ids(x) == self._run(w) for x, w in zip(full, self.PROBE)))
        #: texts with these bytes may hold a special token, which is told by case
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _run(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(self.byte_chars)
        return self._ids([t.id for t in self.model.tokenize(letters)])

    def _encode(self, texts: list[str]) -> list[bytes]:
        enc = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(enc.ids, dtype=self.kind)
        starts = np.cumsum([0] + [len(x) + 1 for x in texts[:-1]])
        at = np.array([a for a, _ in enc.offsets], dtype=np.int64)
        cuts = np.searchsorted(at, starts).tolist() + [len(ids)]
        raw, width = ids.tobytes(), ids.itemsize
        return [raw[a * width:b * width] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, missing: list[bytes]) -> None:
        rest, words, runs = [], self.words, self.runs
        for w in missing:
            s = w.decode("utf-8", "replace")
            # letters and at most one mark behind them, which is a token of its own
            run, mark = (s[:-1], s[-1]) if s[-1] in ".,!?;:" else (s, "")
            if self.plain and run.isalpha() and max(run) < "\u0180" and run == run.lower():
                ids = runs.get(run)
                if ids is None:
                    ids = runs[run] = self._run(run)
                if mark:
                    tail = runs.get(mark)
                    if tail is None:
                        tail = runs[mark] = self._ids(self.tokenizer.encode(mark, add_special_tokens=False).ids)
                    ids += tail
                words[w] = ids
            else:
                rest.append(s)
                words[w] = None
        if rest:
            todo = [w for w in missing if words[w] is None]
            for i in range(0, len(rest), 5000):
                words.update(zip(todo[i:i + 5000], self._encode(rest[i:i + 5000])))

    def _lower(self, text: bytes) -> bytes:
        low = text.lower() if self.plain else text
        return text if self.plain and any(x in low for x in self.special) else low

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for part in chunks((self._lower(t).split() for t in texts), len, 100_000):
            for cache in (self.words, self.runs):
                if len(cache) > CACHE_WORDS:
                    cache.clear()
            missing = [w for w in set().union(*part) if w not in self.words]
            if missing:
                self._learn(missing)
            get = self.words.__getitem__
            out += [b"".join(map(get, ws)) for ws in part]
        return out


_encoders: dict[str, WordEncoder] = {}


def _tokenize(path: str, window: int, doc_type):
    def run(batches):
        from pyspark import TaskContext
        encoder = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
        part = TaskContext.get().partitionId()
        width = np.dtype(encoder.kind).itemsize
        eos = np.array([EOS], dtype=encoder.kind).tobytes()
        seen = np.zeros(window, dtype=np.int64)
        full = 0
        for b in batches:
            ids = [x + eos for x in encoder(texts_as_bytes(b))]
            n = [len(x) // width for x in ids]
            tails, nth, before = [], [], []
            for x in n:
                t = x % window
                tails.append(t)
                nth.append(seen[t])
                before.append(full)
                seen[t] += 1
                full += x // window
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(doc_type), pa.array([part] * len(n), pa.int64()), pa.array(n, pa.int64()),
                 pa.array(tails, pa.int32()), pa.array(nth, pa.int64()), pa.array(before, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "part", "n", "tail", "nth", "full_before", "ids"])
    return run


# --- the plan over the histogram ---------------------------------------------------

def combinations(hist: dict[int, int], window: int) -> list[tuple[int, ...]]:
    """Shallow combinations of present lengths that fill a window: singles at
    powers of two, all pairs, and triples with one frequent member."""
    found = {(p,) for p in SINGLES if p < window and p in hist}
    found |= {(window - a, a) for a in hist if 2 * a <= window and window - a in hist}
    for b in sorted(hist, key=lambda x: (-hist[x], x))[:FREQUENT]:
        for a in hist:
            c = window - a - b
            if c in hist:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found)


def nnls(combos: list[tuple[int, ...]], hist: dict[int, int]) -> list[float]:
    """Repeat counts x >= 0 that minimise |A x - h|^2, by cyclic coordinate
    descent (each column has at most three entries)."""
    rest = {k: float(v) for k, v in hist.items()}
    cols = [[(k, c.count(k)) for k in dict.fromkeys(c)] for c in combos]
    norm = [sum(m * m for _, m in col) for col in cols]
    x = [0.0] * len(cols)
    for _ in range(SWEEPS):
        moved = 0.0
        for j, col in enumerate(cols):
            step = max(-x[j], sum(m * rest[k] for k, m in col) / norm[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for k, m in col:
                    rest[k] -= m * step
        if moved < 0.01:
            break
    return x


class Plan:
    """Which sequence each tail (or cut of one) goes to.

    ``lots[l]`` holds runs of equal pieces of length ``l``: (tail length,
    piece start, first rank, how many). A record sends the ``count`` tails
    from ``rank`` on of one tail length to ``repeat`` sequences from ``base``
    on: the j-th of them goes to sequence ``base + j % repeat`` at offset
    ``offset + (j // repeat) * length``.
    """

    def __init__(self, hist: dict[int, int], window: int = WINDOW):
        self.window, self.sequences, self.records = window, 0, []
        self.count = {k: v for k, v in hist.items() if v > 0}
        self.lots = {k: deque([(k, 0, 0, v)]) for k, v in self.count.items()}
        combos = combinations(self.count, window)
        for combo, x in sorted(zip(combos, nnls(combos, self.count)), key=lambda p: (-p[1], p[0])):
            need = {k: combo.count(k) for k in combo}
            n = min(int(x), *(self.count.get(k, 0) // m for k, m in need.items()))
            if n > 0:
                self._fill([(k, m) for k, m in need.items()], n)
        self.lengths = sorted(self.count)
        while self.lengths:
            self._greedy()

    def _take(self, length: int, total: int) -> list[tuple[int, int, int, int]]:
        got, lots = [], self.lots[length]
        self.count[length] -= total
        while total:
            src, start, rank, n = lots.popleft()
            k = min(n, total)
            got.append((src, start, rank, k))
            if k < n:
                lots.appendleft((src, start, rank + k, n - k))
            total -= k
        if not self.count[length]:
            del self.count[length], self.lots[length]
        return got

    def _put(self, length: int, lot: tuple[int, int, int, int]) -> None:
        if length not in self.count:
            self.count[length], self.lots[length] = 0, deque()
            insort(self.lengths, length)
        self.count[length] += lot[3]
        self.lots[length].append(lot)

    def _fill(self, parts: list[tuple[int, int]], repeat: int, cut: tuple[int, int] | None = None) -> None:
        """``repeat`` sequences of ``m`` pieces of length ``k`` for each (k, m),
        then of the first ``gap`` tokens of a longer piece for cut (length, gap)."""
        offset = 0
        for k, m in parts:
            j = 0
            for src, start, rank, n in self._take(k, m * repeat):
                self.records.append((src, rank, n, start, k, self.sequences, repeat, j, offset))
                j += n
            offset += k * m
        if cut:
            k, gap = cut
            j = 0
            for src, start, rank, n in self._take(k, repeat):
                self.records.append((src, rank, n, start, gap, self.sequences, repeat, j, offset))
                self._put(k - gap, (src, start + gap, rank, n))
                j += n
        self.sequences += repeat

    def _greedy(self) -> None:
        gap, parts, limit = self.window, [], len(self.lengths)
        while gap and limit:
            limit = bisect_left(self.lengths, gap + 1, 0, limit)
            if not limit:
                break
            k = self.lengths[limit - 1]
            m = min(gap // k, self.count[k])
            parts.append((k, m))
            gap -= k * m
            limit -= 1
        repeat = min(self.count[k] // m for k, m in parts)
        left = [k for k in self.lengths[::-1] if k > gap and k not in dict(parts)]
        # a piece may also be cut from what the parts leave over
        spare = [k for k, m in parts if k > gap and self.count[k] > m]
        cut = (left or spare or [None])[0] if gap else None
        if cut is not None:
            used = dict(parts).get(cut, 0)
            repeat = min(repeat, self.count[cut] // (used + 1))
        self._fill(parts, repeat, (cut, gap) if cut is not None else None)
        self.lengths = sorted(self.count)

    def arrays(self) -> dict[int, np.ndarray]:
        by: dict[int, list] = {}
        for r in self.records:
            by.setdefault(r[0], []).append(r[1:])
        return {k: np.array(sorted(v), dtype=np.int64) for k, v in by.items()}


# --- applying it ------------------------------------------------------------------

def _pieces(plan: dict[int, np.ndarray], sequences: int, window: int, width: int):
    kind = f"<u{width}"

    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("doc_id", "n", "tail", "nth", "before", "full_before", "full_base", "ids")]
            out: list[list] = [[] for _ in range(7)]
            for doc, n, tail, nth, before, full_before, full_base, raw in zip(*cols):
                ids = np.frombuffer(raw, dtype=kind).astype("<u4")
                places = [(i * window, window, sequences + full_base + full_before + i, 0) for i in range(n // window)]
                if tail:
                    rank, recs = before + nth, plan[tail]
                    for lo, _, start, length, base, repeat, j0, offset in recs[(recs[:, 0] <= rank) & (rank < recs[:, 0] + recs[:, 1])].tolist():
                        j = j0 + rank - lo
                        places.append((n - tail + start, length, base + j % repeat, offset + j // repeat * length))
                for start, length, seq, offset in places:
                    for c, v in zip(out, (doc, start, length, zlib.crc32(ids[start:start + length].tobytes()), n, seq, offset)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], b.schema.field("doc_id").type), *(pa.array(c, pa.int64()) for c in out[1:])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Pack ``docs`` (doc_id, text, any more columns) into sequences of at
    most ``window`` tokens; one row per piece.

    ``tokenizer`` is the path of a tokenizers file whose tokens never cross
    white space; id 1 ends every document. A null or empty text is the end id
    alone. Null, repeated and equal doc_ids are packed like any other row: each
    row is a document. An empty table gives no rows. All sequences are full but
    those planned at a power of two and at most the last few.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    doc_type = pa.string() if kind == "string" else pa.int64()
    doc_sql = "string" if kind == "string" else "long"
    tokens = stage(docs.select("doc_id", "text").mapInArrow(
        _tokenize(tokenizer, window, doc_type),
        f"doc_id {doc_sql}, part long, n long, tail int, nth long, full_before long, ids binary"), "tokens")
    counts = stage(tokens.groupBy("part", "tail").agg(
        F.count("*").alias("rows"), F.sum(F.floor(F.col("n") / window)).alias("full")), "tail-counts")
    hist = {r[0]: r[1] for r in counts.where("tail > 0").groupBy("tail").agg(F.sum("rows")).collect()}
    plan = Plan(hist, window)
    by_part = counts.groupBy("part").agg(F.sum("full").alias("full"))
    by_part = by_part.select("part", (F.sum("full").over(Window.orderBy("part")) - F.col("full")).alias("full_base"))
    offsets = counts.select("part", "tail", (F.sum("rows").over(Window.partitionBy("tail").orderBy("part"))
                                             - F.col("rows")).alias("before")).join(by_part, "part")
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    return (tokens.join(offsets, ["part", "tail"])
            .select("doc_id", "n", "tail", "nth", "before", "full_before", "full_base", "ids")
            .mapInArrow(_pieces(plan.arrays(), plan.sequences, window, width),
                        PIECES.replace("doc_id long", f"doc_id {doc_sql}")))
