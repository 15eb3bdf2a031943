"""Vector code compression: product codes whose parts are assigned over a
lexicographic trie.

A vector's components become integers and are cut into equal parts; each part
position has a codebook. The distinct parts of a block of rows, sorted, are the
leaves of a trie whose levels are the part's dimensions. The traversal goes
down it depth first and carries one vector per open node: the squared distances
of the node's prefix to all entries, summed so far. Parts that share a prefix
share that sum; at a leaf its argmin is the code, and the leaf's values times
the number of its rows go into the entry's sums. Only those sums (entries times
dimensions a task) are shuffled: the vectors stay where they were read, in every
round and in the last pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import stage

#: parts of a vector, entries of a codebook, training rounds
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: a component x is floor(SCALE * x)
SCALE = 256
#: integers stay within these bounds, so that every sum fits 64 bits
LIMIT = 1 << 24
#: components of a block of rows, and leaves that the traversal takes at a time
BLOCK_VALUES, LEAVES = 1 << 21, 4096


@dataclass
class Codebooks:
    """``entries``: parts x entries x width integers (entries may be 0)."""
    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        """Of the decimal components by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def quantized(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x ``dims`` integers of an Arrow column of lists; a shorter vector
    ends in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64)
    if sizes.size and (sizes == dims).all():
        return whole.reshape(sizes.size, dims)
    out = np.zeros((sizes.size, dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = whole
    return out


class PartTrie:
    """The trie of the distinct rows of ``parts``; ``counts`` rows each."""

    def __init__(self, parts: np.ndarray):
        order = np.lexsort(parts.T[::-1])
        rows = parts[order]
        # opens[j]: whether a row's prefix of j + 1 dimensions differs from the row before
        opens = np.ones(rows.shape, bool)
        opens[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
        leaf = opens[:, -1]
        self.leaves, self.opens = rows[leaf], opens[leaf]
        ids = np.cumsum(leaf) - 1
        self.leaf_of = np.empty(len(parts), np.int64)
        self.leaf_of[order] = ids
        self.counts = np.bincount(ids, minlength=len(self.leaves))

    def nearest(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every leaf's nearest entry (ties: the lower) and its squared
        distance. ``open_`` holds the summed distances of the path that is open
        at the end of the leaves done, one vector a level."""
        width = entries.shape[1]
        ends = np.concatenate([self.leaves.ravel(), entries.ravel()])
        span = int(ends.max() - ends.min())
        kind = np.int32 if width * span * span < 2**31 else np.int64
        leaves, cols = self.leaves.astype(kind), entries.T.astype(kind)
        code, error = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
        open_ = np.zeros((width, len(entries)), kind)
        for a in range(0, len(leaves), LEAVES):
            part, opens = leaves[a:a + LEAVES], self.opens[a:a + LEAVES]
            sums, node = np.zeros((1, len(entries)), kind), np.zeros(len(part), np.int64)
            for j in range(width):
                first = opens[:, j].copy()
                goes_on, first[0] = not first[0], True
                at = np.flatnonzero(first)
                step = part[at, j][:, None] - cols[j]
                step *= step
                step += sums[node[at]]
                if goes_on:  # the node is open since the leaves before
                    step[0] = open_[j]
                open_[j] = step[-1]
                sums, node = step, np.cumsum(first) - 1
            best = sums.argmin(axis=1)
            code[a:a + LEAVES] = best
            error[a:a + LEAVES] = sums[np.arange(len(best)), best]
        return code, error

    def sums(self, code: np.ndarray, n_entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each entry, and the sums of their components."""
        n = np.zeros(n_entries, np.int64)
        np.add.at(n, code, self.counts)
        total = np.zeros((n_entries, self.leaves.shape[1]), np.int64)
        np.add.at(total, code, self.leaves * self.counts[:, None])
        return n, total


def _blocks(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[pa.Table]:
    """Tables of about BLOCK_VALUES components."""
    limit, held, rows = max(1, BLOCK_VALUES // max(dims, 1)), [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            piece = batch.slice(at, limit)
            held.append(piece)
            rows += piece.num_rows
            if rows >= limit:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def first_vectors(vectors: DataFrame, parts: int, entries: int, key: str, vector: str) -> Codebooks:
    """The first codebooks: the parts of the rows with the least keys (ties by
    the vector). At most ``entries`` rows reach the driver."""
    dims = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    width = -(-dims // parts)
    rows = vectors.select(key, vector).orderBy(F.asc_nulls_last(key), vector).limit(entries).collect()
    column = pa.array([r[1] for r in rows], pa.list_(pa.float64()))
    whole = quantized(column, width * parts)
    return Codebooks(whole.reshape(len(rows), parts, width).transpose(1, 0, 2).copy())


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          key: str = "vec_id", vector: str = "embedding") -> Codebooks:
    """Codebooks of the vectors: at first the parts of the ``entries`` least
    keys, then ``rounds`` times every part goes to its nearest entry and every
    entry becomes the componentwise floor of its parts' mean; an entry without
    parts stays.

    Vectors that are null or hold null or non-finite components are left out.
    With vectors of several lengths, or of one that ``parts`` does not divide,
    zeros follow the shorter ones up to the next multiple of ``parts``. Rows with
    equal keys count each; null keys come last. Fewer rows than ``entries`` give
    as many entries; an empty table gives none. Components are kept within
    +-LIMIT / SCALE."""
    vectors = vectors.where(usable(vector)).select(key, vector)
    books = first_vectors(vectors, parts, entries, key, vector)
    if not books.entries.size:
        return books
    for _ in range(rounds):
        now = books.entries

        def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(now.shape[:2], np.int64)
            total = np.zeros(now.shape, np.int64)
            for table in _blocks(batches, now.shape[0] * now.shape[2]):
                rows = quantized(_column(table, vector), now.shape[0] * now.shape[2]).reshape(table.num_rows, *now.shape[::2])
                for p in range(now.shape[0]):
                    trie = PartTrie(rows[:, p])
                    code, _ = trie.nearest(now[p])
                    one_n, one_total = trie.sums(code, now.shape[1])
                    n[p] += one_n
                    total[p] += one_total
            # one row per part and entry in use; the last value is the number of parts
            used = np.argwhere(n)
            values = np.concatenate([total, n[..., None]], axis=2)[n > 0]
            at = np.arange(values.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used[:, 0], at.size).astype(np.int32)), pa.array(np.repeat(used[:, 1], at.size).astype(np.int32)),
                 pa.array(np.tile(at, len(used)).astype(np.int32)), pa.array(values.ravel())], ["part", "entry", "at", "value"])

        sums = (vectors.select(vector).mapInArrow(partial, "part int, entry int, at int, value long")
                .groupBy("part", "entry", "at").agg(F.sum("value").alias("value")).collect())  # entries x dimensions
        found = np.zeros((*now.shape[:2], now.shape[2] + 1), np.int64)
        for r in sums:
            found[r["part"], r["entry"], r["at"]] = r["value"]
        n = found[..., -1:]
        books = Codebooks(np.where(n > 0, found[..., :-1] // np.maximum(n, 1), now))
    return books


def encode(vectors: DataFrame, books: Codebooks, vector: str = "embedding",
           code: str = "code", error: str = "error") -> DataFrame:
    """The rows of ``vectors`` whose vector is usable, with ``code`` (the entry
    of each part, two hex digits) and ``error`` (squared distances summed over
    the parts), which replace columns of those names."""
    kept = vectors.where(usable(vector)).drop(code, error)
    schema = kept.drop(vector)
    names = schema.columns
    entries = books.entries
    parts, n_entries, width = entries.shape
    hexes = np.array([f"{i:02x}" for i in range(max(n_entries, 1))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches, parts * width):
            rows = quantized(_column(table, vector), parts * width).reshape(table.num_rows, parts, width)
            codes, errors = np.empty((table.num_rows, parts), np.int64), np.zeros(table.num_rows, np.int64)
            for p in range(parts):
                trie = PartTrie(rows[:, p]) if width else None
                if trie is None:  # vectors without components
                    codes[:, p] = 0
                    continue
                best, far = trie.nearest(entries[p])
                codes[:, p] = best[trie.leaf_of]
                errors += far[trie.leaf_of]
            text = hexes[codes].view(f"<U{2 * parts}").ravel()
            out = table.select(names).append_column(code, pa.array(text.tolist(), pa.string())).append_column(error, pa.array(errors))
            yield from out.combine_chunks().to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema.fields)
    return kept.mapInArrow(run, f"{fields}, `{code}` string, `{error}` long")


def code_report(embeddings: DataFrame) -> DataFrame:
    """Per kept vector: ``vec_id``, ``code``, ``error``, ``label_error`` (error
    summed over the rows of the same label, null being one label) and
    ``codebooks_sha256``. An empty table gives no rows. The label's sums are
    partially aggregated and joined back: broadcast by AQE while labels are
    few, else a sort-merge join whose hot labels AQE splits."""
    vectors = embeddings.select("vec_id", "label", "embedding")
    books = train(vectors)
    coded = stage(encode(vectors, books), "veccodes")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(totals, coded["label"].eqNullSafe(totals["_label"]))
            .select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")))


def report_sql() -> str:
    """``code_report`` in DuckDB SQL, for vectors of one length that the parts
    divide."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT x.r, x.p, min(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {ENTRIES} + c.e) AS m
  FROM parts x JOIN book{r} c ON c.p = x.p GROUP BY x.r, x.p)""")
        if r < ROUNDS:
            steps.append(f"""
mean{r} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
    SELECT x.p, (m % {ENTRIES}) AS e, d, sum(x.v[d])::BIGINT AS s, count(*)::BIGINT AS n
    FROM near{r} a JOIN parts x ON x.r = a.r AND x.p = a.p, unnest(range(1, len(x.v) + 1)) u(d)
    GROUP BY 1, 2, 3) GROUP BY p, e),
book{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM book{r} c LEFT JOIN mean{r} m ON m.p = c.p AND m.e = c.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, q[p * len(q) // {PARTS} + 1 : (p + 1) * len(q) // {PARTS}] AS v FROM kept, unnest(range({PARTS})) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {ENTRIES}),{",".join(steps)},
coded AS (
  SELECT r, string_agg(lpad(lower(to_hex(m % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code, sum(m // {ENTRIES})::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books"""
