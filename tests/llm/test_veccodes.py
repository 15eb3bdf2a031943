"""Vector codes against a plain Python form on small and clashing tables."""

import hashlib
import math

import numpy as np
import pytest

from .conftest import SF
from visitlens.llm import veccodes

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=veccodes.PARTS, entries=veccodes.ENTRIES, rounds=veccodes.ROUNDS):
    """Reference result as {(vec_id, code, error, label_error, sha)} in a list."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), lab) for i, v, lab in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [tuple(sum(x) // len(groups[e]) for x in zip(*groups[e])) if e in groups else old
                        for e, old in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, labels = [], {}
    for (i, _, lab), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        labels[lab] = labels.get(lab, 0) + error
        found.append((i, "".join(f"{e:02x}" for _, e in best), error, lab))
    return sorted(((i, code, err, labels[lab], sha) for i, code, err, lab in found), key=str)


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert got(veccodes.code_report(table)) == brute(rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(5)
    some = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.02, 32)], int(i % 3) if i % 4 else None) for i in range(90)]
    rows = some + [some[3], some[3], (some[3][0], some[4][1], 9), (None, some[5][1], 1), (200, None, 1), (201, [None] + some[0][1][1:], 1),
                   (202, [inf] + some[0][1][1:], 2), (203, [nan] + some[0][1][1:], 2), (204, [], 2), (205, [0.5] * 7, 2), (206, [0.0] * 32, None)]
    extra = [(*r, 1, "c", 2, "p", 3) for r in rows]
    df = spark.createDataFrame(extra, SCHEMA + ", error long, code string, part int, `at` string, _label int").repartition(5)
    assert got(veccodes.code_report(df)) == brute(rows)


def test_few_rows_and_none(spark):
    assert got(veccodes.code_report(spark.createDataFrame([], SCHEMA))) == []
    assert got(veccodes.code_report(spark.createDataFrame([(1, None, 1)], SCHEMA))) == []
    rows = [(2, [0.1] * 16, 1), (1, [-0.1] * 16, 1)]
    assert got(veccodes.code_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert [r[1:3] for r in got(veccodes.code_report(spark.createDataFrame([(1, [], 1)], SCHEMA)))] == [("00" * 16, 0)]


@pytest.mark.parametrize("leaves", [1, 3, 4096])
def test_the_traversal_shares_prefixes_across_its_steps(monkeypatch, leaves):
    """Whatever number of leaves a step takes, distances are the plain ones."""
    monkeypatch.setattr(veccodes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    parts = rng.integers(-3, 3, (400, 4))
    entries = rng.integers(-4, 4, (7, 4))
    trie = veccodes.PartTrie(parts)
    assert (trie.leaves[trie.leaf_of] == parts).all() and trie.counts.sum() == 400
    assert len(trie.leaves) == len({tuple(p) for p in parts.tolist()})
    code, error = trie.nearest(entries)
    plain = ((trie.leaves[:, None] - entries) ** 2).sum(axis=2)
    assert (code == plain.argmin(axis=1)).all() and (error == plain.min(axis=1)).all()


def test_large_components_are_exact_or_held(spark):
    rows = [(i, [float(np.float32(x)) for x in np.linspace(-60000, 60000, 32) + i * 17], i % 2) for i in range(70)]
    assert got(veccodes.code_report(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    far = veccodes.code_report(spark.createDataFrame([(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1)], SCHEMA)).collect()
    assert [r["error"] for r in far] == [0, 0]
