"""Spelling variants against brute force over all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.llm import variants


def near(a, b):
    """Whether two words differ by exactly one edit."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def lower(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def counted(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute(rows):
    n = counted(rows)
    if any(len(w) > 1000 for w in n):  # too long for keys
        links = {w: {v for v in n if near(w, v)} for w in n}
        return chains(n, links)
    # words one deletion apart, or equal but for one place, share a key
    keys = {}
    for w in n:
        for k in {(w,)} | {(w[:i] + w[i + 1:],) for i in range(len(w))} | {(i, w[:i], w[i + 1:]) for i in range(len(w))}:
            keys.setdefault(k, set()).add(w)
    links = {w: set() for w in n}
    for group in keys.values():
        for a in group:
            links[a] |= {b for b in group if near(a, b)}
    return chains(n, links)


def chains(n, links):
    form = {}
    for w, around in links.items():
        best = min(around, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_corpus_against_brute_force(small):
    rows = [(r["doc_id"], r["text"]) for r in small.collect()]
    found = got(variants.variant_groups(small))
    assert found == brute(rows) and any(r[1] for r in found)


def test_edge_rows(edge_docs, no_docs, spark):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(variants.variant_groups(edge_docs)) == brute(rows)
    assert got(variants.variant_groups(no_docs)) == []
    few = spark.createDataFrame([(1, "abcdef " * 7 + "abcdeg " * 40 + "abcdegh " * 300 + "ABCDXF ÀÖØöø÷×ÿ " * 6), (None, "abcdef 漢字abcdef𝔘abcdef")],
                                "doc_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in few.collect()]
    found = got(variants.variant_groups(few))
    assert found == brute(rows)
    assert {r[0]: r[2] for r in found}["abcdeg"] == "abcdegh"


def test_chains_are_followed_to_the_end(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    text = " ".join(" ".join([w] * 5 * 5**i) for i, w in enumerate(words))
    df = spark.createDataFrame([(3, text)], "doc_id long, text string")
    found = got(variants.variant_groups(df))
    assert found == brute([(3, text)])
    assert {r[2] for r in found} == {words[-1]}


@pytest.mark.parametrize("shard_words", [3, 40, 10_000])
def test_pairs_of_dense_words_over_many_shards(spark, shard_words):
    """Words over two letters: nearly all halves are shared, slices included."""
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(6, 9))) for _ in range(150)})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    found = [(r["word"], r["near"]) for r in variants.near_pairs(df, shard_words=shard_words).collect()]
    assert sorted(found) == sorted((a, b) for a in words for b in words if near(a, b))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abcé", min_size=2, max_size=7), min_size=1, max_size=40))
def test_index_finds_every_near_word_once(words):
    words = sorted(words)
    every = np.arange(len(words))
    found = [(words[q], words[w]) for left in (True, False) for qs, ws in variants.shard_pairs(words, every, every, left) for q, w in zip(qs, ws)]
    assert sorted(found) == sorted((a, b) for a in words for b in words if near(a, b))


def test_very_long_words(spark):
    long_ = "x" * 70_000
    text = " ".join([long_] * 5 + [long_ + "y"] * 30 + [long_[:-1] + "é"] * 6 + ["abcdef"] * 9)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert got(variants.variant_groups(df)) == brute([(1, text)])
