import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from visitlens.llm import packing
from visitlens.llm.queries import tokenizer_path


def check(docs, window=packing.WINDOW):
    got = packing.pack(docs, tokenizer_path(), window).toPandas()
    tk = Tokenizer.from_file(tokenizer_path())
    want = sorted((-1 if i is None else i, tuple(tk.encode(t or "", add_special_tokens=False).ids + [1]))
                  for i, t in docs.select("doc_id", "text").toPandas().astype(object).where(lambda x: x.notna(), None).values)
    # each document's pieces, by id and the crc of its own cuts
    pieces = {}
    for r in got.itertuples():
        pieces.setdefault((-1 if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id), int(r.doc_tokens)), []).append((r.start, r.length, r.ids_crc32))
    used = 0
    for (doc, ids) in want:
        at, own = 0, pieces[doc, len(ids)]
        while at < len(ids):
            hit = next(p for p in own if p[0] == at and p[2] == zlib.crc32(np.array(ids[at:at + p[1]], dtype="<u4").tobytes()))
            own.remove(hit)
            at += hit[1]
            used += 1
        assert at == len(ids)
    assert used == len(got)
    by = got.sort_values(["sequence_id", "offset"])
    assert ((by.groupby("sequence_id").length.cumsum() - by.length) == by.offset).all()
    sizes = by.groupby("sequence_id").length.sum()
    assert sizes.max() <= window if len(sizes) else True
    return got, sizes


def test_all_documents_round_trip_with_little_padding(small):
    _, sizes = check(small)
    waste = sum(2048 - n for n in sizes if n & (n - 1))
    assert waste <= 2048


def test_edges(edge_docs):
    check(edge_docs)


def test_small_window(edge_docs):
    check(edge_docs, 64)


def test_empty_table(no_docs):
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 400), max_size=40))
def test_plan_places_every_token_once(hist):
    plan = packing.Plan(hist, 64)
    fill, cover = {}, {}
    for src, rank, n, start, length, base, repeat, j0, offset in plan.records:
        for i in range(n):
            j = j0 + i
            fill.setdefault(base + j % repeat, []).append((offset + j // repeat * length, length))
            cover.setdefault((src, rank + i), []).append((start, length))
    assert set(cover) == {(k, r) for k, v in hist.items() for r in range(v)}
    for (src, _), parts in cover.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == src
    assert set(fill) == set(range(plan.sequences))
    short = 0
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
        short += at < 64 and at & (at - 1) != 0
    assert short <= 1


def test_nnls_fits_a_solvable_histogram():
    x = packing.nnls([(40, 24), (32, 32), (30, 20, 14)], {40: 10, 24: 10, 32: 8, 30: 5, 20: 5, 14: 5})
    assert np.allclose(x, [10, 4, 5], atol=0.05)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_as_the_whole_text(text):
    encoder = packing._encoders.setdefault(tokenizer_path(), packing.WordEncoder(tokenizer_path()))
    got = np.frombuffer(encoder([text.encode("utf-8", "replace")])[0], encoder.kind).tolist()
    assert got == encoder.tokenizer.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids
