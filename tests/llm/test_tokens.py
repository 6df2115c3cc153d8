"""Token files, separator scan, packing: exact round trips."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from anemoi.llm import packing, token_counts, tokens
from tests.llm.corpus import SCHEMA, corpus


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(text):
    return tokens.encoding().encode_ordinary(text or "")


TEXTS = st.text(st.sampled_from("ab'sé 1,.\n\t\r\x0b\x1c\x85\xa0 　中😀"), max_size=40) | st.text(max_size=20)


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_pieces_encode_like_the_whole_text(text):
    got = np.frombuffer(tokens.encode(text), dtype="<u2").tolist()
    assert got == ids(text)
    assert tokens.encoding().decode(got) == text


@pytest.mark.parametrize("block", [7, 64, token_counts.BLOCK])
def test_counts_over_block_borders(docs, none, block):
    got = token_counts.counted(docs, block=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((r[0], len(ids(r[1]))) for r in corpus())
    assert len({(r.file, r.ordinal) for r in got}) == len(got)
    assert token_counts.counted(none, block=block).count() == 0


def test_scan_of_raw_files(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "BUCKET", 2)
    rng = np.random.default_rng(3)
    rows, want = [], []
    for f in range(4):
        x = np.where(rng.random(300) < (0.02, 0.5, 1, 0)[f], 9, rng.integers(10, 99, 300)).astype("<u2")
        cuts = [0, *sorted(rng.integers(0, 300, 8).tolist()), 300]
        rows += [(f, b, x[i:j].tobytes()) for b, (i, j) in enumerate(zip(cuts, cuts[1:]))]
        start = 0
        for n, at in enumerate(np.flatnonzero(x == 9)):
            want.append((f, n, start, int(at) - start, True))
            start = int(at) + 1
        if start < 300:
            want.append((f, int((x == 9).sum()), start, 300 - start, False))
    rows.append((9, 0, None))
    blocks = spark.createDataFrame(rows, "file int, block long, data binary").repartition(5)
    assert sorted(map(tuple, token_counts.separator_scan(blocks, 9).collect())) == sorted(want)


def check_rows(rows, want, length):
    """Every document comes back whole from its segments."""
    parts = defaultdict(list)
    for r in rows:
        row, pos = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(row) == len(pos) == length and r.cu_seqlens[-1] == r.n_tokens <= length
        assert (row[r.n_tokens:] == packing.PAD).all()
        for d, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[a:b].tolist() == list(range(b - a))
            parts[d].append((start, row[a:b].tolist()))
    got = Counter()
    for d, segs in parts.items():
        if sum(s == 0 for s, _ in segs) > 1:       # repeated ids: compare as bags of tokens
            got[(d, tuple(sorted(t for _, s in segs for t in s)))] += 1
        else:
            got[(d, tuple(t for _, s in sorted(segs) for t in s))] += 1
    assert got == want


@pytest.mark.parametrize("length,group", [(16, 200), (2048, packing.GROUP)])
def test_packing_is_lossless(docs, none, length, group):
    texts = defaultdict(list)
    for r in corpus():
        texts[r[0]].append(ids(r[1]) + [tokens.EOD])
    want = Counter((d, tuple(x[0]) if len(x) == 1 else tuple(sorted(t for y in x for t in y))) for d, x in texts.items())
    rows = packing.packed(docs, length, group=group).collect()
    check_rows(rows, want, length)
    assert len({(r.part, r.row) for r in rows}) == len(rows)
    assert packing.packed(none, length).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60), st.sampled_from([24, 31, 32]))
def test_best_fit_decreasing(lengths, length):
    rows = packing.best_fit(lengths, length)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= length for r in rows)
    free = []                                     # the plain rule, by search
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - lengths[i])
        else:
            free.append(length - lengths[i])
    assert sorted(length - sum(lengths[i] for i in r) for r in rows) == sorted(free)
