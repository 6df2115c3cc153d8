"""Texts of several MB through every operator that works on windows, lines or sets of a text."""

import random

import numpy as np
import pytest

from anemoi.llm import decontaminate, line_dedup, near_dup, packing, quality_rules, substring_dedup
from anemoi.llm.tokens import encode
from tests.llm.corpus import VOCAB

PASSAGE = "a passage that the benchmark holds and the long text ends with indeed"


@pytest.fixture(scope="module")
def long_text():
    rng = random.Random(21)
    lines = [" ".join(rng.choice(VOCAB) for _ in range(2_000)) + f" line {i}" for i in range(300)]
    return "\n".join([*lines, PASSAGE])


@pytest.fixture(scope="module")
def docs(spark, long_text):
    assert len(long_text) > 3_000_000
    rows = [(1, long_text), (2, long_text), (3, "a short text of its own, with more than ten words in it, truly")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(2)


def test_rules(docs, long_text):
    got = {r.doc_id: r for r in quality_rules.ledger(docs).collect()}
    assert got[1].n_words == got[2].n_words == len(long_text.split()) and got[3].n_words == 14


def test_decontamination(spark, docs, long_text):
    items = spark.createDataFrame([(7, PASSAGE), (None, PASSAGE)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.contaminated(docs, items).collect()}
    n = len(PASSAGE.split())
    assert got == {1: (n, 1), 2: (n, 1), 3: (0, 0)}


def test_lines(docs, long_text):
    got = {r.doc_id: (r.n_lines, r.n_deleted, r.longest_run) for r in line_dedup.deduplicated(docs).collect()}
    n = long_text.count("\n") + 1
    assert got == {1: (n, 0, n), 2: (n, n, n), 3: (1, 0, 0)}


def test_near_duplicates(docs):
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_passages(docs, long_text):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.deduplicated(docs).collect()}
    n = len(long_text.split())
    assert got == {1: (n, 0), 2: (n, n), 3: (14, 0)}


def test_packing(docs, long_text):
    want = len(encode(long_text)) // 2 + 1
    tokens = {}
    for row in packing.packed(docs).collect():
        for doc_id, size in zip(row.doc_ids, np.diff(row.cu_seqlens)):
            tokens[doc_id] = tokens.get(doc_id, 0) + int(size)
    assert tokens[1] == tokens[2] == want
