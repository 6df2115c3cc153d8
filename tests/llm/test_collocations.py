"""Collocations against brute force: shards, index, scores, hot phrases, awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from anemoi.llm import collocations as co
from tests.llm.corpus import SCHEMA, corpus, lower


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, min_count, top):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for size in (1, 2, 3):
                f.update((lang, tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, g), a in cand.items():
        if len(g) == 2 and any(100 * b >= 50 * a for (la, h), b in cand.items()
                               if la == lang and len(h) == 3 and g in (h[:2], h[1:])):
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    want = []
    for lang in n:
        for rank, (_, s, a, p, x, y) in enumerate(sorted(o for o in out if o[0] == lang)[:top], 1):
            want.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return sorted(want)


def rows(seed=2, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "zz", "ZZ", "b c", "a\x00"]
    out = []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(0, 80))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " \r\x0b"]) for w in words)
        out.append((i, text + rng.choice(["", "new york city ", "new york city, new york city"]), rng.choice(["en", "en", "de", None, "und"]),
                    "s", 0, "r", "k", "s"))
    return out + [(None, None, "en", None, 0, None, None, None), (1, "", "xx", "", 0, "", "", ""), (2, "x " * 5000, "en", "", 0, "", "", "")]


def result(spark, data, **kw):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return sorted(map(tuple, co.collocations(df, **kw).collect()))


def test_against_brute_force(spark):
    data = rows()
    assert result(spark, data) == brute(data, 10, 2000)
    data = [r for r in data if r[2] == "en"]
    assert result(spark, data, min_count=3, top=7) == brute(data, 3, 7)


def test_awkward_corpus(spark):
    data = corpus()
    assert result(spark, data, min_count=2) == brute(data, 2, 2000)


def test_empty(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None, None, None, 0, "", "", "")]) == []


def test_buckets_and_long_texts(spark):
    """A text of several MB without a separator, and many buckets."""
    rng = random.Random(4)
    text = " ".join(f"v{rng.randrange(400)}" for _ in range(900_000))
    data = [(1, text, "en", "", 0, "", "", ""), (2, text[: 10 ** 6], "en", "", 0, "", "", "")]
    got = result(spark, data)
    assert len(text) > 2 * co.CHUNK - 10 ** 6 and got == brute(data, 10, 2000)


@pytest.mark.parametrize("seed", range(6))
def test_index_extends_both_ways(seed):
    rng = np.random.default_rng(seed)
    text = np.append(rng.integers(0, 5, 300), 0).astype(np.int32)
    index = co.Index(text)

    def table(lo, hi, words):
        return {tuple(int(x) for x in w): int(h - l) for l, h, w in zip(lo, hi, words.T)}

    def counted(size):
        spans = [tuple(int(x) for x in text[i:i + size]) for i in range(len(text) - size + 1)]
        return dict(Counter(s for s in spans if 0 not in s))

    one = index.words()
    two, also = index.left(*one), index.right(*one)
    assert table(*one) == counted(1)
    assert table(*two) == counted(2) == table(*also)
    three = index.left(*two), index.right(*two)
    assert table(*three[0]) == counted(3) == table(*three[1])


def test_chunks_join_to_the_whole(monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 7)
    rng = random.Random(1)
    for _ in range(300):
        data = "".join(rng.choices("ab \n", k=rng.randint(0, 60))).encode() + b"\n"
        got = list(co.chunks(data))
        assert b"".join(got) == data
        whole, parts = co.Shard(), co.Shard()
        whole.add(data)
        for part in got:
            parts.add(part)
        strip = [np.concatenate(s.ids) if s.ids else np.zeros(0) for s in (whole, parts)]
        words = [[k for k in s if k not in (b"", b"\n")] for s in (whole, parts)]
        squeezed = [x[(x != 0) | np.concatenate([[True], x[:-1] != 0])] if len(x) else x for x in strip]
        assert words[0] == words[1] and np.array_equal(*squeezed)
