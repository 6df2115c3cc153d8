"""Near duplicates, repeated passages, repeated lines, decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from anemoi.llm import decontaminate, line_dedup, near_dup, substring_dedup
from anemoi.llm.components import components
from anemoi.llm.wordhash import CHUNK, window_hashes, word_hashes
from tests.llm.corpus import SCHEMA, corpus, lower, prose, words


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def closure(nodes, links):
    comp = {n: n for n in nodes}
    def top(n):
        while comp[n] != n:
            n = comp[n]
        return n
    for a, b in links:
        a, b = sorted((top(a), top(b)))
        comp[b] = a
    return {n: top(n) for n in nodes}


def shingle_set(text, width):
    w = words(lower(text))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def linked_components(rows, width, percent=80):
    sets = [(r[0], shingle_set(r[1], width)) for r in rows]
    named = [(d, s) for d, s in sets if d is not None and s]
    links = [(a, b) for i, (a, s) in enumerate(named) for b, t in named[:i]
             if 100 * len(s & t) >= percent * len(s | t)]
    return sets, closure({d for d, _ in sets if d is not None}, links)


def near_copies(n=150, seed=5):
    """A chain-like group: edits of one text, most pairs below the threshold, and bystanders."""
    rng = random.Random(seed)
    base = prose(rng, 140).split(" ")
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(len(w))] = rng.choice(base) + str(rng.randrange(9))
        rows.append((i + 10, " ".join(w)))
    rows += [(i, prose(rng, 100)) for i in range(10)]
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_components_of_near_duplicates(docs, width):
    got = near_dup.near_duplicates(docs, width).collect()
    sets, comp = linked_components(corpus(), width)
    want = Counter((d, len(s), comp.get(d), d is None or comp[d] == d) for d, s in sets)
    assert Counter(tuple(r) for r in got) == want
    out = near_dup.deduplicated(docs, width)
    assert out.columns == docs.columns
    assert out.count() == len({(r[0], r[1] or "") for r in corpus() if r[0] is None or comp[r[0]] == r[0]})


def test_each_text_of_a_repeated_id_goes_by_its_own_component(spark):
    t, u, v = (prose(random.Random(i), 60) for i in range(3))
    rows = [(1, t, "a"), (2, t, "b"), (2, u, "c"), (3, u, "d"), (3, u, "e"), (None, v, "f"), (None, v, "g"), (None, None, "h"), (9, "", "i")]
    left = [(r.doc_id, r.text) for r in near_dup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, k_text string")).collect()]
    assert sorted(left, key=repr) == sorted([(1, t), (2, u), (None, v), (None, None), (9, "")], key=repr)


def test_group_without_a_hub(spark, monkeypatch):
    rows = near_copies()
    monkeypatch.setattr(near_dup, "TILE_A", 7)
    monkeypatch.setattr(near_dup, "TILE_B", 11)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    _, comp = linked_components(rows, 4)
    assert got == comp
    assert len(set(comp.values())) > 12          # stragglers exist: the group is no star


def test_exact_round_follows_a_round_without_new_pairs(spark, monkeypatch):
    rows = near_copies(60)
    # as if all nearest partners had been tried as stars
    monkeypatch.setattr(near_dup, "NEAREST", 0)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == linked_components(rows, 4)[1]


def test_near_duplicates_of_nothing(none):
    assert near_dup.near_duplicates(none).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for j in (0.95, 0.8, 0.6):
        n = 4000
        common = int(2 * n * j / (1 + j))
        x = rng.integers(1, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:common], x[n:2 * n - common]]))
        odd = near_dup.odd_sketches(near_dup.minhashes([a, b]))
        got = near_dup.estimate(int(np.bitwise_count(odd[0] ^ odd[1]).sum()))
        assert abs(got - j) < 5 * (j * (1 - j) / near_dup.SAMPLES) ** 0.5 + 0.02


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 300)] + [(160, 7)]
    links += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)]
    rng.shuffle(links)
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure({x for p in links for x in p}, links)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(want[k] == k for k in want if k not in got)      # nodes with a link to themselves only
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    texts = ["", None, "a", " a b\tc\x0b", "xa", "é ü a", "a" * 5000, ("b a " * 10 + "\n") * 60_000, "w" * (3 * CHUNK) + " a"]
    h, off = word_hashes(pa.array(texts))
    assert list(np.diff(off)) == [len((t or "").encode().split()) for t in texts]
    a = h[off[2]]
    assert h[off[3]] == a and h[off[5] + 2] == a and h[off[8] + 1] == a and h[off[7] + 1] == a
    assert len(set(h[off[7]:off[8]].tolist())) == 2
    x, _ = word_hashes(pa.array(["A bÀ"]), lower=True)
    y, _ = word_hashes(pa.array(["a BÀ"]), lower=True)
    z, _ = word_hashes(pa.array(["a bà"]), lower=True)
    assert list(x) == list(y) and x[1] != z[1]
    w = window_hashes(h[off[7]:off[8]], 20)
    assert w[0] == w[20] and w[0] != w[1]
    assert len(word_hashes(pa.array([], pa.string()))[0]) == 0


def removed_words(rows, window):
    first = {}
    for d, t in rows:
        w = words(t)
        if d is not None:
            for i in range(len(w) - window + 1):
                g = tuple(w[i:i + window])
                first[g] = min(first.get(g, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = {i + j for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i:i + window])] < d
                for j in range(window)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [50, 7])
def test_repeated_passages(docs, none, window):
    got = substring_dedup.deduplicated(docs, window).collect()
    assert Counter(tuple(r) for r in got) == removed_words([(r[0], r[1]) for r in corpus()], window)
    assert substring_dedup.deduplicated(none, window).count() == 0


def test_repeated_passages_of_few_words(spark):
    """Texts over two words: everything repeats, windows tie for their anchor."""
    rng = random.Random(9)
    rows = [(rng.randrange(12), " ".join(rng.choice("ab") for _ in range(rng.randrange(40)))) for _ in range(40)]
    got = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
    assert Counter(tuple(r) for r in got) == removed_words(rows, 6)


def deleted_lines(rows, m):
    seqs, first = [], {}
    for d, t in rows:
        ls = (t or "").split("\n")
        seqs.append((d, t, ls, [i for i, x in enumerate(ls) if words(x)]))
    keyed = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    for k in keyed:
        ls = k[2].split("\n")
        s = [x for x in ls if words(x)]
        for p in range(len(s) - m + 1):
            first.setdefault(tuple(s[p:p + m]), (k, p))
    out = []
    for d, t, ls, at in seqs:
        k, s = (d is not None, d or 0, t or ""), [ls[i] for i in at]
        gone = {at[p + j] for p in range(len(s) - m + 1) if first[tuple(s[p:p + m])] != (k, p) for j in range(m)}
        out.append((d, len(at), len(gone), (t if not gone else "\n".join(x for i, x in enumerate(ls) if i not in gone))))
    return Counter(out)


@pytest.mark.parametrize("m", [1, 2, 3])
def test_repeated_lines(docs, none, m):
    rows = [(r[0], r[1]) for r in corpus() if not (r[0] is None and r[1] is None)]
    # ties of id are ordered by a hash; here ids with two texts share no lines, so the order can't matter
    got = line_dedup.deduplicated(docs, m).select("doc_id", "n_lines", "n_deleted", "text").collect()
    want = deleted_lines(rows, m)
    want[(None, 0, 0, None)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert line_dedup.deduplicated(none, m).count() == 0


def longest_repeated(texts, m):
    """Lines of each text's longest run that stands at another place too, by text."""
    seqs = [[x for x in t.split("\n") if words(x)] for t in texts]
    out = [0] * len(seqs)
    for n in range(m, max(map(len, seqs)) + 1):
        count = Counter(tuple(s[p:p + n]) for s in seqs for p in range(len(s) - n + 1))
        out = [n if any(count[tuple(s[p:p + n])] > 1 for p in range(len(s) - n + 1)) else x for s, x in zip(seqs, out)]
    return out


@pytest.mark.parametrize("m", [1, 2])
def test_longest_run(spark, m):
    rng = random.Random(12)
    pairs = ["\n".join(f"{i} {j}" for j in range(rng.randrange(1, 9))) for i in range(8)]
    texts = pairs * 2 + ["x\ny\nz"] * 5 + ["alone", "", "\n \n"]
    texts += ["\n".join(rng.choice("abcd") for _ in range(rng.randrange(1, 20))) for _ in range(10)]
    got = line_dedup.deduplicated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()
    assert {r.doc_id: r.longest_run for r in got} == dict(enumerate(longest_repeated(texts, m)))


def test_suffix_array_and_prefixes(spark):
    rng = random.Random(4)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in range(12)] + ["a\nb\nc"] * 3
    rows = [(i, t) for i, t in enumerate(texts)]
    lines = line_dedup.line_ids(spark.createDataFrame(rows, "doc_id long, text string"))
    ranks, rounds = line_dedup.suffix_ranks(lines)
    arr = sorted(line_dedup.common_prefixes(ranks, rounds).collect(), key=lambda r: r["rank"])
    suffix = {(i, p): t.split("\n")[p:] for i, t in rows for p in range(len(t.split("\n")))}
    assert len(arr) == len(suffix) and len({r["rank"] for r in arr}) == len(arr)
    for x, y in zip(arr, arr[1:]):
        a, b = suffix[x.k_id, x.p], suffix[y.k_id, y.p]
        n = next((i for i, (s, t) in enumerate(zip(a, b)) if s != t), min(len(a), len(b)))
        assert y.lcp == n
    # equal prefixes stand together: groups by any prefix are contiguous
    for k in (1, 2, 4):
        seen, last = set(), None
        for r in arr:
            g = tuple(suffix[r.k_id, r.p][:k])
            assert g == last or g not in seen or len(g) < k
            seen.add(g)
            last = g
    late = line_dedup.later_copies(lines, 2).collect()
    assert defaultdict(int, Counter(r.k_id for r in late))[0] >= 0


def item_words(text):
    import re
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def test_decontamination(spark, docs, none):
    rows = corpus()
    rng = random.Random(8)
    long_doc = max((r[1] for r in rows if r[1]), key=len)
    w = item_words(long_doc)
    items = [(1, " ".join(w[100:140])), (2, "- ".join(w[130:141]).upper()), (3, " ".join(w[50:59])), (4, " ".join(w[7:9])),
             (5, w[33]), (6, prose(rng, 40)), (7, None), (8, "..."), (None, " ".join(w[100:140])), (9, " ".join(w[100:140])),
             (10, "Über, straße? Été"), (11, " ".join(["x"] * 12))]
    grams = Counter(tuple(x[i:i + 10]) for r in rows for x in [item_words(r[1] or "")] for i in range(len(x) - 9)
                    if len(set(x[i:i + 10])) > 5)
    items.append((12, " ".join(grams.most_common(1)[0][0])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = defaultdict(set)
    for i, t in items:
        x = item_words(t or "")
        if i is not None and x:
            for s in range(max(1, len(x) - 9)):
                wins[tuple(x[s:s + 10])].add(i)
    want = Counter()
    for r in rows:
        x, hit, ids = item_words(r[1] or ""), set(), set()
        for g, owners in wins.items():
            for s in range(len(x) - len(g) + 1):
                if x[s] == g[0] and tuple(x[s:s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    ids |= owners
        text = ",".join(sorted(map(str, ids)))
        want[(r[0], len(x), len(hit), len(ids), hashlib.sha256(text.encode()).hexdigest(), bool(hit))] += 1
    got = decontaminate.contaminated(docs, bench).drop("k_id", "k_text").collect()
    assert Counter(tuple(r) for r in got) == want
    assert sum(n for k, n in want.items() if k[5]) > 5
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for k, n in want.items() if not k[5])
    assert decontaminate.contaminated(none, bench).count() == 0
    empty = decontaminate.contaminated(docs, bench.limit(0))
    assert empty.count() == len(rows) and not empty.where("contaminated").count()


def test_items_without_an_id_contaminate(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j y"), (2, "k l m n")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "A b c d e f g h i j"), (5, "zz")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contaminated(docs, bench).collect()}
    none = hashlib.sha256(b"").hexdigest()
    assert got == {1: (10, 0, none, True), 2: (0, 0, none, False)}
    assert [r.doc_id for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_decontamination_without_broadcast(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, next(r[1] for r in corpus() if r[1] and len(r[1]) > 2000))], "item_id long, text string")
    want = sorted(map(str, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    assert sorted(map(str, decontaminate.contaminated(docs, bench).collect())) == want


def test_partners_by_lowest_hashes(monkeypatch):
    rng = np.random.default_rng(6)
    pool = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(40)]
    sets += [np.unique(np.concatenate([sets[i], rng.choice(pool, 8)])) for i in range(40)]
    x = sets[0]
    sizes, comps = np.array([len(s) for s in sets]), np.arange(len(sets))
    true = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(x, s)) >= 80 * len(np.union1d(x, s))}
    assert {0, 40} <= true
    assert set(near_dup.partners(x, len(x), sets, sizes, comps, 80).tolist()) == true
    # one of each component is enough
    assert len(near_dup.partners(x, len(x), sets, sizes, np.zeros(len(sets)), 80)) == 1
    # sets beyond the limit are estimated: no true partner is lost
    monkeypatch.setattr(near_dup, "LOW", 64)
    low = [s[:64] for s in sets]
    assert true <= set(near_dup.partners(low[0], len(x), low, sizes, comps, 80).tolist())
