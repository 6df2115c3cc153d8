"""Quality rules, mixing, sharding, personal data against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from anemoi.llm import mixing, pii, quality_rules, sharding
from tests.llm.corpus import SCHEMA, corpus, words


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def measures(text):
    t = text or ""
    w = words(t)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit)}


def test_ledger_measures_and_policies(docs, none):
    led = quality_rules.ledger(docs)
    got = sorted((r.asDict() for r in quality_rules.apply_policy(led).collect()), key=str)
    assert len(got) == len(corpus())
    want = []
    for r in corpus():
        m = measures(r[1])
        n = m["n_words"]
        base = n < 10 or 100 * m["n_repeat_words"] > 20 * n
        fails = [n < 10, 100 * m["n_repeat_words"] > 20 * n, 100 * m["n_symbols"] > 30 * n,
                 100 * m["n_dup_lines"] > 40 * m["n_lines"], m["word_chars"] < 2 * n, m["word_chars"] > 25 * n]
        want.append({"doc_id": r[0], **m, "failed_bits": sum(1 << i for i, f in enumerate(fails) if f),
                     "base_failed": base, "kept": not any(fails), "policy": "v1"})
    assert got == sorted(want, key=str)
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(w["kept"] for w in want)
    assert quality_rules.ledger(none).count() == 0 and quality_rules.filter_documents(none).count() == 0
    abl = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablation(led).collect()}
    for i, (name, _) in enumerate(quality_rules.RULES):
        assert abl[name] == (sum(w["failed_bits"] >> i & 1 for w in want), sum(w["failed_bits"] == 1 << i for w in want))


def test_mix_meets_targets(docs, none):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == len(corpus())
    sizes = defaultdict(int)
    for r in corpus():
        sizes[r[3]] += len(words(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, target, total = set(order), {}, sum(sizes.values())
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    target |= {s: weight[s] * level for s in free}
    by_size = {sizes[s]: s for s in order}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = by_size[r.source_size]
        assert r.target == pytest.approx(target[s], rel=1e-12)
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mixed(none).count() == 0
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    assert out.agg(F.sum(F.size(F.expr(r"filter(split(text, '[ \t-\r]+'), x -> x <> '')")))).first()[0] == sum(taken.values())


def test_mix_without_words(spark):
    d = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mixed(d).collect()] == [(0.0, 0), (0.0, 0)]


def test_newton_solves_the_dual(spark):
    t = spark.createDataFrame([(10, 1e-3), (10, 29.0), (7, 7.0), (0, 0.0), (5, 0.0)], "source_size long, target double")
    rates = [r.rate for r in mixing.balanced_rates(t).collect()]
    assert rates == pytest.approx([1e-4, 2.9, 1.0, 0.0, 0.0], rel=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 1 << 40))
def test_permutation_is_a_bijection(total, seed):
    p = sharding.permute(np.arange(total), total, seed)
    assert np.array_equal(np.sort(p), np.arange(total))
    assert np.array_equal(sharding.permute(p, total, seed, back=True), np.arange(total))


def test_shards(docs, none):
    rows = sharding.sharded(docs).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in corpus())
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    # computable: the row number alone gives shard and slot, and back
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32))
    shard, slot = sharding.place(np.arange(len(order)), len(order))
    assert [(r.shard, r.slot) for r in order if order.count(r) == 1] and Counter(
        (r.doc_id, r.text_crc32) for r in rows) == Counter((r.doc_id, r.text_crc32) for r in order)
    key = lambda r: (r.doc_id, r["size"], r.text_crc32)
    alone = Counter(map(key, rows))
    assert all((r.shard, r.slot) == (shard[i], slot[i]) for i, r in enumerate(order) if alone[key(r)] == 1)
    assert np.array_equal(sharding.row_at(shard, slot, len(order)), np.arange(len(order)))
    assert sorted(map(str, sharding.sharded(docs.repartition(7)).collect())) == sorted(map(str, rows))
    assert sharding.sharded(none).count() == 0
    full = sharding.shard_documents(docs)
    assert set(full.columns) == {*docs.columns, "slot"} and full.count() == len(rows)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(BASE.items()):
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


PIECES = st.sampled_from(["a", "Z9", "@", "@a.b", "x@y.de", ".", "1", "255", "256", "0012", "1.2.3.4", "1.2.3.4.5", "-", " ", "+", "(", ")",
                          "4111 1111 1111 1111", "5500-0000-0000-0004", "+1 (555) 123-4567", "+49 30 901820", "é", "\n", "_%+",
                          "6011000990139424", "79927398713", "DE89370400440532013000", "iban ", "ssn 123-45-6789", "tel 555-123-4567"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    got = [f"{k}:{a}:{b}" for k, a, b, _ in pii.find(text) if k in pii.BASE_KINDS]
    assert got == base_spans(text)


def test_added_kinds_need_evidence():
    kinds = lambda t: [k for k, *_ in pii.find(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 please") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 please") == []
    assert kinds("the SSN is 123-45-6789.") == ["ssn"] and kinds("part 123-45-6789.") == []
    assert kinds("the SSN is 000-45-6789.") == []
    assert kinds("call 555-123-4567 now") == ["local_phone"] and kinds("no 555-123-4567 now") == []
    assert pii.redacted("mail a@b.de now") == "mail [email] now" and pii.redacted(None) is None


def test_iban_before_capitals_and_digits():
    ibans = lambda t: [t[a:b] for k, a, b, _ in pii.find(t) if k == "iban"]
    plain, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for iban in (plain, spaced):
        for after in (" BIC COBADEFF", " I paid", " 12 May", " A 1 B 2 C 3", " please", ""):
            assert ibans(f"IBAN {iban}{after}") == [iban]
    # one that another start or number would take in
    assert ibans(f"IBAN AB12 {spaced} BIC") == [spaced]
    assert ibans("NO9386011117947 NO9386011117947") == ["NO9386011117947"] * 2
    # a country without a known length: the checksum alone
    assert pii.mod97("ZZ33123456789012345") and ibans("IBAN ZZ33 1234 5678 9012 345 BIC") == ["ZZ33 1234 5678 9012 345"]
    pii.find("AA11 " * 20_000)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" * 150_000, "1 " * 150_000, "@a.b" * 50_000):
        pii.find(text)


def test_pii_frame(spark, none):
    rows = [(1, "mail ab@cd.de or 4111 1111 1111 1111", "x"), (2, None, None), (2, "", None), (None, "é 1.2.3.4", None)]
    got = pii.spans(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert [[f"{s.kind}:{s.start}:{s.end}" for s in r.spans] for r in got] == [["email:5:13", "card:17:36"], [], [], ["ip:2:9"]]
    assert pii.spans(none).count() == 0
    assert [r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, x string")).collect()][0] == \
        "mail [email] or [card]"


def test_pii_query_digest(spark, tmp_path):
    spark.createDataFrame([(7, "a@b.de 1.2.3.4")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    r = pii.op1_pii(spark, str(tmp_path)).collect()[0]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.spans) == (1, 1, 0, 0, "email:0:6,ip:7:14")
    assert r.base_sha256 == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
