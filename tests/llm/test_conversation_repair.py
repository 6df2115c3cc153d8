"""Conversation repair against exhaustive search, the damage, ties, nulls and giant conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from anemoi.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, cost string, gone string"
SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        place = ":".join(" " if x is None else str(x) for x in (conv, turn))
        k = zlib.crc32(place.encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if k == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def steps(row, fault):
    """Ways to treat one row: (cost, initial, the row left or None)."""
    _, role, text = row
    yield 4, "D", None
    if fault not in ("blank", "duplicate"):
        more = 3 if fault == "truncated" else 0
        yield more, "K", (role, text)
        for r in "ua":
            yield 3 + more, "R", (NAMES[r], text)


def cheapest(rows):
    """(cost, audit, rows left) by a forward search that keeps whole edit strings per role initials left."""
    fault = faults(rows)
    # by the last two role initials and whether the pattern still holds: all that can follow depends on them
    best = {"": (0, "", ())}

    def kept(best, state, cost, audit, left):
        if state not in best or (cost, audit) < best[state][:2]:
            best[state] = (cost, audit, left)

    def after(state, role):
        r = role[:1]
        if r == "s":
            return "s" if state == "" else None
        if r == "u":
            return "u" if state in ("", "s", "a") else None
        return "a" if r == "a" and state == "u" else None

    def with_inserts(best):
        for _ in range(3):
            for state, (cost, audit, left) in list(best.items()):
                for r in "ua":
                    to = after(state, r)
                    if to:
                        kept(best, to, cost + 3, audit + "I", (*left, (NAMES[r], "")))
        return best

    for row, f in zip(rows, fault):
        new = {}
        for state, (cost, audit, left) in with_inserts(best).items():
            for c, letter, row_left in steps(row, f):
                to = state if row_left is None else after(state, row_left[0])
                if to is not None:
                    kept(new, to, cost + c, audit + letter, left if row_left is None else (*left, row_left))
        best = new
    best = with_inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(rows):
    """All strings of edits with up to two inserts at every place."""
    fault, found = faults(rows), None
    gaps = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    options = []
    for row, f in zip(rows, fault):
        options.append([(c + 3 * len(g), "I" * len(g) + x, tuple((NAMES[r], "") for r in g) + ((left,) if left else ()))
                        for g in gaps for c, x, left in steps(row, f)])
    options.append([(3 * len(g), "I" * len(g), tuple((NAMES[r], "") for r in g)) for g in gaps])
    for pick in itertools.product(*options):
        left = tuple(x for p in pick for x in p[2])
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in left)):
            key = (sum(p[0] for p in pick), "".join(p[1] for p in pick), left)
            found = min(found, key) if found else key
    return found


def want(rows):
    out = {}
    for conv, kept in damage(rows).items():
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, left = cheapest(kept)
        f = faults(kept)
        pairs = zip(kept, kept[1:])
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: f.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()}
    return out


def random_rows(seed, convs, longest=14):
    rng = random.Random(seed)
    texts = ["Hi.", "What now?", "no end", "", " \n", "é!", "Fine.\t", "x", None, "long " * 40 + "."]
    rows = []
    for c in [*range(convs), None]:
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t * 2, None, 1])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            rows.append((c, turn, role, rng.choice(texts) if rng.random() < .5 else f"{t} {rng.random()}.", "x", "y"))
    rng.shuffle(rows)
    return rows


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: r.asDict() for r in cr.plans(cr.damaged(df), gone_col="gone").drop("pieces", "end").collect()}
    expected = want(rows)
    assert got.keys() == expected.keys()
    for conv, e in expected.items():
        assert got[conv] == {"conv_id": conv, **e}, conv


def test_cheapest_is_exhaustive():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b.", "c", "", f"{i}."]))
                for i in range(rng.randint(0, 3))]
        assert cheapest(rows) == exhaustive(rows), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_search(spark, seed):
    check(spark, random_rows(seed, 150))


def test_chunks_of_giant_conversations(spark, monkeypatch):
    """A conversation over many chunks: the code of small chunks, so that tracing and folding are exercised."""
    monkeypatch.setattr(cr, "CHUNK", 5)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"{t}.", "cut", f"{t}!"]), "", "")
            for t in range(203)]
    df = cr._rows(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text", None).toPandas()
    now = cr.Conversation("7")
    chunks = []
    for turn, role, text in zip(df.turn, df.role, df.text):
        now.add(int(turn), role, text, False)
        if len(now.back) >= 5:
            chunks.append(now.traced())
    chunks.append(now.finish())
    state, audit = chunks[-1][4], ""
    for c in reversed(chunks):
        audit, state = c[3][state] + audit, c[2][state]
    letters = "".join("I" * ((ord(x) - 48) // 4 % 4) + "DKR"[(ord(x) - 48) // 16] for x in audit)
    # repeats are marked by a join, which is not run here: only a row equal to the one before counts
    plain = list(zip(df.turn, df.role, df.text))
    assert len(audit) == 203 and state == cr.START
    cost = now.base + min(c + 3 * cr.TAIL[s] for s, c in enumerate(now.costs) if c is not None)
    assert cost == cost_of(letters + "I" * cr.TAIL[chunks[-1][4]], plain)


def cost_of(audit, rows):
    """The cost of an audit by following it, and that it leaves the pattern."""
    left, cost, at, last = "", 0, 0, None
    for letter in audit:
        if letter == "I":
            left += "a" if left.endswith("u") else "u"
            cost += 3
            continue
        _, role, text = rows[at]
        duplicate = last == rows[at]
        last, at = rows[at], at + 1
        if letter == "D":
            cost += 4
            continue
        assert text and not duplicate
        cost += 3 * (text[-1] not in ".!?") + 3 * (letter == "R")
        left += ("a" if left.endswith("u") else "u") if letter == "R" else role[0]
    assert at == len(rows) and re.fullmatch("(s?(ua)+)?", left)
    return cost


def test_giant_conversation(spark):
    rng = random.Random(9)
    rows = [(3, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"{t}.", "cut"]), "", "") for t in range(9001)]
    rows += [(4, t, "user", "x" * 3_000_000 + ".", "", "") for t in range(2)]
    check(spark, rows)


def test_repaired_rows_hash_to_the_plan(spark):
    rows = random_rows(4, 60)
    df = cr.damaged(spark.createDataFrame(rows, SCHEMA))
    plan = cr.plans(df, gone_col="gone").cache()
    left = {}
    for r in sorted(cr.repaired(df, plan, gone_col="gone").collect(), key=lambda r: (r.row_no, r.part)):
        left.setdefault(r.conv_id, []).append(r)
    for p in plan.collect():
        mine = left.get(p.conv_id, [])
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == p.repaired_sha256
        assert [r.edit for r in mine] == [x for x in p.audit if x != "D"]
    plan.unpersist()


def test_empty(spark):
    assert cr.plans(cr.damaged(spark.createDataFrame([], SCHEMA)), gone_col="gone").count() == 0
