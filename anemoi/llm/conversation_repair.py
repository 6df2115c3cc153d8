"""Repair of conversation structure: the cheapest edits that leave system?, (user, assistant)*.

Secondary-sorted streaming: rows are partitioned by conversation and sorted by turn, and one
pass over the Arrow batches of a partition carries a dynamic program. Its state is one of four
(nothing kept yet, after system, after user, after assistant); for each it holds the least cost,
the rank of its edit string among the four, and a running SHA-256 of the repaired text, so no
text is kept or read again. Which edits led to a state is one byte per row and state. These
backpointers are traced in chunks of CHUNK rows for each of the four states a chunk may end in;
a giant conversation emits its chunks as it goes, and a fold over them picks the right trace.
A task so holds one batch, one chunk and four states, however long a conversation is.

Ties: among the cheapest edits the ASCII-least string of initials. Strings that reach one state
after the same row with equal cost are never prefixes of each other (the longer one would have
paid for more inserts), so a rank per state and the new letters decide. The state "nothing kept"
is given up when "after assistant" costs four less, "after system" when it costs more: whatever
can follow them can follow "after assistant" for so much at most. Relative costs are thus bounded
and every step is looked up.

Repeats are found before the stream by a join on (conversation, hashes of role and text), so a
giant conversation needs no set of what was seen. Two 64-bit hashes stand for role and text.

Defined results: null role or text is one space, which the damage and the hashes see as such.
Rows of one conversation go by turn, nulls first, then by role and text; equal rows lie side by
side, the later ones are duplicates. A null conversation id is a conversation of its own. An
empty table gives no rows; extra columns are ignored; ids and turns are integers.
"""

from __future__ import annotations

import functools
import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemoi.llm.common import ship, table

CHUNK = 4096           # rows per traced chunk

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)          # the state after the next user or assistant row
NAMES = (None, "system", "user", "assistant")
DELETE, KEEP, REROLE = range(3)
LETTERS = "DKR"
COST = {"D": 4, "R": 3, "I": 3, "truncated": 3}
TAIL = (0, 2, 1, 0)                           # inserts that end a conversation in each state
SPACE = " \t\n\x0b\x0c\r"

STREAM = ("conv string, chunk long, starts array<int>, plans array<string>, end int, gaps long, blank long, "
          "duplicate long, truncated long, illegal long, cost long, repaired_sha256 string")


@functools.cache
def step(costs: tuple, ranks: tuple, initial: str, must_delete: bool, truncated: bool) -> tuple:
    """One row: costs relative to the least (None: unreachable) and ranks of the four states ->
    (costs, ranks, what the least grew by, per state (pred, inserts, edit) or None)."""
    best: list = [None] * 4
    more = COST["truncated"] if truncated else 0
    for s, cost in enumerate(costs):
        if cost is None:
            continue
        at = s
        for inserts in range(3):
            moves = [(at, COST["D"], DELETE)]
            if not must_delete:
                if initial == "s" and at == START:
                    moves.append((SYSTEM, more, KEEP))
                if initial == NAMES[NEXT[at]][0]:
                    moves.append((NEXT[at], more, KEEP))
                moves.append((NEXT[at], COST["R"] + more, REROLE))
            for to, paid, edit in moves:
                found = (cost + COST["I"] * inserts + paid, ranks[s], "I" * inserts + LETTERS[edit], s, inserts, edit)
                if best[to] is None or found < best[to]:
                    best[to] = found
            at = NEXT[at]
    a = best[ASSISTANT][0]
    if best[START] and best[START][0] > a + COST["D"]:
        best[START] = None
    if best[SYSTEM] and best[SYSTEM][0] > a:
        best[SYSTEM] = None
    least = min(b[0] for b in best if b)
    order = sorted((b[1], b[2], s) for s, b in enumerate(best) if b)
    rank = {s: i for i, (_, _, s) in enumerate(order)}
    return (tuple(b and b[0] - least for b in best), tuple(rank.get(s) for s in range(4)), least,
            tuple(b and b[3:] for b in best))


def inserted(state: int, n: int) -> list[int]:
    """The states of ``n`` inserted rows after ``state``."""
    out = []
    for _ in range(n):
        state = NEXT[state]
        out.append(state)
    return out


def code(pred: int, inserts: int, edit: int) -> str:
    """One printable character per row: inserts before it, its edit, the state before both."""
    return chr(48 + pred + 4 * inserts + 16 * edit)


class Conversation:
    """The stream's state inside one conversation."""

    def __init__(self, conv: str | None):
        self.conv = conv
        self.costs: tuple = (0, None, None, None)
        self.ranks: tuple = (0, None, None, None)
        self.base = 0
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.back: list[tuple] = []
        self.chunk = 0
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None
        self.last: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, later: bool) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        body = text.rstrip(SPACE)
        blank = not body
        duplicate = not blank and (later or self.last == (turn, role, text))
        truncated = not blank and not duplicate and body[-1] not in ".!?"
        self.last = (turn, role, text)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        self.costs, self.ranks, grown, moves = step(self.costs, self.ranks, initial if initial in "sua" else "",
                                                    blank or duplicate, truncated)
        self.base += grown
        self.hashes = [m and self._hashed(to, *m, role, text) for to, m in enumerate(moves)]
        self.back.append(moves)

    def _hashed(self, to: int, pred: int, inserts: int, edit: int, role: str = "", text: str = ""):
        """The hash of the best rows up to state ``to``: those of ``pred`` and what this row adds."""
        h, before = self.hashes[pred].copy(), pred
        rows = [(s, NAMES[s], "") for s in inserted(pred, inserts)]
        if edit != DELETE:
            rows.append((to, role if edit == KEEP else NAMES[to], text))
        for state, name, body in rows:
            h.update(f"{'' if before == START else chr(10)}{name}:{body}".encode())
            before = state
        return h

    def traced(self) -> tuple:
        """(conv, chunk, the states before the chunk, the codes of its rows), per state after it."""
        starts, plans = [], []
        for end in range(4):
            state, out = end, []
            for moves in reversed(self.back):
                if moves[state] is None:
                    out = None
                    break
                out.append(code(*moves[state]))
                state = moves[state][0]
            starts.append(-1 if out is None else state)
            plans.append(None if out is None else "".join(reversed(out)))
        row = (self.conv, self.chunk, starts, plans)
        self.back, self.chunk = [], self.chunk + 1
        return row

    def finish(self) -> tuple:
        cost, _, end = min((c + COST["I"] * TAIL[s], self.ranks[s], s) for s, c in enumerate(self.costs) if c is not None)
        h = self._hashed(end, end, TAIL[end], DELETE)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (*self.traced(), end, min(gaps, 2 ** 63 - 1), self.blank, self.duplicate, self.truncated, self.illegal,
                self.base + cost, h.hexdigest())


def _streamed(batches):
    now = None
    names = [c.split()[0] for c in STREAM.split(", ")]
    for batch in batches:
        out = []
        for conv, known, turn, role, text, gone, later in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    out.append(now.finish())
                now = Conversation(conv)
            if not gone:
                now.add(turn if known else None, role, text, later)
                if len(now.back) >= CHUNK:
                    out.append(now.traced() + (None,) * 8)
        if out:
            yield pd.DataFrame(out, columns=names).astype({c: "Int64" for c in names[4:11]})
    if now is not None:
        yield pd.DataFrame([now.finish()], columns=names).astype({c: "Int64" for c in names[4:11]})


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    return rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                       (F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)).alias("gone"))


def _with_later(rows: DataFrame) -> DataFrame:
    """``later``: the same role and text stand in the conversation at an earlier turn."""
    rows = rows.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64("text", F.lit("#"), "role"))
    first = (rows.where(~F.col("gone")).groupBy("conv", "h1", "h2")
             .agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unplaced"))
             .where(F.col("n") > 1).withColumnsRenamed({c: f"r_{c}" for c in ("conv", "h1", "h2")}))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in ("conv", "h1", "h2")]
    later = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first")))
    return (rows.join(first, functools.reduce(Column.__and__, same), "left")
            .select("conv", "turn", "role", "text", "gone", F.coalesce(later, F.lit(False)).alias("later")))


def plans(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """One row per conversation: its faults, the least cost, the edits' initials, the hash of the
    repaired text, and ``pieces``: one code per row, CHUNK to a piece (see :func:`repaired`).
    Rows flagged in ``gone_col`` only name their conversation."""
    ship(rows.sparkSession)
    kind = rows.schema[conv_col].dataType
    r = _with_later(_rows(rows, conv_col, turn_col, role_col, text_col, gone_col))
    stream = (r.repartition("conv")
              .sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
              .select(F.col("conv").cast("string"), F.col("turn").isNotNull().alias("known"),
                      F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", "gone", "later")
              .mapInPandas(_streamed, STREAM))
    values = [c.split()[0] for c in STREAM.split(", ")][4:]
    per = stream.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "starts", "plans")), asc=False).alias("parts"),
        *[F.max(c).alias(c) for c in values])
    fold = F.aggregate("parts", F.struct(F.col("end").alias("state"), F.array().cast("array<string>").alias("pieces")),
                       lambda acc, p: F.struct(p["starts"][acc["state"]].alias("state"),
                                               F.concat(F.array(p["plans"][acc["state"]]), acc["pieces"]).alias("pieces")),
                       lambda acc: acc["pieces"])
    audit = _audit(F.array_join(F.col("pieces"), ""), F.element_at(F.array(*map(F.lit, TAIL)), F.col("end") + 1))
    return per.withColumn("pieces", fold).select(
        F.col("conv").cast(kind).alias(conv_col), *values[1:-1], audit.alias("audit"), "repaired_sha256", "pieces", "end")


def _audit(codes: Column, tail: Column) -> Column:
    every = [(p, i, e) for p in range(4) for i in range(3) for e in range(3)]
    for n in (1, 2):
        some = "".join("\\" + code(p, i, e) if not code(p, i, e).isalnum() else code(p, i, e) for p, i, e in every if i == n)
        codes = F.regexp_replace(codes, f"([{some}])", "+" * n + "$1")
    letters = F.translate(codes, "".join(code(*x) for x in every) + "+", "".join(LETTERS[e] for _, _, e in every) + "I")
    return F.concat(letters, F.element_at(F.array(F.lit(""), F.lit("I"), F.lit("II")), tail + 1))


def repaired(rows: DataFrame, plan: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """The repaired conversations, a row each: (conv, row_no, part) is the order, ``edit`` K, R or I."""
    live = _rows(rows, conv_col, turn_col, role_col, text_col, gone_col).where(~F.col("gone"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    live = live.withColumn("row_no", F.row_number().over(order).cast("long") - 1)
    pieces = plan.select(F.col(conv_col).alias("p_conv"), F.posexplode("pieces").alias("p_chunk", "piece"))
    j = live.join(pieces, F.col("conv").eqNullSafe(F.col("p_conv"))
                  & (F.floor(F.col("row_no") / CHUNK) == F.col("p_chunk")))
    value = F.ascii(F.expr(f"substring(piece, cast(row_no % {CHUNK} as int) + 1, 1)")) - 48
    edit, inserts, pred = (F.floor(value / 16).cast("int"), F.floor(value / 4).cast("int") % 4, value % 4)
    entry = lambda part, role, text, letter: F.struct(
        part.cast("int").alias("part"), role.alias("role"), text.alias("text"), letter.alias("edit"))
    names = [[NAMES[s] for s in inserted(p, i)] for p in range(4) for i in range(3)]
    after = [NAMES[NEXT[([p] + inserted(p, i))[-1]]] for p in range(4) for i in range(3)]
    at = pred * 3 + inserts + 1
    new = F.element_at(F.array(*[F.array(*map(F.lit, n)).cast("array<string>") for n in names]), at)
    own = entry(F.lit(9), F.when(edit == KEEP, F.col("role")).otherwise(F.element_at(F.array(*map(F.lit, after)), at)),
                F.col("text"), F.when(edit == KEEP, F.lit("K")).otherwise(F.lit("R")))
    added = F.transform(new, lambda role, i: entry(i, role, F.lit(""), F.lit("I")))
    out = (j.select(F.col("conv").alias(conv_col), "row_no",
                    F.explode(F.concat(added, F.when(edit == DELETE, F.array().cast(_ENTRY)).otherwise(F.array(own)))).alias("e"))
           .select(conv_col, "row_no", "e.*"))
    tails = F.array(*[F.array(*[F.lit(NAMES[s]) for s in inserted(p, TAIL[p])]).cast("array<string>") for p in range(4)])
    end = (plan.select(conv_col, F.lit((1 << 63) - 1).alias("row_no"),
                       F.posexplode(F.element_at(tails, F.col("end") + 1)).alias("part", "role"))
           .select(conv_col, "row_no", "part", "role", F.lit("").alias("text"), F.lit("I").alias("edit")))
    return out.unionByName(end)


_ENTRY = "array<struct<part:int,role:string,text:string,edit:string>>"


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations damaged by a checksum of id and turn: dropped (flagged ``gone``), emptied,
    stripped of sentence ends, repeated, made user rows."""
    null = F.lit(" ")
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), null) for c in ("conv_id", "turn")])
    kind, text = F.crc32(place.cast("binary")) % 20, F.coalesce("text", null)
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", null)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


def op12_conversation_repair(spark, sf_dir):
    """Damaged conversations and their cheapest repair."""
    return plans(damaged(table(spark, sf_dir, "conversations")), gone_col="gone").drop("pieces", "end")
