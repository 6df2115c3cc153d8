"""Packing documents into sequences of at most LENGTH tokens by a configuration linear program.

Documents are encoded, ended by END and, where longer than a sequence, cut into full pieces and a
rest. All that packing needs is how often each length occurs: a histogram of at most LENGTH rows.
Its linear program has a variable per configuration (a multiset of lengths that fits a sequence)
and asks that every length be covered as often as it occurs, by as few sequences as possible.

Multiplicative weights solve it. Every length has a weight, at first its share of the tokens; its
price is weight / need. The best configuration for given prices is an unbounded knapsack, a
dynamic program over the places of a sequence. A round spreads its share of the sequences over
configurations that are as good, or nearly, as the best, always going on with the lengths covered
least, never beyond their need; then the weights of lengths covered above average fall and the
others rise, and the knapsack is solved for the new prices. ``bound`` is what duality proves:
need . price / best price is at most the optimum, whatever the prices. Unless a pass ends at the
bound, the whole need is covered again from the learnt weights, and the better result stays.

Rounding: every variable is cut to a whole number; what it left uncovered goes, longest first, by
best fit into the free places and into new sequences, by counts of equal sequences, not one by one.

The plan is a table of (length, ranks) -> (sequences, offset); its size depends on LENGTH, not on
the documents. Pieces get their rank by a range-partitioned row number and look their place up.

Defined results: a null or empty text is END alone; repeated rows are packed each (``uid`` tells
them apart); null ids stay null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import struct
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import numbered, saved, ship, table

LENGTH = 4096
END = 1                # the id after every document
ROUNDS = 48
RATES = (0.1, 0.1, 0.03)   # steps of the weights, a pass each
SLACK = 1e-3           # a configuration this near the best price is as good
CACHED = 400_000       # words a worker remembers
BATCH_BYTES = 1 << 23  # bytes of text encoded at once

PIECES = "uid long, doc_id long, piece int, start long, length int, ids binary"

def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# lower-case letters that the vocabulary's normaliser and splitter leave as one unchanged word
_PLAIN = "a-zß-öø-ÿ"
_plain = re.compile(f"[{_PLAIN}]{{1,64}}").fullmatch


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """(tokenizer, its letters for plain ones, ids of known words)"""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True     # their strings in a text are ordinary text
    letters = [chr(c) for c in range(97, 256) if _plain(chr(c))]
    return t, str.maketrans({c: t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}), {}


def _known(words: list[str], path: str) -> list[bytes]:
    """The ids of distinct words, each encoded once while a worker remembers it. A plain word
    needs no normaliser or splitter and goes to the merges at once."""
    tokenizer, letters, known = _tokenizer(path)
    merge, slow = tokenizer.model.tokenize, []
    for word in words:
        if word not in known:
            if _plain(word):
                ids = [t.id for t in merge(word.translate(letters))]
                known[word] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                slow.append(word)
    for lo in range(0, len(slow), 50_000):
        some = slow[lo:lo + 50_000]
        for word, e in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
            known[word] = struct.pack(f"<{len(e.ids)}I", *e.ids)
    out = list(map(known.__getitem__, words))
    for word in slow:
        if len(word) > 64:             # rare and large: not worth remembering
            del known[word]
    if len(known) > CACHED:            # the words met first are the common ones
        for word in list(known)[CACHED // 2:]:
            del known[word]
    return out


def encode_all(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch of texts and where each text's ids end.

    The vocabulary drops white space, joins nothing across it, lower-cases, and parts letters
    from punctuation; so a text is the ids of its words after A-Z are lowered and a space is put
    between a letter and a sentence mark, split at ASCII white space."""
    texts = pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))
    lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, f"([{_PLAIN}])([.,;:!?])", r"\1 \2"))
    words = lists.flatten().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    ids = _known(words.dictionary.to_numpy(zero_copy_only=False).tolist(), path)
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    which = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = size[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat((np.cumsum(size) - size)[which] - (ends - n), n) + np.arange(total)
    in_words = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    return flat[at], np.concatenate([[0], ends])[in_words]


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary_path: str | None = None, end: int = END,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces with their ids (PIECES), saved."""
    path = vocabulary_path or vocabulary()
    last = end.to_bytes(4, "little")

    def grouped(batches):
        """Rows of about BATCH_BYTES together, whatever the batches."""
        held, size = [], 0
        for batch in batches:
            at = 0
            sizes = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < len(batch):
                before = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, before + BATCH_BYTES - size, side="right")))
                held.append(batch.slice(at, to - at))
                size += int(sizes[to - 1]) - before
                at = to
                if size >= BATCH_BYTES or at < len(batch):
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def cut(batches):
        uid = TaskContext.get().partitionId() << 40
        for held in grouped(batches):
            doc_ids = [x for b in held for x in b.column(0).to_pylist()]
            ids, ends = encode_all(pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held]), path)
            data, at, rows = ids.tobytes(), 0, []
            for doc_id, to in zip(doc_ids, (4 * ends).tolist(), strict=True):
                whole, at = data[at:to] + last, to
                for k, lo in enumerate(range(0, len(whole), 4 * length)):
                    part = whole[lo:lo + 4 * length]
                    rows.append((uid, doc_id, k, lo // 4, len(part) // 4, part))
                    uid += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds, strict=True)],
                                             names=[c.split()[0] for c in PIECES.split(", ")])

    ship(docs.sparkSession)
    return saved(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                 .mapInArrow(cut, PIECES), "pieces")


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """best[c]: the highest price of any number of lengths within c places."""
    best = np.zeros(capacity + 1)
    for c in range(int(lengths[0]), capacity + 1):
        n = np.searchsorted(lengths, c, side="right")
        best[c] = max(best[c - 1], (best[c - lengths[:n]] + prices[:n]).max())
    return best


def configuration(best, lengths, prices, open_, covered, slack: float) -> list[int] | None:
    """Numbers of lengths worth best[-1] but for ``slack`` of it, the least covered first."""
    c, out, lost, may = len(best) - 1, [], 0.0, slack * best[-1]
    while c >= lengths[0]:
        n = np.searchsorted(lengths, c, side="right")
        loss = best[c] - best[c - lengths[:n]] - prices[:n]
        good = np.flatnonzero(open_[:n] & (loss <= may - lost))
        if not len(good):
            # nothing left is worth its places: the rest stays free if that costs little
            return out if lost + best[c] <= may else None
        at = covered[good]
        i = int(good[len(at) - 1 - np.argmin(at[::-1])])       # ties: the longest
        lost += max(0.0, float(loss[i]))
        out.append(i)
        c -= int(lengths[i])
    return out


def solve(lengths: np.ndarray, need: np.ndarray, capacity: int, rounds: int = ROUNDS, rates=RATES, slack: float = SLACK):
    """Per pass over the whole need (configuration as ascending numbers of lengths -> sequences, lower
    bound on sequences); a pass starts with the weights that the one before learnt."""
    need = need.astype(float)
    weight = lengths * need / (lengths @ need)
    bound = 0.0
    for rate in rates:
        covered, x = np.zeros(len(need)), {}         # covered: share of the need
        for r in range(rounds):
            open_ = covered < 1 - 1e-12
            if not open_.any():
                break
            prices = np.where(open_, weight / need, 0)
            best = knapsack(lengths, prices, capacity)
            bound = max(bound, float(need @ prices) / best[-1])
            before, place = covered.copy(), float(lengths @ (need * (1 - covered))) / capacity / (rounds - r)
            while place > 1e-9:
                found = configuration(best, lengths, prices, open_, covered, slack)
                if not found:
                    break
                which, n = np.unique(found, return_counts=True)
                amount = float(min((need[which] * (1 - covered[which]) / n).min(), max(place, 1.0)))
                covered[which] += amount * n / need[which]
                open_[which] = covered[which] < 1 - 1e-12
                place -= amount
                key = tuple(sorted(found))
                x[key] = x.get(key, 0.0) + amount
            gain, was_open = covered - before, before < 1 - 1e-12
            step = (1 - gain / max(gain[was_open].mean(), 1e-12)).clip(-1, 1)
            weight = np.where(was_open, weight * np.exp(rate * step), weight)
        yield x, bound


def best_fit(open_: dict[int, list], lengths: np.ndarray, need: np.ndarray, capacity: int) -> list[tuple]:
    """Sequences (count, contents) after the needs went, longest first, each into the fullest place
    that holds it. ``open_``: free places -> [(count, contents)]; contents: [(length, copies)]."""
    free = sorted(open_)
    at = lambda f: open_.setdefault(f, [])

    def put(f, count, contents):
        if count:
            if not at(f):
                insort(free, f)
            open_[f].append((count, contents))

    for length, k in sorted(zip(lengths.tolist(), need.tolist(), strict=True), reverse=True):
        while k:
            i = bisect_left(free, length)
            if i < len(free):
                f = free[i]
                count, contents = open_[f].pop()
                if not open_[f]:
                    free.pop(i)
            else:
                f, count, contents = capacity, k, []
            q = f // length
            full = min(count, k // q)
            put(f - full // max(full, 1) * q * length, full, contents + [(length, q)])
            k -= full * q
            count -= full
            rest = k if count and k < q else 0
            if rest:
                put(f - rest * length, 1, contents + [(length, rest)])
                k, count = 0, count - 1
            if f < capacity or contents:
                put(f, count, contents)
    return [(count, contents) for f in open_ for count, contents in open_[f]]


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple], float]:
    """([(sequences, [(length, copies)])], lower bound) that place every length as often as it occurs."""
    done = [(histogram[capacity], [(capacity, 1)])] if histogram.get(capacity) else []
    lengths = np.array(sorted(h for h in histogram if h < capacity and histogram[h]), dtype=np.int64)
    if not len(lengths):
        return done, float(sum(c for c, _ in done))
    need = np.array([histogram[int(h)] for h in lengths], dtype=np.int64)
    rounded, fewest = None, None
    for x, bound in solve(lengths, need, capacity, rounds):
        left, open_ = need.copy(), {}
        for config, amount in x.items():
            which, n = np.unique(config, return_counts=True)
            whole = int(min(int(amount + 1e-9), (left[which] // n).min()))
            if whole:
                left[which] -= whole * n
                contents = [(int(lengths[i]), int(k)) for i, k in zip(which, n, strict=True)]
                open_.setdefault(capacity - sum(h * k for h, k in contents), []).append((whole, contents))
        rows = best_fit(open_, lengths, left, capacity)
        used = sum(c for c, _ in rows)
        if fewest is None or used < fewest:
            rounded, fewest = rows, used
        if fewest < bound + 1:         # nothing can be better
            break
    return done + rounded, bound + sum(c for c, _ in done)


def places(sequences: list[tuple]) -> dict[str, np.ndarray]:
    """Where the pieces go, by row number over ascending lengths: from row ``first`` on, ``copies``
    pieces a sequence, from sequence ``sequence`` and place ``offset`` on."""
    rows, number = [], 0
    for count, contents in sequences:
        offset = 0
        for length, copies in contents:
            rows.append((length, count * copies, copies, number, offset))
            offset += length * copies
        number += count
    rows.sort(key=lambda r: r[0])
    length, pieces_, copies, sequence, offset = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
    return {"first": np.concatenate([[0], np.cumsum(pieces_)[:-1]]), "length": length, "copies": copies,
            "sequence": sequence, "offset": offset}


def placed(cut: DataFrame, length: int = LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """``cut`` without its ids, with ids_crc32, sequence_id and offset."""
    rows = numbered(cut.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")),
                    ["length", "uid"], "row_no")
    # at most ``length`` rows
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not histogram:
        return rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).drop("row_no")
    at = places(plan(histogram, length, rounds)[0])

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(row_no: pd.Series) -> pd.DataFrame:
        i = np.searchsorted(at["first"], row_no, side="right") - 1
        d = row_no.to_numpy() - at["first"][i]
        return pd.DataFrame({"sequence_id": at["sequence"][i] + d // at["copies"][i],
                             "offset": at["offset"][i] + d % at["copies"][i] * at["length"][i]})

    return rows.withColumn("at", place("row_no")).select("*", "at.sequence_id", "at.offset").drop("at", "row_no")


def packed(docs: DataFrame, length: int = LENGTH, vocabulary_path: str | None = None, end: int = END,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sequences: sequence_id, its ids (little-endian uint32), and per segment doc_id, start and offset."""
    cut = pieces(docs, length, vocabulary_path, end, id_col, text_col)
    segment = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    return (placed(cut, length).select("uid", "sequence_id", "offset").join(cut, "uid")
            .groupBy("sequence_id").agg(F.array_sort(F.collect_list(segment)).alias("s"))
            .select("sequence_id", F.expr("aggregate(s, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
                    F.col("s.offset").alias("offsets"), F.col("s.length").alias("lengths"),
                    F.col("s.doc_id").alias("doc_ids"), F.col("s.start").alias("starts")))


def op11_best_fit_packing(spark, sf_dir):
    """The pieces of all documents with their places; their ids stay in the saved pieces."""
    return placed(pieces(table(spark, sf_dir, "documents"))).select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset")
