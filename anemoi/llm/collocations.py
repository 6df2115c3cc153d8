"""Phrase collocations: exact n-gram counts from an FM-index per shard, summed across shards.

A task cuts its documents into shards of one language and about SHARD words, with a vocabulary
of its own; a shard ends where a piece of text ends, so no phrase is cut. Word counts are summed
first. A phrase is no more frequent than its words, so words below the least count only part
phrases from here on; the others get a global number, which each shard looks up by a join.

The index of a shard is the Burrows-Wheeler transform of its word numbers with rows sorted to
DEPTH words, so an interval of rows is a phrase of up to DEPTH words and its size the count.
Intervals are extended in both directions, all at once: to the left by the transform's last-to-
first mapping, to the right by the words that follow inside an interval. Pairs come from words
extended left, triples from pairs extended right, each with its count.

The counts go to buckets by a hash of the whole phrase, as compressed arrays, so the commonest
phrase is one entry per shard, never a hot key. A bucket holds the phrases of about BUCKET words
of the corpus (their number follows the corpus), sums equal phrases and keeps the frequent ones.
Scores are joins on word numbers in decimals of 38 digits; the best rows per language are taken
in two steps, so no language is sorted in one task.

Memory of a task: the open shards (HELD words together, however many languages), one index, one
bucket. A piece without any separator longer than a shard makes a longer shard.

Defined results: null texts are empty, a null language is ``und``; repeated rows count each; ties
in score and count go by the phrase in UTF-8 order; an empty table gives no rows; extra columns
are ignored. Up to 2^32 frequent words and counts up to 10^13.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemoi.llm.common import numbered, saved, ship, table
from anemoi.llm.wordhash import mixed

DEPTH = 3
SHARD = 1 << 20        # words of a shard
HELD = 1 << 22         # words a task holds in open shards
BUCKET = 1 << 21       # words of the corpus to a bucket
CHUNK = 1 << 21        # bytes of a long text taken at once
MIN_COUNT = 10
TOP = 2000
COVERED = 50           # percent of a phrase's count that a longer candidate must reach to replace it
SALTS = 64

_END = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(string.ascii_uppercase.encode() + _END + b"\t",
                        string.ascii_lowercase.encode() + b"\n" * len(_END) + b" ")

SHARDS = "lang string, shard long, n_words long, words array<string>, counts array<long>, ids binary"
COUNTS = "bucket long, entries int, payload binary"
PHRASES = "w1 long, w2 long, w3 long, a long"


class Shard(dict):
    """Words -> numbers from 1 in order of appearance; 0 ends a piece."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})
        self.ids: list[np.ndarray] = []
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) - 1
        return n

    def add(self, data: bytes) -> bool:
        """The words of folded bytes; whether they end a piece."""
        tokens = data.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
        ids = ids[ids >= 0]
        if len(ids):
            ids = ids[(ids != 0) | np.concatenate([[True], ids[:-1] != 0])]
            self.ids.append(ids)
            self.size += len(ids)
        return bool(len(ids)) and ids[-1] == 0

    def row(self, lang: str, shard: int) -> tuple:
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=len(self) - 1)[1:]
        words = [w.decode() for w in list(self)[2:]]
        return lang, shard, int(counts.sum()), words, counts, ids.astype("<i4").tobytes()


def chunks(data: bytes):
    """Long data cut at separators, else at spaces, into about CHUNK bytes."""
    at, n = 0, len(data)
    while at < n:
        end = at + CHUNK
        if end < n:
            cut = data.rfind(b"\n", at, end)
            if cut < 0:
                cut = data.rfind(b" ", at, end)
            if cut < 0:
                after = [x for x in (data.find(b"\n", end), data.find(b" ", end)) if x >= 0]
                cut = min(after) if after else n - 1
            end = cut + 1
        yield data[at:end]
        at = end


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds, strict=True)],
                                      names=[c.split()[0] for c in SHARDS.split(", ")])


def shards(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The corpus as numbered words: a row per shard (SHARDS), saved."""
    def cut(batches):
        part, made, held = TaskContext.get().partitionId() << 32, 0, 0
        open_shards: dict[str, Shard] = {}

        def close(lang):
            nonlocal made, held
            shard = open_shards.pop(lang)
            held -= shard.size
            made += 1
            return _batch([shard.row(lang, part + made)])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for data in chunks(text.as_py().encode("utf-8", "replace").translate(_FOLD) + b"\n"):
                    shard = open_shards.setdefault(lang, Shard())
                    held -= shard.size
                    ended = shard.add(data)
                    held += shard.size
                    if ended and shard.size >= SHARD:
                        yield close(lang)
                if held >= HELD:
                    yield close(max(open_shards, key=lambda k: open_shards[k].size))
        for lang in [k for k, s in open_shards.items() if s.size]:
            yield close(lang)

    ship(docs.sparkSession)
    return saved(docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
                 .where(F.col("text").isNotNull()).mapInArrow(cut, SHARDS), "shards")


def _order(symbols: np.ndarray) -> np.ndarray:
    """Stable order of symbols, as one sort of (symbol, place)."""
    bits = max(1, int(len(symbols) - 1).bit_length())
    return np.sort(symbols.astype(np.int64) << bits | np.arange(len(symbols))) & ((1 << bits) - 1)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins in any of the columns, and their length at the end."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(new))


class Index:
    """FM-index of word numbers (0 ends a piece) for phrases of up to DEPTH words.

    Rows are the places of the text sorted by DEPTH words. They come from the last-to-first
    mapping itself: sorting rows by the word before each and stepping there adds one word to
    the depth. An interval set is (lo, hi, words): phrase i is words[:, i], in rows lo[i]:hi[i].
    """

    def __init__(self, text: np.ndarray):
        self.text = text
        self.rows = _order(text)
        for _ in range(DEPTH - 1):
            self.rows = self.rows[_order(self.bwt)] - 1
            self.rows[self.rows < 0] += len(text)
        self.first = _order(self.bwt)       # row that each row of the first column comes from

    @property
    def bwt(self) -> np.ndarray:
        return self.text[self.rows - 1]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = _runs(self.text[self.rows])
        symbols = self.text[self.rows[cut[:-1]]]
        keep = symbols > 0
        return cut[:-1][keep], cut[1:][keep], symbols[None, keep]

    def left(self, lo, hi, words):
        """Every interval extended by every word before it."""
        label = np.full(len(self.rows), -1)
        size = hi - lo
        label[np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())] = \
            np.repeat(np.arange(len(lo)), size)
        before, label = self.bwt[self.first], label[self.first]
        cut = _runs(before, label)
        at = cut[:-1]
        keep = (before[at] > 0) & (label[at] >= 0)
        at = at[keep]
        return at, cut[1:][keep], np.vstack([before[at][None], words[:, label[at]]])

    def right(self, lo, hi, words):
        """Every interval split by the word after it."""
        size = hi - lo
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        which = np.repeat(np.arange(len(lo)), size)
        after = self.text[(self.rows[rows] + len(words)) % len(self.text)]
        cut = _runs(which, after)
        at, ends = cut[:-1], cut[1:]
        keep = after[at] > 0
        at, ends = at[keep], ends[keep]
        return rows[at], rows[at] + (ends - at), np.vstack([words[:, which[at]], after[at][None]])


def _pack(*columns: np.ndarray) -> bytes:
    """uint32 columns, bytes of equal weight side by side, compressed."""
    raw = b"".join(np.ascontiguousarray(c, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns)
    return pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n * columns, asbytes=True), np.uint8)
    return [np.ascontiguousarray(c.reshape(4, n).T).view("<u4").ravel() for c in raw.reshape(columns, 4 * n)]


def phrase_counts(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases of two and three words of one shard (3 x n, 0: none) and their counts."""
    index = Index(np.append(text, 0))
    pairs = index.left(*index.words())
    triples = index.right(*pairs)
    words = np.hstack([np.vstack([pairs[2], np.zeros(len(pairs[0]), pairs[2].dtype)]), triples[2]])
    return words, np.concatenate([pairs[1] - pairs[0], triples[1] - triples[0]])


def _counted(buckets: int):
    def count(batches):
        for batch in batches:
            for ids, places, numbers in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                ids = np.frombuffer(ids.as_py(), "<i4")
                numbers = np.asarray(numbers.values, dtype=np.int64)
                dense = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.int32)
                order = np.argsort(numbers)
                dense[np.asarray(places.values)[order] + 1] = np.arange(1, len(numbers) + 1)
                words, counts = phrase_counts(dense[ids])
                words = np.concatenate([[0], numbers[order]])[words]
                bucket = _bucket(words, buckets)
                order = _order(bucket)
                cut = _runs(bucket[order]) if len(order) else np.zeros(1, np.int64)
                out = [[], [], []]
                for lo, hi in zip(cut[:-1], cut[1:]):
                    at = order[lo:hi]
                    for col, x in zip(out, (int(bucket[at[0]]), len(at), _pack(*words[:, at], counts[at])), strict=True):
                        col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                                  pa.array(out[2], pa.binary())], names=["bucket", "entries", "payload"])
    return count


def _bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    h = np.zeros(words.shape[1], dtype=np.uint64)
    for w in words:
        h = mixed(h ^ w.astype(np.uint64))
    return (h % np.uint64(buckets)).astype(np.int64)


def _summed(min_count: int):
    def total(group: pa.Table) -> pa.Table:
        parts = [_unpack(p.as_py(), n.as_py(), 4) for n, p in zip(group["entries"], group["payload"], strict=True)]
        w1, w2, w3, n = (np.concatenate(c).astype(np.uint64) for c in zip(*parts, strict=True))
        pair = w1 << np.uint64(32) | w2
        order = np.lexsort((w3, pair))
        pair, w3, n = pair[order], w3[order], n[order]
        cut = _runs(pair, w3)[:-1]
        sums = np.add.reduceat(n, cut).astype(np.int64)
        cut, sums = cut[sums >= min_count], sums[sums >= min_count]
        pair, w3 = pair[cut], w3[cut].astype(np.int64)
        return pa.table({"w1": (pair >> np.uint64(32)).astype(np.int64), "w2": (pair & np.uint64(0xFFFFFFFF)).astype(np.int64),
                         "w3": pa.array(w3, mask=w3 == 0), "a": sums})
    return total


def frequent(cut: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(words, phrases) of shards: (lang, word, f, w) and (w1, w2, w3 or null, a), from ``min_count`` on."""
    words = (cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
             .groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
             .where(F.col("f") >= min_count).withColumn("less", -F.col("f")))
    words = numbered(words, ["less", "lang", "word"], "w").select("lang", "word", "f", (F.col("w") + 1).alias("w"))
    numbers = (cut.select("lang", "shard", F.posexplode("words").alias("place", "word")).join(words, ["lang", "word"])
               .groupBy("shard").agg(F.collect_list(F.struct("place", "w")).alias("x"))
               .select("shard", F.col("x.place").alias("places"), F.col("x.w").alias("numbers")))
    total = cut.agg(F.sum("n_words")).first()[0] or 0
    counts = (cut.select("shard", "ids").join(numbers, "shard").select("ids", "places", "numbers")
              .mapInArrow(_counted(-(-total // BUCKET) or 1), COUNTS))
    phrases = counts.groupBy("bucket").applyInArrow(_summed(min_count), PHRASES)
    return words, saved(phrases, "phrases")


def scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, w1, w2, w3, a, l, r, score): the lowest-scoring cut of each."""
    def word(n, *cols):
        return words.select(F.col("w").alias(f"w{n}"), *[F.col(c).alias(f"{c}{n}") for c in cols])

    def score(left, right):
        d = lambda c: f"cast({c} as decimal(14,0))"
        return F.expr(f"(1000000 * ({d('a')} * {d('a')})) div ({d(left)} * {d(right)})")

    pairs, triples = phrases.where(F.col("w3").isNull()), phrases.where(F.col("w3").isNotNull())
    named = (phrases.join(word(1, "lang", "word", "f"), "w1").withColumnRenamed("lang1", "lang")
             .join(word(2, "word", "f"), "w2"))
    two = named.where(F.col("w3").isNull()).select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "w1", "w2", "w3", "a",
        F.col("f1").alias("l"), F.col("f2").alias("r")).withColumn("score", score("l", "r"))
    head = pairs.select("w1", "w2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = (named.where(F.col("w3").isNotNull()).join(word(3, "word", "f"), "w3").join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
             .withColumn("s1", score("f1", "f23")).withColumn("s2", score("f12", "f3")))
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "w1", "w2", "w3", "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    # a pair goes where a triple around it has half its count
    around = (triples.select(F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
                             .alias("p"), F.col("a").alias("longer"))
              .groupBy("p.w1", "p.w2").agg(F.max("longer").alias("longer")))
    two = two.join(around, ["w1", "w2"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a"))).drop("longer")
    return two.unionByName(three)


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    cut = shards(docs, lang_col, text_col)
    words, phrases = frequent(cut, min_count)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = scored(words, phrases).withColumn("salt", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)))
    some = (rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best)))
            .where(F.col("rank") <= top))
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
              .where(F.col("rank") <= top))
    n = cut.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
ws AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM ws GROUP BY lang),
one AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM ws) GROUP BY lang, x),
two AS (
  SELECT lang, x, y, count(*) AS f FROM (
    SELECT lang, unnest(w[:len(w)-1]) AS x, unnest(w[2:]) AS y FROM ws WHERE len(w) > 1) GROUP BY lang, x, y),
three AS (
  SELECT lang, x, y, z, count(*) AS f FROM (
    SELECT lang, unnest(w[:len(w)-2]) AS x, unnest(w[2:len(w)-1]) AS y, unnest(w[3:]) AS z FROM ws WHERE len(w) > 2)
  GROUP BY lang, x, y, z HAVING count(*) >= {MIN_COUNT}),
around AS (
  SELECT lang, x, y, max(f) AS longer FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three)
  GROUP BY lang, x, y),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, p.f AS l, q.f AS r
  FROM two AS t JOIN one AS p ON p.lang = t.lang AND p.x = t.x JOIN one AS q ON q.lang = t.lang AND q.x = t.y
  LEFT JOIN around AS o ON o.lang = t.lang AND o.x = t.x AND o.y = t.y
  WHERE t.f >= {MIN_COUNT} AND (o.longer IS NULL OR 100 * o.longer < {COVERED} * t.f)
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, p.f, q.f
  FROM three AS t JOIN one AS p ON p.lang = t.lang AND p.x = t.x JOIN two AS q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, p.f, q.f
  FROM three AS t JOIN two AS p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y JOIN one AS q ON q.lang = t.lang AND q.x = t.z),
best AS (
  SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT best.lang, phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best JOIN n ON n.lang = best.lang)
WHERE rank <= {TOP}
"""
