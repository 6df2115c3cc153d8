"""Substring deduplication by level-wise doubling of repeated word windows.

A word is removed if a window of ``window`` consecutive words covers it whose words also
stand, in the same order, in a document with a smaller id.

Level one looks at windows of half the length. Among the half windows inside every full
window the one with the smallest hash is its anchor, so equal full windows have equal
anchors and about one position in thirteen is looked at. Only anchors that repeat in
another document are extended. The full windows that share an anchor form a run; runs
with the same words are compared whole: in all but the first document the run is a repeat.
Only where an anchor stands in different runs (the edges of a passage) are the full
windows of each run's first document compared one by one. At that length the result is
final: every longer repeat is covered by its windows of this length, so no candidate
survives to a further doubling.

Every comparison is a grouped minimum of the id, combined on the map side; no group is
collected. Equal hashes of whole windows are taken for equal words (two independent
64-bit hashes for windows and runs together with their anchor's).

Defined results: null texts have no words and keep the hash of the empty text; documents
shorter than the window lose nothing; rows with one id never remove each other's words
and are told apart by their text; rows without an id remove nothing and lose nothing;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import saved, ship, table
from anemoi.llm.wordhash import window_hashes, word_hashes

WINDOW = 50


def _slide(x: np.ndarray, width: int, fn) -> np.ndarray:
    """fn (minimum or maximum) over every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = fn(x[:-step], x[step:])
        have += step
    return x


def run_bounds(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): ranges of full-window starts whose anchor has one hash."""
    half = (window + 1) // 2
    low = _slide(window_hashes(words, half), window - half + 1, np.minimum)
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    first = np.concatenate([[0], change]).astype(np.int64)
    last = np.concatenate([change, [len(low)]]).astype(np.int64) - 1
    return low[first], first, last


def _span_hash(words: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of words[first:first+size] for each range."""
    from anemoi.llm.wordhash import _WORDS, mixed
    up, down = _WORDS[1](len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:len(words)], out=total[1:])
    return mixed((total[first + size] - total[first]) * down[first] + size.astype(np.uint64), 5)


def kept_hash(text: str | None, removed: np.ndarray | None = None) -> str:
    words = (text or "").encode().split()
    if removed is not None:
        words = [w for w, gone in zip(words, removed, strict=True) if not gone]
    return hashlib.sha256(b" ".join(words)).hexdigest()


def runs(docs: DataFrame, window: int) -> DataFrame:
    """One row per document (doc_id, tag, text): doc_id, tag, n_words, full_sha, and its runs as arrays."""
    schema = ("doc_id long, tag int, n_words long, full_sha string, "
              "h array<long>, r array<long>, a array<int>, n array<int>")

    def scan(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2)
                words, off = word_hashes(texts)
                cols = [[], [], [], [], []]
                for i in range(part.num_rows):
                    w = words[off[i]:off[i + 1]]
                    h = r = a = n = np.zeros(0, np.int64)
                    if len(w) >= window and part.column(0)[i].is_valid:
                        h, a, last = run_bounds(w, window)
                        n = last - a + 1
                        r, h = _span_hash(w, a, n + window - 1).view(np.int64), h.view(np.int64)
                    for col, x in zip(cols, (kept_hash(texts[i].as_py()), h, r, a.astype(np.int32), n.astype(np.int32)),
                                      strict=True):
                        col.append(x)
                lists = [pa.array(c, pa.list_(t)) for c, t in zip(cols[1:], (pa.int64(), pa.int64(), pa.int32(), pa.int32()),
                                                                  strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(off), pa.int64()),
                     pa.array(cols[0], pa.string()), *lists],
                    names=["doc_id", "tag", "n_words", "full_sha", "h", "r", "a", "n"])

    return docs.mapInArrow(scan, schema)


def _windows(parts: DataFrame, window: int) -> DataFrame:
    """Both hashes of every full window in the given ranges: w1, w2, doc_id, tag, s."""
    def emit(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words, _ = word_hashes(batch.column(2).slice(i, 1))
                first = np.asarray(batch.column(3)[i].values, dtype=np.int64)
                size = np.asarray(batch.column(4)[i].values, dtype=np.int64)
                starts = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(window_hashes(words, window, f)[starts].view(np.int64)) for f in (0, 1)]
                    + [pa.array(np.full(n, batch.column(0)[i].as_py())), pa.array(np.full(n, batch.column(1)[i].as_py(), np.int32)),
                       pa.array(starts.astype(np.int32))], names=["w1", "w2", "doc_id", "tag", "s"])

    return parts.select("doc_id", "tag", "text", "a", "n").mapInArrow(
        emit, "w1 long, w2 long, doc_id long, tag int, s int")


def repeated_spans(per: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """doc_id, tag, a, e: word ranges [a, e) that repeat words of a smaller document."""
    one = per.select("doc_id", "tag", F.explode(F.arrays_zip("h", "r", "a", "n")).alias("x")).select("doc_id", "tag", "x.*")
    # level one: anchors that stand in more than one document
    again = (one.groupBy("h").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
             .where("x < y").select("h"))
    live = saved(one.join(again, "h"), "live")
    # level two: whole runs, then the windows at the edges
    lead = saved(live.groupBy("h", "r").agg(F.min("doc_id").alias("lead")), "lead")
    many = lead.groupBy("h").agg(F.min("r").alias("x"), F.max("r").alias("y")).where("x <> y").select("h")
    led = live.join(lead, ["h", "r"])
    whole = led.where("doc_id > lead").select("doc_id", "tag", "a", (F.col("a") + F.col("n") + window - 1).alias("e"))
    edge = led.where("doc_id = lead").join(many, "h").groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("a", "n")).alias("x")).select("doc_id", "tag", F.col("x.a").alias("a"), F.col("x.n").alias("n"))
    w = saved(_windows(edge.join(texts, ["doc_id", "tag"]), window), "windows")
    first = (w.groupBy("w1", "w2").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
             .where("x < y").select("w1", "w2", "x"))
    late = w.join(first, ["w1", "w2"]).where("doc_id > x").select(
        "doc_id", "tag", F.col("s").alias("a"), (F.col("s") + window).alias("e"))
    return whole.unionAll(late)


def deduplicated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of every document."""
    ship(docs.sparkSession)
    # the tag tells texts of one id apart
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND((1 << 31) - 1).cast("int").alias("tag"),
                    F.col(text_col).alias("text"))
    per = saved(runs(d, window), "runs")
    texts = d.where("doc_id IS NOT NULL")
    spans = repeated_spans(per, texts, window)
    hit = saved(spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("a", "e")).alias("x"))
                .select("doc_id", "tag", F.col("x.a").alias("a"), F.col("x.e").alias("e")), "hit")

    def cut(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                n = len((text or "").encode().split())
                edges = np.zeros(n + 1, dtype=np.int64)
                np.add.at(edges, np.asarray(batch.column(3)[i].values, dtype=np.int64), 1)
                np.add.at(edges, np.asarray(batch.column(4)[i].values, dtype=np.int64), -1)
                gone = np.cumsum(edges)[:-1] > 0
                out.append((int(gone.sum()), kept_hash(text, gone)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.string())], names=["doc_id", "tag", "n_removed", "kept_sha256"])

    cut_docs = hit.join(texts, ["doc_id", "tag"]).select("doc_id", "tag", "text", "a", "e").mapInArrow(
        cut, "doc_id long, tag int, n_removed long, kept_sha256 string")
    cut_docs = cut_docs.dropDuplicates(["doc_id", "tag"])      # rows that are there twice
    return (per.select("doc_id", "tag", "n_words", "full_sha").join(cut_docs, ["doc_id", "tag"], "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha256", "full_sha").alias("kept_sha256")))


def op9_substring_dedup(spark, sf_dir):
    return deduplicated(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 49), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
f AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY g) AS m FROM g) WHERE m < doc_id),
p AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM f),
k AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.i) AS t
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) AS x
      LEFT JOIN p ON p.doc_id = x.doc_id AND p.i = x.i WHERE p.i IS NULL GROUP BY x.doc_id),
c AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""
