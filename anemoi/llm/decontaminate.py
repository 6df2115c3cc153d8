"""Benchmark decontamination: a prefix-filtered join of word shingles, DataFrame operations only.

Item windows (ten consecutive words; a shorter item is one window) are sets of positioned
shingles of three words, or of all words where a window has fewer. Document shingles that
any window holds are the hits; their counts over all documents order shingles by rarity.
A window is contained only if all its shingles are, so its prefix is its single rarest
shingle, and windows with a shingle that no document has are out. Documents meet windows
on prefix shingles only; the shingle's place gives the one start the window could have,
checked against the document's bounds, and every other shingle of the window must then be
a hit at its own place. Shingles are compared by 64-bit hashes, eight to a window.

Hits are found by one pass over the documents' shingles. The item shingles are broadcast
while there are at most BROADCAST_SHINGLES of them and joined by a shuffle beyond.

Defined results: null texts of items have no words; items without an id count for n_hit
and contaminated, not for the item list and its number; null texts of documents have no
words and no hits; repeated rows each get the same result; null document ids stay null;
items with one text all count; extra columns are ignored; an empty benchmark contaminates
nothing, an empty document table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemoi.llm.common import row_key, saved, table

WINDOW = 10
SHINGLE = 3
BROADCAST_SHINGLES = 500_000

_UPPER = [chr(c) for c in range(65, 91)]
_OTHER = [chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)]
KEY = ["k_id", "k_text"]


def plain_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z in lower case (null: none)."""
    flat = F.translate(F.coalesce(text, F.lit("")), "".join(_UPPER + _OTHER),
                       "".join(c.lower() for c in _UPPER) + " " * len(_OTHER))
    return F.array_remove(F.split(flat, " "), "")


def _shingle(words: str, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[F.get(words, at + j) for j in range(width)])


def _shingles(words: str, width: int) -> Column:
    """Shingle hashes of the word array column ``words`` with their places; none if it is shorter."""
    places = F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0)))
    found = F.transform(places, lambda i: F.struct(i.alias("pos"), _shingle(words, i, width).alias("sh")))
    return F.when(F.size(words) >= width, found).otherwise(F.array().cast("array<struct<pos:int,sh:bigint>>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(win, item) pairs of the items with an id, and (win, len, width, o, sh): the shingles of each distinct window."""
    w = items.select(F.col(id_col).cast("string").alias("item"), plain_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW, F.lit(0)))
    w = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s + 1, WINDOW))).alias("w"))
    w = w.select("item", "w", F.sha2(F.array_join("w", " "), 256).alias("win"))
    width = F.least(F.size("w"), F.lit(SHINGLE))
    shapes = None
    for k in range(1, SHINGLE + 1):
        x = w.where(width == k).select("win", F.size("w").alias("len"), F.lit(k).alias("width"),
                                       F.explode(_shingles("w", k)).alias("x")).select(
            "win", "len", "width", F.col("x.pos").alias("o"), "x.sh")
        shapes = x if shapes is None else shapes.unionAll(x)
    return saved(w.where("item IS NOT NULL").select("win", "item").distinct(), "items"), saved(shapes.distinct(), "shapes")


def hits(docs: DataFrame, shapes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (pos -1) and one per document shingle that an item holds."""
    widths = sorted(r[0] for r in shapes.select("width").distinct().collect())     # at most SHINGLE numbers
    known = shapes.select("sh").distinct()
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    d = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), plain_words(F.col(text_col)).alias("w"))
    d = d.select("doc_id", *KEY, "w", F.size("w").alias("n_words"))
    rows = [F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("sh")))]
    rows += [_shingles("w", k) for k in widths]
    all_rows = F.concat(*rows) if len(rows) > 1 else rows[0]
    d = d.select("doc_id", *KEY, "n_words", F.explode(all_rows).alias("x")).select("doc_id", *KEY, "n_words", "x.*")
    found = d.join(known.withColumn("known", F.lit(True)), "sh", "left")
    return found.where("known OR pos = -1").select("doc_id", *KEY, "n_words", "pos", "sh")


def occurrences(found: DataFrame, shapes: DataFrame) -> DataFrame:
    """k_id, k_text, win, start, len: every place where a document holds an item window."""
    tf = found.groupBy("sh").agg(F.count(F.lit(1)).alias("tf"))
    ranked = shapes.join(tf, "sh", "left").groupBy("win", "len").agg(
        F.count(F.lit(1)).alias("need"), F.count("tf").alias("seen"),
        F.min(F.struct("tf", "o", "sh")).alias("p"))
    prefix = ranked.where("need = seen").select("win", "len", "need", F.col("p.o").alias("p_o"), F.col("p.sh").alias("sh"))
    cand = (found.join(prefix, "sh").withColumn("start", F.col("pos") - F.col("p_o"))
            .where("start >= 0 AND start + len <= n_words")
            .select(*KEY, "win", "len", "need", "start").distinct())
    parts = cand.join(shapes.select("win", "o", "sh"), "win").withColumn("pos", F.col("start") + F.col("o"))
    same = parts.join(found.select(*KEY, "pos", "sh").distinct(), [*KEY, "pos", "sh"])
    return (same.groupBy(*KEY, "win", "len", "need", "start").agg(F.count(F.lit(1)).alias("n"))
            .where("n = need").select(*KEY, "win", "start", "len"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the join key of every document."""
    win_items, shapes = item_windows(items)
    every = saved(hits(docs, shapes, id_col, text_col), "hits")
    found = every.where("pos >= 0")
    occ = saved(occurrences(found, shapes), "occurrences")
    before = Window.partitionBy(*KEY).orderBy("start", "e").rowsBetween(Window.unboundedPreceding, -1)
    spans = occ.select(*KEY, "start", (F.col("start") + F.col("len")).alias("e")).distinct()
    cover = F.greatest(F.lit(0), F.col("e") - F.greatest("start", F.coalesce(F.max("e").over(before), F.lit(0))))
    n_hit = spans.withColumn("c", cover).groupBy(*KEY).agg(F.sum("c").alias("n_hit"))
    ids = (occ.select(*KEY, "win").distinct().join(win_items, "win").groupBy(*KEY)
           .agg(F.sort_array(F.collect_set("item")).alias("items")))
    zero = F.lit(0).cast("long")
    return (every.where("pos = -1").select("doc_id", *KEY, F.col("n_words").cast("long").alias("n_words"))
            .join(n_hit, KEY, "left").join(ids, KEY, "left")
            .select("doc_id", "n_words", F.coalesce(F.col("n_hit").cast("long"), zero).alias("n_hit"),
                    F.when(F.col("items").isNull(), zero).otherwise(F.size("items").cast("long")).alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated"), *KEY))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item window, all their columns."""
    bad = contaminated(docs, items, id_col, text_col).where("contaminated").select(*KEY).distinct()
    rows = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col))
    return rows.join(bad, KEY, "left_anti").select("row.*")


def op6_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop(*KEY)


ORACLE = r"""
WITH i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(list_slice(w, s, s + 9), ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dw AS (SELECT doc_id, l, s, array_to_string(list_slice(w, s, s + l - 1), ' ') AS g
       FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s
             FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)),
o AS (SELECT doc_id, s, dw.l, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.l = iw.l),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             array_to_string(list_sort(list(DISTINCT item_id::VARCHAR) FILTER (WHERE item_id IS NOT NULL)), ',') AS ids FROM o GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
