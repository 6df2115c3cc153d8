"""Line deduplication with a suffix array over line ids, DataFrame operations only.

Every document is a sequence of line ids (lines without a word are left out and stay in
the text). The suffixes of all sequences are sorted by prefix doubling: a suffix's rank by
its first 2k lines follows from its rank by k lines and the rank k lines further on, where
the end of a document is a symbol of its own. Ranks are counts of smaller suffixes, so a
suffix whose rank is its own is settled and takes no part in later rounds; the rounds end
when all are. A rank needs the number of rows per distinct key, summed in order: rows of
one key are counted on the map side, distinct keys are range-sorted and summed per
partition, so neither a hot line nor a large group of copies meets in one task.

Longest common prefixes of neighbours in the suffix array come from the same ranks, from
the longest round down. Maximal stretches of neighbours that share at least ``min_lines``
lines are the prefix intervals: in each, the earliest place (by document id, then line)
is the original, and the run of lines at every other place is a later copy. A line is
deleted if a later copy covers it. Every prefix belongs to both of its neighbours: the
largest at a document's places is its longest run of lines that stands at another place
too, earlier or later (0 if it has fewer than ``min_lines``).

Line ids are two independent 64-bit hashes of the line.

Defined results: null and empty texts have no lines and stay as they are; rows with the
same id and the same text are one document; rows without an id come first; ties of id are
ordered by the hash of the text; lines repeated inside one document count as well; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemoi.llm.common import row_key, saved, table

MIN_LINES = 1          # shortest repeated run whose later copies are deleted
KEY = ["k_id", "k_text"]
PLACE = [*KEY, "p"]


def _summed(keys: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows before this one in ``order`` (distinct keys)."""
    part = saved(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sorted")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, then each partition in itself
    start = part.groupBy("part").agg(F.sum(value).alias("v")).select(
        "part", F.coalesce(F.sum("v").over(before(Window.orderBy("part"))), F.lit(0)).alias("start"))
    inside = F.coalesce(F.sum(value).over(before(Window.partitionBy("part").orderBy(*order))), F.lit(0))
    return (part.withColumn("inside", inside).join(F.broadcast(start), "part")
            .withColumn(name, F.col("inside") + F.col("start")).drop("inside", "start", "part"))


def line_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a word: key, p (number among these lines), at (line in the text), l1, l2."""
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
                        lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    d = docs.select(*row_key(id_col, text_col), lines.alias("x"))
    d = d.select(*KEY, F.posexplode(F.filter("x", lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))).alias("p", "x"))
    return d.select(*KEY, "p", "x.at", F.xxhash64("x.line").alias("l1"), F.xxhash64(F.lit(1), "x.line").alias("l2")).distinct()


def suffix_ranks(lines: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(PLACE, rank) of every suffix that shares a line with another, and the rounds' ranks.

    Round j holds the suffixes that share their first 2^j lines with another one.
    """
    keys = lines.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("n"))
    first = _summed(keys, ["l1", "l2"], "n", "rank")
    ranked = saved(lines.join(first, ["l1", "l2"]).select(*PLACE, "rank", "n"), "ranked")
    live, done, rounds, k = ranked.where("n > 1").select(*PLACE, "rank"), ranked.where("n = 1").select(*PLACE, "rank"), [], 1
    settled = None
    while not live.isEmpty():
        rounds.append(live)
        # suffixes among a document's first k lines follow no other one k lines on
        other = done.unionAll(live).where(F.col("p") >= k).select(*KEY, (F.col("p") - k).alias("p"), F.col("rank").alias("next"))
        # beyond the end stands a symbol of the document's own, below every rank
        end = -F.lit(1).cast("long") - F.pmod(F.xxhash64(*KEY), F.lit((1 << 62)))
        pair = saved(live.join(other, PLACE, "left").withColumn("next", F.coalesce("next", end)), "pairs")
        keys = pair.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"))
        order = saved(_summed(keys, ["rank", "next"], "n", "c"), "order")
        base = order.groupBy("rank").agg(F.min("c").alias("base"))
        new = order.join(base, "rank").select("rank", "next", "n", (F.col("rank") + F.col("c") - F.col("base")).alias("new"))
        ranked = saved(pair.join(new, ["rank", "next"]).select(*PLACE, F.col("new").alias("rank"), "n"), "ranked")
        live, gone = ranked.where("n > 1").select(*PLACE, "rank"), ranked.where("n = 1").select(*PLACE, "rank")
        done = done.unionAll(gone)
        settled = gone if settled is None else settled.unionAll(gone)
        k *= 2
    return (lines.limit(0).select(*PLACE, F.lit(0).cast("long").alias("rank")) if settled is None else settled), rounds


def common_prefixes(ranks: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(PLACE, rank, q_KEY, lcp): lines shared with the suffix one rank lower, if it shares any, and its document."""
    prev = ranks.select((F.col("rank") + 1).alias("rank"), *[F.col(c).alias(f"q_{c}") for c in PLACE])
    pairs = saved(ranks.join(prev, "rank").withColumn("lcp", F.lit(0)), "neighbours")
    for j in reversed(range(len(rounds))):
        mine = rounds[j].select(*PLACE, F.col("rank").alias("r1"))
        theirs = rounds[j].select(*[F.col(c).alias(f"q_{c}") for c in PLACE], F.col("rank").alias("r2"))
        step = (pairs.withColumn("p", F.col("p") + F.col("lcp")).withColumn("q_p", F.col("q_p") + F.col("lcp"))
                .join(mine, PLACE, "left").join(theirs, [f"q_{c}" for c in PLACE], "left"))
        grown = F.when(F.col("r1") == F.col("r2"), F.lit(1 << j)).otherwise(F.lit(0))
        pairs = (step.withColumn("p", F.col("p") - F.col("lcp")).withColumn("q_p", F.col("q_p") - F.col("lcp"))
                 .withColumn("lcp", F.col("lcp") + grown).drop("r1", "r2"))
        if j % 3 == 0:
            pairs = saved(pairs, "prefixes")
    pairs = pairs.select("rank", *[f"q_{c}" for c in KEY], "lcp")
    return ranks.join(pairs, "rank", "left").withColumn("lcp", F.coalesce("lcp", F.lit(0)))


def longest_runs(array: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """(KEY, longest_run): lines of each document's longest run that stands at another place too."""
    shared = array.where(F.col("lcp") >= min_lines)
    ends = shared.select(*KEY, "lcp").unionAll(shared.select(*[f"q_{c}" for c in KEY], "lcp"))
    return ends.groupBy(*KEY).agg(F.max("lcp").alias("longest_run"))


def later_copies(lines: DataFrame, min_lines: int = MIN_LINES, array: DataFrame | None = None) -> DataFrame:
    """(KEY, a): places of runs of at least ``min_lines`` lines that stand at an earlier place too."""
    if array is None:
        array = saved(common_prefixes(*suffix_ranks(lines)).select(*PLACE, "rank", "lcp"), "array")
    array = array.select(*PLACE, "rank", "lcp")
    # suffixes that start a prefix interval or lie in one; an interval begins after a shorter prefix
    flag = array.withColumn("head", (F.col("lcp") < min_lines).cast("long"))
    flag = _summed(flag, ["rank"], "head", "heads").withColumn("interval", F.col("heads") + F.col("head"))
    flag = saved(flag, "intervals")
    best = flag.groupBy("interval").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    best = saved(best.select("interval", "first.*"), "first")
    # all places of such intervals but the earliest: rows are told apart by their place, never by their
    # interval, so a hot line's interval meets in no task
    heads = flag.where("head = 1").join(best.select("interval"), "interval", "left_semi")
    late = flag.where("head = 0").select(PLACE).unionAll(heads.select(PLACE)).join(best.select(PLACE), PLACE, "left_anti")
    return late.select(*KEY, F.col("p").alias("a"))


def _without(docs: DataFrame, lines: DataFrame, late: DataFrame, runs: DataFrame, min_lines: int, id_col: str,
             text_col: str) -> DataFrame:
    """doc_id, n_lines, n_deleted, longest_run and ``text`` without the lines that the later copies ``late`` cover."""
    gone = late.select(*KEY, F.explode(F.sequence("a", F.col("a") + (min_lines - 1))).alias("p")).distinct()
    gone = (gone.join(lines.select(*PLACE, "at"), PLACE).groupBy(*KEY)
            .agg(F.sort_array(F.collect_list("at")).alias("gone")))
    d = docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), F.col(text_col).alias("text"))
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_lines", n_lines.cast("long")).join(gone.join(runs, KEY, "full"), KEY, "left")
    d = d.withColumn("ls", F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)))
    # array_except is hashed: linear in the lines
    stay = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("ls", i)), "\n"))
    n_deleted = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    longest = F.coalesce("longest_run", F.lit(0)).cast("long")
    return d.select("doc_id", "n_lines", n_deleted.alias("n_deleted"), longest.alias("longest_run"), kept.alias("text"))


def deduplicated(docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_deleted, longest_run, kept text (``text``) of every document."""
    lines = saved(line_ids(docs, id_col, text_col), "lines")
    array = saved(common_prefixes(*suffix_ranks(lines)), "array")
    late = saved(later_copies(lines, min_lines, array), "late")
    return _without(docs, lines, late, longest_runs(array, min_lines), min_lines, id_col, text_col)


def op7_line_dedup(spark, sf_dir):
    """Every later copy of a line is deleted: a run of one line is a repeated run too."""
    return deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_deleted", "longest_run", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, pos, line FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d)),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS p FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
g AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, p) AS k FROM s) WHERE k > 1),
k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS t FROM l
      LEFT JOIN g ON g.doc_id = l.doc_id AND g.pos = l.pos WHERE g.pos IS NULL GROUP BY l.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
-- equal lines at two places; places one line further on lie on one diagonal, and unbroken stretches of it are runs
q AS (SELECT x.doc_id AS a, x.p AS i, y.doc_id AS b, y.p - x.p AS diagonal FROM s AS x JOIN s AS y ON y.line = x.line
      WHERE x.doc_id <> y.doc_id OR x.p <> y.p),
r AS (SELECT a, max(n) AS longest FROM (
        SELECT a, count(*) AS n FROM (SELECT a, b, diagonal, i - row_number() OVER (PARTITION BY a, b, diagonal ORDER BY i) AS run FROM q)
        GROUP BY a, b, diagonal, run) GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(c.n, 0) AS n_deleted, coalesce(r.longest, 0) AS longest_run,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN r ON r.a = d.doc_id
"""
