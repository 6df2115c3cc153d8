"""Mixing sources to target token counts by entropy balancing.

Every token of a document carries the same weight, so the balanced rates that are nearest
(in relative entropy) to "take every token once" and meet one token constraint per source
are exponential in the constraint's multiplier: a document of source s is taken
``exp(lambda_s)`` times. The multipliers are the minimum of the convex dual
``sum_s S_s exp(lambda_s) - lambda_s T_s``; as sources partition the documents its Hessian
is diagonal, and each Newton step is one column expression over the table of sources: no
multiplier and no source list ever reaches the driver.

Rates become whole copies: every document is taken floor(rate) times, and documents in a
pseudo-random order (md5 of the id) are taken once more until the source's tokens are
used up. The rest that the last document leaves is then filled, in the same order, from
documents that still fit, twice. Order and sums come from window functions over buckets of
the hash of bounded size, so a source may hold any share of the rows.

Defined results: a null text has size 0; a null source is a source of its own, last in
code point order; documents of size 0 are taken 0 words; equal ids are ordered by their
size; rows equal in id, text and source are taken together; extra columns are ignored by
``mixed`` and kept by ``repeated``; an empty table gives no rows, a corpus without words
gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemoi.llm.common import numbered, row_key, saved, table, words

WEIGHTS = (5, 2, 1)
MOST = 3                 # no document is taken more often
NEWTON_STEPS = 30
BUCKET_ROWS = 50_000     # documents that one window group sorts, about
FILL_ROUNDS = 2


def weighted_targets(sources: DataFrame) -> DataFrame:
    """source, source_size -> with ``target``: shares by WEIGHTS, at most MOST times the size.

    Water filling: level = (total - capped) / (weights of the rest); a source whose share
    exceeds its cap is fixed there, until none is left. Capped sources only grow, so the
    loop ends after as many rounds as capped sets, each one aggregate over the sources.
    """
    s = numbered(sources.withColumn("is_null", F.col("source").isNull()), ["is_null", "source"], "rank")
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    s = saved(s.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * MOST), "sources")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    capped, done, level = F.lit(False), -1, 0.0
    while True:
        x = s.agg(F.sum(F.when(capped, F.col("cap"))).alias("cap"), F.sum(F.when(~capped, F.col("w"))).alias("w"),
                  F.count(F.when(capped, 1)).alias("n")).first()
        if x["n"] == done or not x["w"]:
            break
        done, level = x["n"], (total - (x["cap"] or 0)) / x["w"]
        # a source over its cap stays there: the level only rises
        capped = F.col("w") * F.lit(level) > F.col("cap")
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.col("w") * F.lit(level))
    return s.withColumn("target", target).drop("is_null", "rank", "w", "cap")


def balanced_rates(targets: DataFrame, steps: int = NEWTON_STEPS) -> DataFrame:
    """Adds ``rate = exp(lambda)``, the solution of the dual, by Newton steps from lambda = 0.

    A step is ``lambda + (T - S e^lambda) / (S e^lambda)``, cut to +-1 so that it can't
    overshoot; it converges quadratically and ``steps`` covers rates from e^-20 to e^20.
    All sources step at once, each where its row is.
    """
    def step(lam, _):
        have = F.col("source_size") * F.exp(lam)
        return lam + F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("target") - have) / have))

    lam = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step)
    solvable = (F.col("target") > 0) & (F.col("source_size") > 0)
    return targets.withColumn("rate", F.when(solvable, F.exp(lam)).otherwise(F.lit(0.0)))


def _running(df: DataFrame, value: str, name: str, n_buckets: int) -> DataFrame:
    """Sum of ``value`` over the rows of the same source before this one, in order of ``u``."""
    b = df.withColumn("b", (F.conv(F.substring("u", 1, 8), 16, 10).cast("long") * n_buckets / (1 << 32)).cast("int"))
    before = Window.partitionBy("s_id").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    start = (b.groupBy("s_id", "b").agg(F.sum(value).alias("v"))
             .select("s_id", "b", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("start")))
    inside = (Window.partitionBy("s_id", "b").orderBy("u", "size", "k_text")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (b.withColumn("inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(start, ["s_id", "b"]).withColumn(name, F.col("inside") + F.col("start"))
            .drop("inside", "start", "b"))


def _source_id(source: str):
    """Join key of a source that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """k_id, k_text, s_id (the row's key), doc_id, size, n_rows, source_size, target, rate, copies."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), _source_id(source_col).alias("s_id"),
                    *row_key(id_col, text_col), F.size(words(F.col(text_col))).cast("long").alias("size"))
    d = saved(d.groupBy("doc_id", "source", "s_id", "k_id", "k_text", "size").agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("all", F.col("size") * F.col("n_rows")), "sizes")
    sources = d.groupBy("source", "s_id").agg(F.sum("all").alias("source_size"))
    rates = saved(balanced_rates(weighted_targets(sources)).drop("source"), "rates")
    n_buckets = max(1, -(-d.count() // BUCKET_ROWS))
    # rates within rounding of a whole number are whole: a capped source is taken exactly MOST times
    whole = F.floor(F.col("rate") + 1e-9)
    d = (d.drop("source").join(rates, "s_id")
         .withColumn("u", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
         .withColumn("copies", whole)
         .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size")))
         .withColumn("extra", F.lit(False)).withColumn("used", F.lit(0).cast("long")))
    for i in range(1 + FILL_ROUNDS):
        # the first round may overrun by half a document, the others only fill what is left
        left = F.col("rest") - F.col("used")
        fits = ~F.col("extra") & (F.col("size") > 0) & (F.col("copies") < MOST) & (F.lit(i == 0) | (F.col("all") <= left))
        d = _running(d.withColumn("cand", F.when(fits, F.col("all")).otherwise(F.lit(0).cast("long"))),
                     "cand", "run", n_buckets)
        take = (F.col("cand") > 0) & (F.col("run") + F.col("cand") / (2 if i == 0 else 1) <= left)
        d = saved(d.withColumn("extra", F.col("extra") | take).drop("cand", "run", "used"), f"round{i}")
        if i < FILL_ROUNDS:
            used = d.groupBy("s_id").agg(F.sum(F.when(F.col("extra"), F.col("all")).otherwise(0)).alias("used"))
            d = d.join(used, "s_id")
    return d.select("k_id", "k_text", "s_id", "doc_id", "size", "n_rows", "source_size", "target", "rate",
                    (F.col("copies") + F.col("extra").cast("long")).cast("long").alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, rate of every document."""
    d = copies(docs, id_col, text_col, source_col)
    d = d.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return d.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs``, all its columns, as often as it is taken."""
    taken = copies(docs, id_col, text_col, source_col).where("copies > 0").select("k_id", "k_text", "s_id", "copies")
    rows = docs.select(F.struct("*").alias("row"), *row_key(id_col, text_col), _source_id(source_col).alias("s_id"))
    rows = rows.join(taken, ["k_id", "k_text", "s_id"])
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def op3_mixing(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents")).drop("rate")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
             source_size * 3 AS cap FROM s),
k AS (SELECT *, sum(cap) OVER o AS caps_before, sum(w) OVER (ORDER BY cap / w DESC, source) AS w_after,
             row_number() OVER (ORDER BY cap / w, source) AS n
      FROM r WINDOW o AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT ((SELECT sum(source_size) FROM r) - coalesce(caps_before, 0))::DOUBLE
             / (SELECT sum(w) FROM k AS x WHERE x.n >= k.n) AS level
      FROM k WHERE w * (((SELECT sum(source_size) FROM r) - coalesce(caps_before, 0))::DOUBLE
             / (SELECT sum(w) FROM k AS x WHERE x.n >= k.n)) <= cap ORDER BY n LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN w * (SELECT level FROM l) > cap THEN cap::DOUBLE ELSE w * (SELECT level FROM l) END AS target FROM r),
c AS (SELECT d.doc_id, d.source, size, u, source_size, target,
             CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END AS copies FROM d
      JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e0 AS (SELECT *, greatest(0, target - copies * source_size) AS rest,
              CASE WHEN size > 0 AND copies < 3 THEN size ELSE 0 END AS cand FROM c),
x0 AS (SELECT *, cand > 0 AND coalesce(sum(cand) OVER w0, 0) + cand / 2 <= rest AS extra FROM e0
       WINDOW w0 AS (PARTITION BY source ORDER BY u, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e1 AS (SELECT * REPLACE (CASE WHEN NOT extra AND size > 0 AND copies < 3
                AND size <= rest - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) THEN size ELSE 0 END AS cand),
              rest - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) AS room FROM x0),
x1 AS (SELECT * REPLACE (extra OR (cand > 0 AND coalesce(sum(cand) OVER w0, 0) + cand <= room) AS extra) FROM e1
       WINDOW w0 AS (PARTITION BY source ORDER BY u, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
e2 AS (SELECT * EXCLUDE (room) REPLACE (CASE WHEN NOT extra AND size > 0 AND copies < 3
                AND size <= rest - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) THEN size ELSE 0 END AS cand),
              rest - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) AS room FROM x1),
x2 AS (SELECT * REPLACE (extra OR (cand > 0 AND coalesce(sum(cand) OVER w0, 0) + cand <= room) AS extra) FROM e2
       WINDOW w0 AS (PARTITION BY source ORDER BY u, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, size, source_size, target, ((copies + extra::INT) * size)::BIGINT AS taken,
       (copies + extra::INT)::BIGINT AS copies FROM x2
"""
