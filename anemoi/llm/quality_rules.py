"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and stores, beside the measurements, one failure
bit per rule. ``apply_policy`` (a versioned set of rules) and ``ablation`` read only the
ledger: thresholds are evaluated once, policies cost one bitwise AND.

Defined results: a null text is an empty one; an empty text fails ``few_words``; repeated
rows are judged each on its own; null ids stay null; extra columns are ignored by
``ledger`` and kept by ``filter_documents``; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import words

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# (name, fails if); the position is the bit, so rules are only ever appended
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 25 * n_words"),
)
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": tuple(name for name, _ in RULES),
}


def mask(rules) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(r) for r in rules)


def _covered(starts: Column, width: int) -> Column:
    """Positions covered by windows of ``width`` at the sorted distinct ``starts``."""
    steps = F.transform(starts, lambda x, k: F.least(F.lit(width), F.coalesce(
        F.get(starts, k + 1) - x, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _measured(docs: DataFrame, carried: Column, text_col: str) -> DataFrame:
    """``carried`` (named row) and MEASURES (long) of every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # every array below is used several times, so it stays a column of its own projection
    d = docs.select(carried.alias("row"), text.alias("t"), words(text).alias("w"),
                    F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select("row", F.size("w").cast("long").alias("n_words"),
                 F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("hw"))
    keep = [c for c in d.columns if c != "hw"]
    d = d.select(*keep, F.when(F.col("n_words") > WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("hw") - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("hw", i + j) for j in range(WINDOW)]))).alias("hg"))
    # primitive sort of the hashes: a document without a repeated window ends here
    d = d.select(*keep, "hg", F.sort_array("hg").alias("sg"))
    d = d.select(*keep, "hg", F.exists(F.transform("sg", lambda x, k: (k > 0) & (F.get("sg", k - 1) == x)),
                                       lambda x: x).alias("again"))
    d = d.select(*keep, F.when(F.col("again"), F.sort_array(F.transform(
        "hg", lambda x, k: F.struct(x.alias("h"), k.alias("i"))))).alias("s"))
    same = lambda x, k: F.coalesce(F.get("s", k)["h"] == x["h"], F.lit(False))
    d = d.select(*keep, F.sort_array(F.transform(
        F.filter("s", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])).alias("starts"))
    n_repeat = F.coalesce(_covered(F.col("starts"), WINDOW), F.lit(0).cast("long"))
    return d.select(*keep, n_repeat.alias("n_repeat_words")).select("row", *MEASURES)


def _with_bits(measured: DataFrame) -> DataFrame:
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits + F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0))
    return measured.withColumn("failed_bits", bits)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed_bits`` (bit i: RULES[i] fails) of every document."""
    return _with_bits(_measured(docs, F.col(id_col), text_col)).withColumnRenamed("row", "doc_id")


def apply_policy(led: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the policy's version."""
    failed = lambda m: F.col("failed_bits").bitwiseAND(F.lit(m).cast("long")) != 0
    base = failed(mask(BASE))
    return (led.withColumn("base_failed", base)
            .withColumn("kept", ~(base | failed(mask(POLICIES[policy]))))
            .withColumn("policy", F.lit(policy)))


def filter_documents(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all their columns; no join, no shuffle."""
    # the row number keeps the filter above the measures: pushed below them, it would
    # repeat every measure's expression once per use
    judged = _with_bits(_measured(docs, F.struct("*"), text_col)).withColumn("pin", F.monotonically_increasing_id())
    return apply_policy(judged, policy).where("kept AND pin >= 0").select("row.*")


def ablation(led: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents it fails, and those it alone fails.

    Documents are first counted per bit pattern (at most 2^rules groups, summed on the
    map side); ``n_only`` is what dropping the rule would bring back.
    """
    m = mask(POLICIES[policy])
    patterns = led.groupBy(F.col("failed_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                      for i, (n, _) in enumerate(RULES) if n in POLICIES[policy]])
    one = patterns.select("bits", "count", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return one.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count"))), F.lit(0)).alias("n_only"))


def op5_quality_rules(spark, sf_dir):
    from anemoi.llm.common import table
    return apply_policy(ledger(table(spark, sf_dir, "documents"))).drop("policy")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, sum(least(5, coalesce(nx - i, 5))) AS n_repeat_words
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM r) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN c USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
               + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
               + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
               + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
               + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
               + CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT *, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept FROM b
"""
