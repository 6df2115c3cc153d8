"""Per-day summaries kept next to the readings tables.

They let a daily run read O(days) rows instead of the whole history for:
the previous clean table's band, cutoff and high-water mark (``clean_stats``,
per day and device: power moments merged exactly with Chan's formula) and the
profile's value counts (``elig_counts``: eligible readings counted per day,
measure and value). Each is rebuilt only for the days that changed, and
bootstrapped from the full table when absent. ``all_counts`` sums the value counts
over all days; it moves by the signed counts of refreshed days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoi.operators.baseline import with_band
from anemoi.operators.profile import eligible_rows
from anemoi.plans.ledger import LEDGER
from anemoi.schema import DAY, DEVICE, INSERTED, MEASURES, POWER, RUNS, TS

CLEAN_STATS = T.StructType([
    T.StructField(DAY, T.DateType(), False),
    T.StructField(DEVICE, T.LongType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("power_n", T.LongType(), True),
    T.StructField("power_mean", T.DoubleType(), True),
    T.StructField("power_m2", T.DoubleType(), True),
    T.StructField("max_ts", T.TimestampNTZType(), True),
    T.StructField("max_inserted", T.TimestampNTZType(), True),
])

ELIG_COUNTS = T.StructType([
    T.StructField(DAY, T.DateType(), False),
    T.StructField("measure", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("n", T.LongType(), True),
    T.StructField("refreshed", T.TimestampNTZType(), True),
])

SCHEMAS = {"ledger": LEDGER, "clean_stats": CLEAN_STATS, "elig_counts": ELIG_COUNTS, "runs": RUNS}


def clean_stats(clean: DataFrame) -> DataFrame:
    """Moments of power per (day, device): n, mean and sum of squared deviations."""
    return clean.groupBy(DAY, DEVICE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(POWER).alias("power_n"),
        F.avg(POWER).alias("power_mean"),
        (F.var_pop(POWER) * F.count(POWER)).alias("power_m2"),
        F.max(TS).alias("max_ts"),
        F.max(INSERTED).alias("max_inserted"))


def bounds_from_stats(stats: DataFrame, k: float = 2.0, groups=()) -> DataFrame:
    """Mean and population sigma of power per group, merged from per-day
    moments: M2 = sum(m2_i) + sum(n_i * (mean_i - mean)^2). Same columns and
    rules as :func:`anemoi.operators.baseline.bounds`."""
    s = stats.where(F.col("power_n") > 0)
    g = list(groups)
    tot = s.groupBy(*g).agg(F.sum("power_n").alias("N"),
                            (F.sum(F.col("power_n") * F.col("power_mean")) / F.sum("power_n")).alias("mu"))
    # one row without groups; with groups their number grows with the data, so the
    # strategy is left to adaptive execution
    j = s.join(tot, g) if g else s.crossJoin(F.broadcast(tot))
    m = j.groupBy(*g).agg(
        F.first("mu").alias("mean_power"),
        F.sqrt((F.sum("power_m2") + F.sum(F.col("power_n") * (F.col("power_mean") - F.col("mu")) ** 2))
               / F.first("N")).alias("std_power"))
    return with_band(m, k)


def long_values(rows: DataFrame) -> DataFrame:
    """(day, timestamp, measure, value) for eligible readings."""
    return rows.select(DAY, TS, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES
    ])).alias("mv")).select(DAY, TS, "mv.measure", "mv.value")


def elig_counts(raw: DataFrame, anomalies: DataFrame, days: list, run: Column) -> DataFrame:
    """Eligible value counts of the given days, plus one marker row per day so
    that a day left with no eligible reading still replaces its partition."""
    e = eligible_rows(raw.select(DAY, TS, DEVICE, *MEASURES), anomalies) \
        .withColumn(DAY, F.to_date(TS))
    counts = long_values(e).groupBy(DAY, "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    spark = raw.sparkSession
    marks = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField(DAY, T.DateType())])) \
        .select(DAY, F.lit(None).cast("string").alias("measure"), F.lit(None).cast("double").alias("value"),
                F.lit(0).cast("long").alias("n"))
    return counts.unionByName(marks).withColumn("refreshed", run)


def signed(new: DataFrame, old: DataFrame) -> DataFrame:
    """(measure, value, n): what the counts of refreshed days add to the all-time counts, or take."""
    side = lambda d, sign: d.where(F.col("n") > 0).select("measure", "value", (F.col("n") * sign).alias("n"))
    return (side(new, 1).unionByName(side(old, -1)).groupBy("measure", "value").agg(F.sum("n").alias("n"))
            .where(F.col("n") != 0))


def counts_by_period(full: DataFrame, days: DataFrame, boundary: DataFrame | None, starts: list) -> DataFrame:
    """(measure, value, n, n0, n1, ...): the all-time count and one count per period.

    ``full`` holds all-time counts (measure, value, n), in as many signed parts as there are;
    ``days`` counts per day, of the days after the earliest start at least. ``starts`` holds
    (period, start datetime or None for all time). A day after the start's day lies wholly inside
    the look-back; the start's own day is counted from its eligible rows (``boundary``: day,
    timestamp, measure, value) with ``timestamp >= start``. Values whose counts cancel are gone.
    """
    none = F.lit(None).cast("long")

    def part(df, n, per):
        return df.select("measure", "value", n.alias("n"), *[
            (none if c is None else c).alias(f"n{i}") for i, c in enumerate(per)])

    n = F.col("n")
    parts = part(full, n, [n if s is None else None for _, s in starts])
    if any(s is not None for _, s in starts):
        parts = parts.unionByName(part(days.where(n > 0), none, [
            None if s is None else F.when(F.col(DAY) > F.lit(s.date()), n) for _, s in starts]))
        if boundary is not None:
            parts = parts.unionByName(part(boundary, none, [
                None if s is None else F.when((F.col(DAY) == F.lit(s.date())) & (F.col(TS) >= F.lit(s)), F.lit(1).cast("long"))
                for _, s in starts]))
    return parts.groupBy("measure", "value").agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", *[f"n{i}" for i in range(len(starts))])]).where(n > 0)
