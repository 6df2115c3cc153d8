"""Mean / median / mode per look-back period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemoi.operators.order_stats import PART, sorted_values, weights_before
from anemoi.schema import KEY, MEASURES, PERIODS, STATS, TS


def eligible_rows(raw: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Complete readings (three measures present) that are not anomalies."""
    complete = raw.where(F.col(MEASURES[0]).isNotNull() & F.col(MEASURES[1]).isNotNull()
                         & F.col(MEASURES[2]).isNotNull()).select(*KEY, *MEASURES)
    return complete.join(anomalies.select(*KEY), list(KEY), "left_anti")


def period_starts(anchor: Column, periods=PERIODS) -> list[tuple[str, Column | None]]:
    """Inclusive start of each look-back, anchored at ``anchor`` (max raw timestamp)."""
    return [(name, None if lb is None else anchor - F.lit(lb)) for name, lb in periods]


def _wide(stats: DataFrame) -> DataFrame:
    """(period, measure, mean, median, mode) -> one row per period."""
    cols = [F.max(F.when(F.col("measure") == m, F.col(s))).alias(f"{m}_{s}")
            for m in MEASURES for s in STATS]
    return stats.groupBy("period").agg(*cols)


def period_profile(raw: DataFrame, anomalies: DataFrame, periods=PERIODS,
                   method: str = "distributed", anchor: Column | None = None) -> DataFrame:
    """One row per non-empty period: mean, exact median (middle pair averaged)
    and mode (smallest value among ties) of each measure over the eligible rows
    with ``timestamp >= anchor - look_back``.

    ``distributed`` counts each (measure, value) once, with one count per period in the same
    row (no per-period copies of the readings), sorts and writes those counts once and takes all
    statistics of all periods from them (:func:`profile_from_counts`).
    ``builtin`` uses Spark's ``median``/``mode`` aggregates.
    """
    if anchor is None:
        anchor = raw.select(F.max(TS)).scalar()
    starts = period_starts(anchor, periods)
    elig = eligible_rows(raw, anomalies)
    if method == "builtin":
        return _builtin(elig, starts)
    if method != "distributed":
        raise ValueError(f"unknown profile method {method!r}")
    return profile_from_counts(period_value_counts(elig, starts), [name for name, _ in starts])


def period_value_counts(elig: DataFrame, starts) -> DataFrame:
    """(measure, value, n0, n1, ...): each (measure, value) counted once, the counts of the
    periods side by side."""
    long = elig.select(TS, F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES
    ])).alias("mv")).select(TS, "mv.measure", "mv.value")
    inside = [F.lit(True) if s is None else F.col(TS) >= s for _, s in starts]
    return long.groupBy("measure", "value").agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(inside)])


def profile_from_counts(counts: DataFrame, periods: list[str]) -> DataFrame:
    """:func:`profile_from_sorted` of (measure, value, n0, n1, ...), sorted and written once."""
    return profile_from_sorted(sorted_values(counts, ["measure"], "value"), periods)


def profile_from_sorted(rows: DataFrame, periods: list[str]) -> DataFrame:
    """Mean, exact median and mode per period and measure, one row per non-empty period, from
    (measure, value, n0, n1, ...) in written order with partition numbers.

    One aggregate per partition gives weights, sums and top counts; these name the partitions
    that hold the middle ranks and, as values ascend, the first partition with the top count,
    which holds the mode. One more read of the named partitions yields both. Partition rows are
    few: three measures a partition at most.
    """
    per = rows.groupBy("measure", PART).agg(*[f(i) for i in range(len(periods)) for f in (
        lambda i: F.sum(f"n{i}").alias(f"s{i}"), lambda i: F.sum(F.col("value") * F.col(f"n{i}")).alias(f"v{i}"),
        lambda i: F.max(f"n{i}").alias(f"m{i}"))])
    by_period = F.explode(F.array(*[F.struct(
        F.lit(p).alias("period"), F.lit(i).alias("i"), F.col(f"s{i}").alias("s"), F.col(f"v{i}").alias("v"), F.col(f"m{i}").alias("m"))
        for i, p in enumerate(periods)]))
    g = ["period", "measure"]
    per = per.select("measure", PART, by_period.alias("x")).select("measure", PART, "x.*").where(F.col("s") > 0)
    per = weights_before(per, g, "s").withColumns({
        "mean": F.sum("v").over(Window.partitionBy(*g)) / F.col("_total"),
        "top": F.max("m").over(Window.partitionBy(*g))})
    first_top = F.min(F.when(F.col("m") == F.col("top"), F.col(PART))).over(Window.partitionBy(*g))
    per = per.withColumn("top_part", first_top)
    holds = lambda k: (F.col("_before") <= k) & (k < F.col("_before") + F.col("s"))
    lo, hi = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    hits = per.where(holds(lo) | holds(hi) | (F.col(PART) == F.col("top_part"))).select(
        *g, PART, "i", "_before", lo.alias("lo"), hi.alias("hi"), "mean",
        F.when(F.col(PART) == F.col("top_part"), F.col("top")).alias("top"))
    # at most three rows per period and measure, hence the broadcast
    n = F.element_at(F.array(*[F.col(f"n{i}") for i in range(len(periods))]), F.col("i") + 1)
    # three partitions' rows a task; one shuffle serves the running sums and the aggregate
    near = rows.join(F.broadcast(hits), ["measure", PART]).withColumn("n", n).where(F.col("n") > 0).repartition(*g)
    run = Window.partitionBy(*g, PART).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("end", F.col("_before") + F.sum("n").over(run))
    at = lambda k: F.max(F.when((F.col("end") - F.col("n") <= k) & (k < F.col("end")), F.col("value")))
    stats = near.groupBy(*g).agg(
        F.first("mean").alias("mean"), at(F.col("lo")).alias("lo_v"), at(F.col("hi")).alias("hi_v"),
        F.min(F.when(F.col("n") == F.col("top"), F.col("value"))).alias("mode"))
    return _wide(stats.select(*g, "mean", (F.col("lo_v") + (F.col("hi_v") - F.col("lo_v")) * 0.5).alias("median"), "mode"))


def _builtin(elig: DataFrame, starts) -> DataFrame:
    sel = F.explode(F.array(*[
        F.struct(F.lit(name).alias("period"), (s if s is not None else F.lit(None).cast("timestamp_ntz")).alias("start"))
        for name, s in starts])).alias("p")
    x = elig.select(TS, *MEASURES, sel).where(F.col("p.start").isNull() | (F.col(TS) >= F.col("p.start")))
    aggs = []
    for m in MEASURES:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.median(m).alias(f"{m}_median"),
                 F.mode(m, deterministic=True).alias(f"{m}_mode")]
    return x.groupBy(F.col("p.period").alias("period")).agg(*aggs)
