"""Query catalogue over the driver tables: every operator as one DataFrame.

Each entry takes ``(spark, sf_dir)``, reads whole tables and returns a lazy
DataFrame; nothing is persisted and no job runs while it is built, but for the ones
that write steps of their own: the wide pivot (its counts, written once), row numbers (the
sorted rows, written once) and what reads a profile (the band, the look-back starts, and the
sorted value counts, written once). The chain adapter -> bounds -> anomalies -> profile -> clean -> summaries is a first daily run on the
``telemetry`` adapter of ``events``.
Computed doubles are rounded to 6 places for comparison with other engines.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoi.adapters import telemetry, telemetry_two_sided
from anemoi.functions.expressions import missing_as_null, ts_literal
from anemoi.operators import (
    anomaly_counts_long, anomaly_pivot, bounds, clean_rows, daily_summary, distinct_ids,
    eligible_rows, flag_outliers, high_water_mark, insert_ignore, latest_per_key,
    period_profile, pivot_cells, upsert,
)
from anemoi.operators.anomalies import PIVOT_WIDTH
from anemoi.operators.baseline import band_of
from anemoi.operators.profile import profile_from_counts
from anemoi.plans.day_stats import bounds_from_stats, clean_stats, counts_by_period, long_values
from anemoi.schema import KEY, MEASURES, PERIODS, POWER, STATS, TS
from anemoi.scratch import written
from anemoi.sources.csv_feed import parse_readings, split_valid
from anemoi.sources.feed_state import feed_state, number_rows, tail_rows

# --- fixed values of the catalogue -------------------------------------------
RUN_TS = datetime(2024, 2, 1)          # calculation time stamped on profiles
SPLIT_TS = "2024-01-21 00:00:00"       # "previous run" boundary on events
SPLIT_DAY = "1998-01-01 00:00:00"      # two deliveries of lineitem
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_SEQ = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
# ------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_text(df: DataFrame, col: str = "day") -> DataFrame:
    """Present a DATE column as ISO text: the same value in every client library
    (pandas turns DATE into objects on one side and datetime64 on the other)."""
    return df.withColumn(col, F.date_format(F.col(col), "yyyy-MM-dd"))


def rounded(df: DataFrame, cols=None, digits: int = 6) -> DataFrame:
    """Round double columns (all by default) for cross-engine comparison."""
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    cols = dbl if cols is None else set(cols) & dbl
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def moment(at: datetime | None):
    return F.lit(None).cast("timestamp_ntz") if at is None else ts_literal(at)


class FirstRun:
    """Frames of one first daily run over the telemetry adapter; each stage is built
    on first use, so a query pays only for what it reads. What comes after the profile
    reads the anomalies and the profile's sorted value counts from written tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, method: str = "distributed"):
        self.raw = telemetry(table(spark, sf_dir, "events"))
        self.method = method

    @cached_property
    def bounds(self) -> DataFrame:
        return bounds(self.raw)

    @cached_property
    def anomalies(self) -> DataFrame:
        return flag_outliers(self.raw, self.bounds)

    @cached_property
    def collected(self) -> tuple:
        """(band or None, anchor) as a daily run collects them: one row from one scan."""
        r = self.raw.agg(F.avg(POWER).alias("mean"), F.stddev_pop(POWER).alias("std"), F.max(TS).alias("anchor")).first()
        return band_of(r["mean"], r["std"]), r["anchor"]

    @cached_property
    def anomaly_table(self) -> DataFrame:
        """The anomalies' keys as a table of their own, as a daily run reads them."""
        band, _ = self.collected
        flagged = flag_outliers(self.raw, band) if band else self.raw.where(F.lit(False))
        return written(flagged.select(*KEY), "anomalies")

    @cached_property
    def profile(self) -> DataFrame:
        return period_profile(self.raw, self.anomaly_table, method=self.method, anchor=moment(self.collected[1])) \
            .withColumn("calculation_timestamp", ts_literal(RUN_TS))

    @cached_property
    def clean(self) -> DataFrame:
        return clean_rows(self.raw, self.anomaly_table, self.profile, "full_dataset")


# --- queries -------------------------------------------------------------------

def q_normalise_missing(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     *[missing_as_null(c).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])


def events_as_text(events: DataFrame) -> DataFrame:
    """The sensor adapter as CSV-like text. Error records carry a garbled time
    stamp (``n/a <time>``), so every row is validated and those are rejected."""
    return events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("n/a "), F.col("ts").cast("string")))
         .otherwise(F.col("ts").cast("string")).alias(TS),
        F.col("user_id").cast("string").alias("turbine_id"),
        F.get_json_object("props", "$.k").alias("wind_speed"),
        (F.col("event_id") % 360).cast("string").alias("wind_direction"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
         .otherwise(F.col("value").cast("string")).alias("power_output"))


def q_valid_rows(spark, sf_dir):
    parsed = parse_readings(events_as_text(table(spark, sf_dir, "events")))
    valid, _rejects = split_valid(parsed)
    return valid


def q_high_water_mark(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return high_water_mark(ev.where(F.col("ts") < ts_literal(SPLIT_TS)), "ts")


def q_baseline_bounds(spark, sf_dir):
    return rounded(bounds(telemetry(table(spark, sf_dir, "events"))))


def q_anomalies_full(spark, sf_dir):
    return FirstRun(spark, sf_dir).anomalies


def q_anomalies_incremental(spark, sf_dir):
    raw = telemetry_two_sided(table(spark, sf_dir, "events"))
    prev_clean = raw.where(F.col(TS) < ts_literal(SPLIT_TS))
    cutoff = prev_clean.select(F.max(TS)).scalar()
    return flag_outliers(raw, bounds(prev_clean), cutoff=cutoff, scope="parity")


def q_eligible_rows(spark, sf_dir):
    r = FirstRun(spark, sf_dir)
    return eligible_rows(r.raw, r.anomalies)


def q_period_profile(spark, sf_dir):
    p = FirstRun(spark, sf_dir).profile
    return rounded(p.select("period", *[f"{m}_{s}" for m in MEASURES for s in STATS]))


def q_latest_profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return latest_per_key(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"])


def q_clean(spark, sf_dir):
    return rounded(FirstRun(spark, sf_dir).clean)


def q_daily_summary(spark, sf_dir):
    return day_text(rounded(daily_summary(FirstRun(spark, sf_dir).clean)))


def q_anomaly_counts_long(spark, sf_dir):
    return day_text(anomaly_counts_long(FirstRun(spark, sf_dir).anomalies))


def q_anomaly_pivot(spark, sf_dir):
    """The wide pivot in blocks of columns, all its cells as rows (zeros included)."""
    long = written(anomaly_counts_long(FirstRun(spark, sf_dir).anomalies), "anomaly-counts")
    return day_text(pivot_cells(anomaly_pivot(None, counts=long, width=PIVOT_WIDTH)))


def q_bounds_from_stats(spark, sf_dir):
    """The band as a daily run takes it: merged from per-day, per-device moments."""
    raw = FirstRun(spark, sf_dir).raw
    readings = raw.withColumn("insertion_date", ts_literal(RUN_TS)).withColumn("day", F.to_date(TS))
    return rounded(bounds_from_stats(clean_stats(readings)))


def q_profile_from_day_counts(spark, sf_dir):
    """The profile as a daily run takes it: per-day value counts, merged per look-back."""
    r = FirstRun(spark, sf_dir)
    anchor = r.collected[1]
    elig = eligible_rows(r.raw, r.anomaly_table).withColumn("day", F.to_date(TS))
    starts = [(name, None if lb is None or anchor is None else anchor - lb) for name, lb in PERIODS]
    edge = sorted({s.date() for _, s in starts if s is not None})
    # readings of a start's own day stay single rows: their time decides
    counts = (long_values(elig)
              .groupBy("day", "measure", "value", F.when(F.col("day").isin(edge), F.col(TS)).alias(TS))
              .agg(F.count(F.lit(1)).alias("n")))
    counts = written(counts, "day-counts")
    at_start = counts.where(F.col(TS).isNotNull())
    p = profile_from_counts(counts_by_period(counts, counts, at_start, starts), [name for name, _ in starts])
    return rounded(p.select("period", *[f"{m}_{s}" for m in MEASURES for s in STATS]))


def q_distinct_ids(spark, sf_dir):
    return distinct_ids(FirstRun(spark, sf_dir).anomalies)


def _line_slices(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    cut = ts_literal(SPLIT_DAY)
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


def q_upsert(spark, sf_dir):
    first, second = _line_slices(spark, sf_dir)
    empty = spark.createDataFrame([], first.schema)
    day1 = upsert(empty, first, LINE_KEY, seq=LINE_SEQ)
    return upsert(day1, second, LINE_KEY, seq=LINE_SEQ)


def q_insert_ignore(spark, sf_dir):
    first, second = _line_slices(spark, sf_dir)
    empty = spark.createDataFrame([], first.schema)
    day1 = insert_ignore(empty, first, LINE_KEY, seq=LINE_SEQ)
    day2 = insert_ignore(day1, second, LINE_KEY, seq=LINE_SEQ)
    return day1.unionByName(day2)


def q_latest_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"], ["ts", "event_id", "event_type", "value"])


def q_feed_state(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    st = feed_state(ev, ts_literal(RUN_TS), file_col="event_type", order_col="event_id", ts_col="ts")
    return st.drop("data_insertion_date")


def q_tail_scan(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    offsets = ev.groupBy("event_type").agg(
        F.count_if(F.col("ts") < ts_literal(SPLIT_TS)).alias("offset"))
    offsets = offsets.select(F.col("event_type").alias("file_name"),
                             F.col("offset").alias("last_record_csv_row_number"))
    rows = number_rows(ev, "event_type", "event_id")
    return tail_rows(rows, offsets, file_col="event_type") \
        .select("event_id", "ts", "user_id", "event_type", "value")


QUERIES = {
    "normalise_missing": q_normalise_missing,
    "valid_rows": q_valid_rows,
    "high_water_mark": q_high_water_mark,
    "baseline_bounds": q_baseline_bounds,
    "anomalies_full": q_anomalies_full,
    "anomalies_incremental": q_anomalies_incremental,
    "eligible_rows": q_eligible_rows,
    "period_profile": q_period_profile,
    "latest_profile": q_latest_profile,
    "clean": q_clean,
    "daily_summary": q_daily_summary,
    "anomaly_counts_long": q_anomaly_counts_long,
    "anomaly_pivot": q_anomaly_pivot,
    "bounds_from_stats": q_bounds_from_stats,
    "profile_from_day_counts": q_profile_from_day_counts,
    "distinct_ids": q_distinct_ids,
    "upsert": q_upsert,
    "insert_ignore": q_insert_ignore,
    "latest_per_key": q_latest_per_key,
    "feed_state": q_feed_state,
    "tail_scan": q_tail_scan,
}
