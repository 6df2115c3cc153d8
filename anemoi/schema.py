"""Table schemas, key and measure names, and run options."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import types as T

# --- fixed values: names and look-backs that results depend on -------------
TS = "timestamp"
DEVICE = "turbine_id"
KEY = (TS, DEVICE)
MEASURES = ("wind_speed", "wind_direction", "power_output")
POWER = "power_output"
INSERTED = "insertion_date"
DAY = "day"
FEED_PREFIX = "data_group_"
PIVOT_PREFIX = "Turbine_ID_"

# Look-back periods of the profile, in this order; None = whole history.
PERIODS = (
    ("full_dataset", None),
    ("last_4_weeks", timedelta(weeks=4)),
    ("last_2_weeks", timedelta(weeks=2)),
    ("last_1_week", timedelta(weeks=1)),
    ("last_1_day", timedelta(days=1)),
)
# Imputation: which profile statistic fills which measure.
IMPUTE_WITH = {"wind_speed": "median", "wind_direction": "median", "power_output": "mean"}
STATS = ("mean", "median", "mode")
# ---------------------------------------------------------------------------

TELEMETRY = T.StructType([
    T.StructField(TS, T.TimestampNTZType(), False),
    T.StructField(DEVICE, T.LongType(), False),
    T.StructField("wind_speed", T.DoubleType(), True),
    T.StructField("wind_direction", T.DoubleType(), True),
    T.StructField("power_output", T.DoubleType(), True),
])

# raw, clean and anomalies share one layout, stored partitioned by day.
READINGS = T.StructType(TELEMETRY.fields + [
    T.StructField(INSERTED, T.TimestampNTZType(), True),
    T.StructField(DAY, T.DateType(), True),
])

# As stored: the run that wrote the row; readers get READINGS (see plans/reflag.py).
ANOMALIES = T.StructType(READINGS.fields + [T.StructField("flag_seq", T.LongType(), True)])

TRACKER = T.StructType([
    T.StructField("data_insertion_date", T.TimestampNTZType(), True),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("last_record_timestamp", T.TimestampNTZType(), True),
    T.StructField("last_record_csv_row_number", T.LongType(), True),
    T.StructField("run_seq", T.LongType(), True),
])

PROFILE = T.StructType(
    [T.StructField("period", T.StringType(), False)]
    + [T.StructField(f"{m}_{s}", T.DoubleType(), True) for m in MEASURES for s in STATS]
    + [T.StructField("calculation_timestamp", T.TimestampNTZType(), True),
       T.StructField("run_seq", T.LongType(), True)]
)

DAILY_SUMMARY = T.StructType([
    T.StructField(DAY, T.DateType(), False),
    T.StructField(DEVICE, T.LongType(), False),
    T.StructField("min_power_output", T.DoubleType(), True),
    T.StructField("max_power_output", T.DoubleType(), True),
    T.StructField("avg_power_output", T.DoubleType(), True),
    T.StructField(INSERTED, T.TimestampNTZType(), True),
])

# CSV feed: every field read as text so that bad values become rejects, not job failures.
CSV_TEXT = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in (TS, DEVICE) + MEASURES]
    + [T.StructField("_corrupt_record", T.StringType(), True)]
)

ANOMALY_COUNTS = T.StructType([
    T.StructField(DAY, T.DateType(), False),
    T.StructField(DEVICE, T.LongType(), False),
    T.StructField("anomaly_count", T.LongType(), False),
])

RUNS = T.StructType([
    T.StructField("run_ts", T.TimestampNTZType(), False),
    T.StructField("files", T.LongType(), True),
    T.StructField("new_rows", T.LongType(), True),
    T.StructField("rejected", T.LongType(), True),
    T.StructField("baseline_source", T.StringType(), True),
    T.StructField("mean_power", T.DoubleType(), True),
    T.StructField("std_power", T.DoubleType(), True),
    T.StructField("lower_bound", T.DoubleType(), True),
    T.StructField("upper_bound", T.DoubleType(), True),
    T.StructField("cleaning", T.StringType(), True),
    T.StructField("timings", T.StringType(), True),
    T.StructField("run_seq", T.LongType(), True),
    # the lower bound was tested over all history, and refreshed insertion dates
    T.StructField("low_tested", T.BooleanType(), True),
    T.StructField("low_refreshed", T.BooleanType(), True),
])

TABLES = {
    "raw": READINGS,
    "clean": READINGS,
    "anomalies": ANOMALIES,
    "tracker": TRACKER,
    "profile": PROFILE,
    "daily_summary": DAILY_SUMMARY,
    "anomaly_counts": ANOMALY_COUNTS,
}
DAY_PARTITIONED = ("raw", "clean", "anomalies", "daily_summary", "anomaly_counts")


@dataclass(frozen=True)
class Options:
    """Switches for the behaviours where the contract allows a choice."""

    k_sigma: float = 2.0
    # "parity": low outliers over all history, high ones after the cutoff only.
    # "new_rows": the cutoff applies to both tails.
    outlier_scope: str = "parity"
    # Group columns for the baseline; () = one global mean/sigma.
    bound_groups: tuple = ()
    # Also drop already-clean rows that are flagged later.
    retract: bool = False
    # Re-flagged anomalies get a fresh insertion date (reference behaviour); for low
    # outliers it is derived on read. False keeps the date of the run that wrote them.
    refresh_reflagged: bool = True
    zero_is_missing: bool = True
    day_first: bool = False
    impute_period: str = "full_dataset"
    # Which profile statistic fills which measure.
    impute_with: dict = field(default_factory=lambda: dict(IMPUTE_WITH))
    # Profile in the daily run. "incremental": per-day value counts, rebuilt for
    # changed days only; "distributed": full recompute from value counts (bounded
    # task state); "builtin": Spark's median()/mode() over all eligible rows
    # (state grows with distinct values per period).
    profile_method: str = "incremental"
    feed_glob: str = FEED_PREFIX + "*.csv"
    archive: bool = True
    # Also write the wide anomaly pivot (one column per device) next to the long counts.
    wide_pivot: bool = True
    # Store measures at single precision (the values a FLOAT column keeps).
    storage_float: bool = False
    periods: tuple = field(default=PERIODS)
