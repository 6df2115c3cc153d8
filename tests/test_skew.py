"""One device and one day holding a third of all rows: results stay whole and exact."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from anemoi.operators import daily_summary
from anemoi.plans.daily_run import run_daily
from anemoi.plans.store import TableStore
from tests.day_stats_check import assert_day_stats_match

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def test_hot_device_and_hot_day(spark, tmpdir_run):
    feed = os.path.join(tmpdir_run, "feed")
    os.makedirs(feed)
    rows = []
    # day 1: device 1 reports every minute (a third of all rows); others hourly over 6 days
    for m in range(24 * 60):
        p = 9.5 if m == 300 else 3.0 + (m % 5) * 0.05
        rows.append(f"2022-03-01 {m // 60:02d}:{m % 60:02d}:00,1,5,{m % 359 + 1},{p}\n")
    for d in range(1, 7):
        for h in range(24):
            for t in range(2, 12):
                p = 0.1 if (d, h, t) == (3, 4, 5) else 3.0 + ((h + t) % 4) * 0.05
                rows.append(f"2022-03-{d:02d} {h:02d}:00:00,{t},5,{h + 1},{p}\n")
    with open(os.path.join(feed, "data_group_1.csv"), "w") as f:
        f.write(HEADER + "".join(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")    # many splits
    try:
        r = run_daily(spark, feed, os.path.join(tmpdir_run, "tables"), datetime(2022, 3, 8),
                      archive_dir=os.path.join(tmpdir_run, "archive"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    st = TableStore(spark, os.path.join(tmpdir_run, "tables"))
    assert r.new_rows == len(rows) == 1440 + 6 * 24 * 10
    assert st.read("raw").count() == len(rows)
    an = {(a.turbine_id, a.power_output) for a in st.read("anomalies").collect()}
    assert an == {(1, 9.5), (5, 0.1)}
    assert st.read("clean").count() == len(rows) - 2
    got = sorted(map(tuple, st.read("daily_summary").select(
        "day", "turbine_id", "min_power_output", "max_power_output", "avg_power_output").collect()))
    assert got == sorted(map(tuple, daily_summary(st.read("clean")).collect()))
    hot = st.read("daily_summary").where((F.col("turbine_id") == 1)).first()
    assert hot.max_power_output < 9.5
    assert_day_stats_match(spark, st)


def test_hot_day_is_split_across_files(spark, tmpdir_run):
    """The rebalance hint lets AQE split one heavy day into several write tasks."""
    st = TableStore(spark, os.path.join(tmpdir_run, "tables"))
    rows = spark.range(200000).select(
        (F.lit("2022-03-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("id"))).alias("timestamp"),
        (F.col("id") % 7).alias("turbine_id"),
        F.lit(5.0).alias("wind_speed"), F.lit(90.0).alias("wind_direction"),
        (F.col("id") % 97).cast("double").alias("power_output"),
        F.lit("2022-03-10 00:00:00").cast("timestamp_ntz").alias("insertion_date"),
        F.lit("2022-03-01").cast("date").alias("day"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "262144")
    try:
        st.overwrite_days("raw", rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(os.path.join(st.path("raw"), "day=2022-03-01")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert st.read("raw").count() == 200000
