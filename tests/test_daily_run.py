"""Three-run state test of the daily contract (first load, tail, nothing new)."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from tests.day_stats_check import assert_day_stats_match
from anemoi.plans.daily_run import run_daily
from anemoi.plans.store import TableStore

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def _rows(day, hours, turbines, power):
    out = []
    for h in hours:
        for t in turbines:
            out.append(f"2022-03-{day:02d} {h:02d}:00:00,{t},{10 + t},{100 + h},{power(day, h, t)}\n")
    return out


def _power(day, h, t):
    if (day, h, t) == (1, 5, 1):
        return "9.5"           # high outlier on the first load
    if (day, h, t) == (2, 3, 2):
        return "0.01"          # low outlier in the tail
    if (day, h, t) == (1, 7, 3):
        return ""              # missing power: imputed from the mean
    if (day, h, t) == (1, 9, 2):
        return "2.6"           # inside run 1's wide band, below run 2's narrower one
    return f"{3 + ((h + t) % 3) * 0.1:.2f}"


def _write(path, lines):
    with open(path, "w") as f:
        f.write(HEADER + "".join(lines))


def test_three_runs(spark, tmpdir_run):
    feed = os.path.join(tmpdir_run, "feed")
    os.makedirs(feed)
    root = os.path.join(tmpdir_run, "tables")
    arch = os.path.join(tmpdir_run, "archive")
    day1 = {g: _rows(1, range(24), ts, _power) for g, ts in ((1, [1, 2]), (2, [3]))}
    for g, lines in day1.items():
        _write(os.path.join(feed, f"data_group_{g}.csv"), lines)
    _write(os.path.join(feed, "other.csv"), day1[1][:3])  # ignored: wrong prefix

    r1 = run_daily(spark, feed, root, datetime(2022, 3, 2, 1), archive_dir=arch)
    st = TableStore(spark, root)
    assert r1.flag_days == 1
    assert r1.new_rows == 72 and r1.rejected == 0
    assert r1.baseline_source == "raw"
    assert st.read("raw").count() == 72
    anoms = st.read("anomalies").collect()
    assert [(a.turbine_id, a.power_output) for a in anoms] == [(1, 9.5)]
    clean = st.read("clean")
    assert clean.count() == 71
    imputed = clean.where((F.col("turbine_id") == 3) & (F.hour("timestamp") == 7)).first()
    assert imputed.power_output is not None
    tracker = st.read("tracker").orderBy("file_name").collect()
    assert [(t.file_name, t.last_record_csv_row_number) for t in tracker] == \
        [("data_group_1.csv", 48), ("data_group_2.csv", 24)]
    assert sorted(os.listdir(feed)) == ["other.csv"]
    assert len(os.listdir(arch)) == 2
    prof = st.read("profile").collect()
    assert {p.period for p in prof} == {"full_dataset", "last_4_weeks", "last_2_weeks",
                                         "last_1_week", "last_1_day"}
    summ = st.read("daily_summary").collect()
    assert len(summ) == 3
    assert_day_stats_match(spark, st)

    # Run 2: files re-delivered with one more day appended; one key repeated with new values.
    for g, ts in ((1, [1, 2]), (2, [3])):
        lines = day1[g] + _rows(2, range(24), ts, _power)
        if g == 2:
            lines.append("2022-03-02 10:00:00,3,11,111,3.05\n")   # same key again: later row wins
        _write(os.path.join(feed, f"data_group_{g}.csv"), lines)
    r2 = run_daily(spark, feed, root, datetime(2022, 3, 3, 1), archive_dir=arch)
    assert r2.new_rows == 73 and r2.baseline_source == "clean"
    assert r2.flag_days == 2
    raw = st.read("raw")
    assert raw.count() == 144
    again = raw.where((F.col("turbine_id") == 3) & (F.col("timestamp") == F.lit("2022-03-02 10:00:00").cast("timestamp_ntz"))).first()
    assert again.power_output == 3.05
    # first load rows keep their first insertion date
    assert raw.where(F.col("day") == F.lit("2022-03-01").cast("date")).select("insertion_date").distinct().count() == 1
    an = {(a.turbine_id, a.power_output) for a in st.read("anomalies").collect()}
    assert an == {(1, 9.5), (2, 2.6), (2, 0.01)}
    # The day-1 reading flagged in run 2 stays in clean
    assert st.read("clean").count() == 144 - len(an) + 1
    assert_day_stats_match(spark, st)
    tracker = st.read("tracker").collect()
    assert sorted(t.last_record_csv_row_number for t in tracker) == [24, 48, 49, 96]
    assert st.read("daily_summary").count() == 6
    assert st.read("profile").count() == 10

    # Run 3: nothing new -- ingestion finds no files, cleaning still runs.
    r3 = run_daily(spark, feed, root, datetime(2022, 3, 4, 1), archive_dir=arch)
    assert r3.files == [] and r3.new_rows == 0
    assert r3.cleaning == "done"
    assert st.read("raw").count() == 144
    assert st.read("clean").count() == 144 - len(an) + 1
    assert_day_stats_match(spark, st)
    runs = spark.read.parquet(st.path("runs")).orderBy("run_ts").collect()
    assert [r.baseline_source for r in runs] == ["raw", "clean", "clean"]
    assert runs[1].lower_bound == r2.band["lower_bound"] and runs[2].files == 0
    piv = st.read("anomaly_pivot")
    assert set(piv.columns) >= {"day", "Turbine_ID_1", "Turbine_ID_2"}
