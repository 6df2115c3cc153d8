"""Daily-run options and edge cases of the contract."""

import os
import random
from datetime import datetime

from pyspark.sql import functions as F

from anemoi.plans.daily_run import run_daily
from anemoi.plans.store import TableStore
from anemoi.schema import READINGS, Options
from tests.day_stats_check import assert_day_stats_match

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def _write(path, rows):
    with open(path, "w") as f:
        f.write(HEADER + "".join(rows))


def _day(day, power_of, turbines=(1, 2), slash=False):
    out = []
    for h in range(24):
        for t in turbines:
            ts = f"{day:02d}/03/2022 {h:02d}:00:00" if slash else f"2022-03-{day:02d} {h:02d}:00:00"
            out.append(f"{ts},{t},5,{h + 1},{power_of(day, h, t)}\n")
    return out


def _dirs(tmp):
    feed = os.path.join(tmp, "feed")
    os.makedirs(feed, exist_ok=True)
    return feed, os.path.join(tmp, "tables"), os.path.join(tmp, "archive")


def test_constant_power_skips_cleaning_but_summarises(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, lambda d, h, t: 3.0))
    r = run_daily(spark, feed, root, datetime(2022, 3, 2), archive_dir=arch)
    st = TableStore(spark, root)
    assert r.band is None and r.cleaning == "skipped"
    assert st.read("raw").count() == 48
    assert st.is_empty("clean") and st.is_empty("anomalies")
    assert st.read("daily_summary").count() == 0


def test_no_anomalies_gives_empty_pivot(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, lambda d, h, t: 3.0 + (h % 2) * 0.1))
    r = run_daily(spark, feed, root, datetime(2022, 3, 2), archive_dir=arch)
    st = TableStore(spark, root)
    assert r.cleaning == "done" and st.is_empty("anomalies")
    assert st.read("clean").count() == 48


def test_day_first_and_new_rows_scope(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)

    def p(d, h, t):
        if (d, h, t) == (1, 4, 1):
            return 0.2
        return 3.0 + ((h + t) % 3) * 0.1
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p, slash=True))
    opt = Options(day_first=True, outlier_scope="new_rows")
    run_daily(spark, feed, root, datetime(2022, 3, 2), opt, archive_dir=arch)
    st = TableStore(spark, root)
    days = {str(r.day) for r in st.read("raw").select("day").distinct().collect()}
    assert days == {"2022-03-01"}                                # 01/03 read as 1 March
    assert st.read("anomalies").count() == 1

    def p2(d, h, t):
        return 2.75 if (h, t) == (2, 2) else 3.0 + ((h + t) % 3) * 0.1
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p, slash=True) + _day(2, p2, slash=True))
    run_daily(spark, feed, root, datetime(2022, 3, 3), opt, archive_dir=arch)
    an = sorted((str(r.day), r.power_output) for r in st.read("anomalies").collect())
    # new_rows: the tighter band of run 2 only tests rows after the cutoff
    assert an == [("2022-03-01", 0.2), ("2022-03-02", 2.75)]
    assert_day_stats_match(spark, st)


def test_retract_and_per_device_bounds(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)

    def p(d, h, t):
        base = 3.0 if t == 1 else 30.0
        if (d, h, t) == (1, 6, 2):
            return 27.0                       # inside device 2's first band, outside its second
        if (d, h, t) == (1, 8, 1):
            return 9.0
        if (d, h, t) == (1, 10, 2):
            return 90.0                       # widens device 2's first band
        return base + (h % 3) * (0.1 if t == 1 else 1.0)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p))
    opt = Options(bound_groups=("turbine_id",), retract=True)
    run_daily(spark, feed, root, datetime(2022, 3, 2), opt, archive_dir=arch)
    st = TableStore(spark, root)
    first = {(r.turbine_id, r.power_output) for r in st.read("anomalies").collect()}
    assert (1, 9.0) in first and (2, 27.0) not in first
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p) + _day(2, p))
    run_daily(spark, feed, root, datetime(2022, 3, 3), opt, archive_dir=arch)
    an = {(r.turbine_id, r.power_output) for r in st.read("anomalies").collect()}
    assert (2, 27.0) in an
    clean = st.read("clean")
    # retract: the reading flagged in run 2 left clean
    assert clean.where((F.col("turbine_id") == 2) & (F.col("power_output") == 27.0)).count() == 0
    assert clean.count() == 96 - len(an)
    assert_day_stats_match(spark, st)


def test_dynamic_overwrite_keeps_other_days(spark, tmpdir_run):
    st = TableStore(spark, os.path.join(tmpdir_run, "tables"))
    assert st.read("raw").count() == 0 and not st.exists("raw")
    rows = [(datetime(2022, 3, d, 1), 1, 1.0, 1.0, float(d), datetime(2022, 3, 9), datetime(2022, 3, d).date())
            for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, st.read("raw").schema)
    st.overwrite_days("raw", df)
    st.overwrite_days("raw", spark.createDataFrame([rows[1][:4] + (20.0,) + rows[1][5:]], df.schema))
    got = sorted((str(r.day), r.power_output) for r in st.read("raw").collect())
    assert got == [("2022-03-01", 1.0), ("2022-03-02", 20.0), ("2022-03-03", 3.0)]
    st.drop_days("raw", [datetime(2022, 3, 3).date()])
    assert st.read("raw").count() == 2


def test_reflagged_rows_keep_their_date_when_not_refreshed(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)

    def p(d, h, t):
        if (d, h, t) == (1, 3, 1):
            return 0.1
        return 3.0 + ((h + t) % 3) * 0.1
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p))
    opt = Options(refresh_reflagged=False)
    run_daily(spark, feed, root, datetime(2022, 3, 2), opt, archive_dir=arch)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p) + _day(2, p))
    run_daily(spark, feed, root, datetime(2022, 3, 3), opt, archive_dir=arch)
    st = TableStore(spark, root)
    rows = st.read("anomalies").collect()
    assert [(str(r.day), str(r.insertion_date)) for r in rows] == [("2022-03-01", "2022-03-02 00:00:00")]
    run_daily(spark, feed, root, datetime(2022, 3, 4), Options(), archive_dir=arch)
    rows = st.read("anomalies").collect()
    assert [str(r.insertion_date) for r in rows] == ["2022-03-04 00:00:00"]     # parity refreshes


def test_storage_float_keeps_single_precision(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, lambda d, h, t: 3.1 + (h % 2) * 0.1))
    run_daily(spark, feed, root, datetime(2022, 3, 2), Options(storage_float=True), archive_dir=arch)
    st = TableStore(spark, root)
    vals = {r.power_output for r in st.read("raw").collect()}
    assert vals == {3.0999999046325684, 3.200000047683716}


def test_rejects_are_kept_with_their_text(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)
    rows = _day(1, lambda d, h, t: 3.0 + (h % 2) * 0.1) + ["yesterday,1,5,5,3.0\n", "2022-03-01 05:30:00,x,5,5,3\n"]
    _write(os.path.join(feed, "data_group_1.csv"), rows)
    r = run_daily(spark, feed, root, datetime(2022, 3, 2), archive_dir=arch)
    st = TableStore(spark, root)
    assert (r.new_rows, r.rejected) == (50, 2)
    rej = sorted((x.row_no, x.reject_reason) for x in st.read("rejects").collect())
    assert rej == [(49, "timestamp"), (50, "turbine_id")]
    assert st.read("tracker").first().last_record_csv_row_number == 50


def test_profile_methods_agree(spark, tmpdir_run):
    import math

    def p(d, h, t):
        return 9.0 if (d, h, t) == (1, 5, 1) else 2.5 + ((h * 7 + t + d) % 9) * 0.25

    profiles = {}
    for method in ("incremental", "distributed", "builtin"):
        sub = os.path.join(tmpdir_run, method)
        feed, root, arch = _dirs(sub)
        _write(os.path.join(feed, "data_group_1.csv"), _day(1, p) + _day(2, p))
        run_daily(spark, feed, root, datetime(2022, 3, 3), Options(profile_method=method), archive_dir=arch)
        st = TableStore(spark, root)
        profiles[method] = {r.period: r.asDict() for r in st.read("profile").drop("calculation_timestamp").collect()}
    base = profiles["incremental"]
    assert set(base) == {"full_dataset", "last_4_weeks", "last_2_weeks", "last_1_week", "last_1_day"}
    for m in ("distributed", "builtin"):
        assert set(profiles[m]) == set(base)
        for per, row in base.items():
            for c, v in row.items():
                if c != "period":
                    assert math.isclose(v, profiles[m][per][c], rel_tol=1e-9), (m, per, c)


def test_unrefreshed_mode_scans_only_changed_days(spark, tmpdir_run):
    def p(d, h, t):
        if (d, h, t) in ((1, 3, 1), (3, 5, 2)):
            return 0.1
        return 3.0 + ((h + t) % 3) * 0.1
    keys, flags = {}, {}
    for mode in (True, False):
        feed, root, arch = _dirs(os.path.join(tmpdir_run, str(mode)))
        opt = Options(refresh_reflagged=mode)
        rows, reports = [], []
        for d in (1, 2, 3, 4):
            if d < 4:
                rows += _day(d, p)
                _write(os.path.join(feed, "data_group_1.csv"), rows)
            reports.append(run_daily(spark, feed, root, datetime(2022, 3, d + 1), opt, archive_dir=arch))
        st = TableStore(spark, root)
        keys[mode] = sorted((str(r.timestamp), r.turbine_id) for r in st.read("anomalies").collect())
        flags[mode] = [r.flag_days for r in reports]
        assert_day_stats_match(spark, st)
    assert keys[True] == keys[False] and len(keys[True]) == 2
    # run 4 brings nothing new and keeps the band: no day is read, whether or not dates are refreshed
    assert flags[True][3] == flags[False][3] == 0


def test_low_outliers_of_old_days_are_refreshed_on_read(spark, tmpdir_run, monkeypatch):
    """Bounds that rise and fall from run to run, corrected rows, a repeated run time: keys, values and
    insertion dates are those of a run that scans and rewrites every day with a low reading."""
    from anemoi.plans.reflag import LowTail
    rng = random.Random(8)
    base = {(d, h, t): 3.0 + rng.random() * (0.1 + 0.5 * (d % 3)) - (rng.random() < 0.04) * rng.choice([0.6, 1.2, 2.5])
            for d in range(1, 6) for h in range(24) for t in (1, 2)}
    results, flags = {}, {}
    for mode in ("derived", "scanned"):
        if mode == "scanned":
            monkeypatch.setattr(LowTail, "tested", lambda self, changed: float("-inf"))
        feed, root, arch = _dirs(os.path.join(tmpdir_run, mode))
        st, rows, seen, days = TableStore(spark, root), [], [], []
        for d in range(1, 7):
            if d < 6:
                rows += _day(d, lambda *k: round(base[k], 3))
                if d == 4:       # corrections: one old low reading rises, another falls
                    rows += ["2022-03-02 03:00:00,1,5,5,3.05\n", "2022-03-01 04:00:00,2,5,5,0.3\n"]
                _write(os.path.join(feed, "data_group_1.csv"), rows)
            rep = run_daily(spark, feed, root, datetime(2022, 3, 4 if d == 4 else d + 1), archive_dir=arch)
            seen.append(sorted(map(str, st.read("anomalies").collect())))
            days.append(rep.flag_days)
        results[mode], flags[mode] = seen, days
    assert results["derived"] == results["scanned"]
    assert st.read("anomalies").columns == [f.name for f in READINGS.fields]
    assert sum(flags["derived"]) < sum(flags["scanned"])
    dates = {r.insertion_date for r in st.read("anomalies").collect()}
    assert len(dates) > 1                        # not every old low outlier is below the last bound


def test_imputation_map_and_period(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)

    def p(d, h, t):
        if (h, t) == (7, 1):
            return ""                                   # missing: imputed
        return 3.0 + (h % 4) * 0.25
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p))
    opt = Options(impute_with={"wind_speed": "mode", "wind_direction": "mean", "power_output": "median"},
                  impute_period="last_1_day")
    run_daily(spark, feed, root, datetime(2022, 3, 2), opt, archive_dir=arch)
    st = TableStore(spark, root)
    prof = {r.period: r for r in st.read("profile").collect()}["last_1_day"]
    row = st.read("clean").where("turbine_id = 1 AND hour(timestamp) = 7").first()
    assert row.power_output == prof.power_output_median


def test_no_archive_and_no_wide_pivot(spark, tmpdir_run):
    feed, root, arch = _dirs(tmpdir_run)

    def p(d, h, t):
        return 9.0 if (h, t) == (2, 1) else 3.0 + (h % 3) * 0.1
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, p))
    r = run_daily(spark, feed, root, datetime(2022, 3, 2), Options(archive=False, wide_pivot=False),
                  archive_dir=arch)
    st = TableStore(spark, root)
    assert r.archived == [] and os.listdir(feed) == ["data_group_1.csv"]
    assert st.read("anomalies").count() == 1
    assert st.exists("anomaly_counts") and not st.exists("anomaly_pivot")
    # the file stays; a second run reads nothing new from it
    r2 = run_daily(spark, feed, root, datetime(2022, 3, 3), Options(archive=False, wide_pivot=False),
                   archive_dir=arch)
    assert r2.new_rows == 0 and st.read("raw").count() == 48


def test_run_times_may_repeat_or_go_back(spark, tmpdir_run):
    """The ledger orders runs by number: the run time changes nothing but the stored dates."""
    def p(d, h, t):
        return 0.1 if (d, h, t) in ((1, 3, 1), (2, 5, 2)) else 3.0 + ((h + t) % 3) * 0.1
    tables = {}
    for name, second in (("later", datetime(2022, 3, 4)), ("equal", datetime(2022, 3, 3)), ("earlier", datetime(2022, 3, 1))):
        feed, root, arch = _dirs(os.path.join(tmpdir_run, name))
        _write(os.path.join(feed, "data_group_1.csv"), _day(1, p))
        run_daily(spark, feed, root, datetime(2022, 3, 3), archive_dir=arch)
        _write(os.path.join(feed, "data_group_1.csv"), _day(1, p) + _day(2, p))
        r = run_daily(spark, feed, root, second, archive_dir=arch)
        st = TableStore(spark, root)
        assert r.new_rows == 48 and r.cleaning == "done"
        assert st.read("clean").count() == 96 - st.read("anomalies").count()
        assert_day_stats_match(spark, st)
        tables[name] = {t: sorted(map(str, st.read(t).drop("insertion_date").collect()))
                        for t in ("raw", "clean", "anomalies", "daily_summary", "anomaly_counts")}
    assert tables["later"] == tables["equal"] == tables["earlier"]


def test_retract_empties_days_and_devices(spark, tmpdir_run):
    """Corrected readings of a whole day, and of a whole device on another, are flagged:
    both leave clean, its stats and the daily summary."""
    feed, root, arch = _dirs(tmpdir_run)
    steady = lambda d, h, t: 3.0 + ((h + t) % 3) * 0.1
    opt = Options(retract=True)
    _write(os.path.join(feed, "data_group_1.csv"), _day(1, steady) + _day(2, steady) + _day(3, steady))
    run_daily(spark, feed, root, datetime(2022, 3, 4), opt, archive_dir=arch)
    st = TableStore(spark, root)
    assert st.read("daily_summary").count() == 6
    bad = _day(1, lambda d, h, t: 0.01) + _day(2, lambda d, h, t: 0.01, turbines=(2,))
    _write(os.path.join(feed, "data_group_2.csv"), bad)
    run_daily(spark, feed, root, datetime(2022, 3, 5), opt, archive_dir=arch)
    clean = st.read("clean")
    assert clean.where(F.col("power_output") < 1).count() == 0
    left = {(str(r.day), r.turbine_id) for r in clean.select("day", "turbine_id").distinct().collect()}
    assert ("2022-03-01", 1) not in left and ("2022-03-01", 2) not in left and ("2022-03-02", 2) not in left
    assert {(str(r.day), r.turbine_id) for r in st.read("daily_summary").collect()} == left
    assert {(str(r.day), r.turbine_id) for r in st.read("clean_stats").collect()} == left
    assert_day_stats_match(spark, st)
