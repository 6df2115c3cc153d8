from datetime import datetime

from pyspark.sql import functions as F

from anemoi.functions.expressions import ts_literal
from anemoi.operators.anomalies import anomaly_counts_long, anomaly_pivot, flag_outliers, pivot_cells
from anemoi.operators.baseline import bounds, high_water_mark

S = "timestamp timestamp_ntz, turbine_id long, wind_speed double, wind_direction double, power_output double"


def _raw(spark, rows):
    return spark.createDataFrame([(datetime(2022, 3, d, h), t, 1.0, 1.0, p) for d, h, t, p in rows], S)


def test_bounds_population_sigma(spark):
    df = _raw(spark, [(1, 0, 1, 1.0), (1, 1, 1, 2.0), (1, 2, 1, 3.0), (1, 3, 1, None)])
    b = bounds(df).first()
    assert abs(b.mean_power - 2.0) < 1e-12
    assert abs(b.std_power - (2 / 3) ** 0.5) < 1e-12    # population, not sample
    assert abs(b.lower_bound - (2.0 - 2 * (2 / 3) ** 0.5)) < 1e-12


def test_constant_power_has_no_band(spark):
    df = _raw(spark, [(1, 0, 1, 3.0), (1, 1, 1, 3.0)])
    assert bounds(df).count() == 0
    assert flag_outliers(df, bounds(df)).count() == 0
    nulls = _raw(spark, [(1, 0, 1, None)])
    assert bounds(nulls).count() == 0


def test_incremental_precedence_parity(spark):
    base = _raw(spark, [(1, h, 1, 3.0 + (h % 2) * 0.2) for h in range(20)])
    raw = _raw(spark, [(1, 0, 2, 0.5), (1, 1, 2, 9.0), (2, 0, 2, 0.5), (2, 1, 2, 9.0), (2, 2, 2, None)])
    cutoff = ts_literal(datetime(1, 1, 1).replace(year=2022, month=3, day=1, hour=12))
    got = sorted((r.timestamp.day, r.power_output) for r in flag_outliers(raw, bounds(base), cutoff).collect())
    # low ones over all history, high ones only after the cutoff; NULL never flagged
    assert got == [(1, 0.5), (2, 0.5), (2, 9.0)]
    both = sorted((r.timestamp.day, r.power_output)
                  for r in flag_outliers(raw, bounds(base), cutoff, scope="new_rows").collect())
    assert both == [(2, 0.5), (2, 9.0)]
    none_cut = flag_outliers(raw, bounds(base), F.lit(None).cast("timestamp_ntz")).collect()
    assert sorted(r.power_output for r in none_cut) == [0.5, 0.5]      # NULL cutoff: no high tail


def test_per_group_bounds(spark):
    rows = [(1, h, 1, 1.0 + (h % 2)) for h in range(10)] + [(1, h, 2, 100.0 + (h % 2) * 10) for h in range(10)]
    rows += [(2, 0, 1, 50.0), (2, 0, 2, 50.0)]
    df = _raw(spark, rows)
    got = sorted((r.turbine_id, r.power_output) for r in
                 flag_outliers(df, bounds(df, groups=["turbine_id"]), groups=["turbine_id"]).collect())
    assert got == [(1, 50.0), (2, 50.0)]


def test_counts_and_pivot(spark):
    df = _raw(spark, [(1, 0, 1, 1.0), (1, 1, 1, 1.0), (1, 2, 7, 1.0), (3, 0, 7, 1.0)])
    long = sorted((str(r.day), r.turbine_id, r.anomaly_count) for r in anomaly_counts_long(df).collect())
    assert long == [("2022-03-01", 1, 2), ("2022-03-01", 7, 1), ("2022-03-03", 7, 1)]
    piv = sorted(anomaly_pivot(df).collect())
    assert [tuple(r) for r in piv] == [(datetime(2022, 3, 1).date(), 2, 1), (datetime(2022, 3, 3).date(), 0, 1)]
    assert anomaly_pivot(df).columns == ["day", "Turbine_ID_1", "Turbine_ID_7"]
    assert anomaly_pivot(df.where(F.lit(False))).count() == 0
    assert high_water_mark(df).first()[0] == datetime(2022, 3, 3, 0)


def _dense(rows):
    """All cells of (day, device, count) rows by hand: a NULL day or device matches nothing."""
    n = {(d, i): c for d, i, c in rows if d is not None and i is not None}
    return {(d, None if i is None else f"Turbine_ID_{i}", n.get((d, i), 0))
            for d in {r[0] for r in rows} for i in {r[1] for r in rows}}


def _counts(spark, rows):
    return spark.createDataFrame(rows, "day date, turbine_id long, anomaly_count long")


def test_pivot_in_blocks_of_columns(spark):
    """Schema and plan do not grow with the devices; blocks stay small; all cells are there."""
    day = [datetime(2022, 3, d).date() for d in (1, 2, 5)]
    sizes = []
    for devices in (40, 4000):
        rows = [(day[i % 3], i * 7, 1 + i % 5) for i in range(devices)] + [(day[0], 1, 9)]
        wide = anomaly_pivot(None, counts=_counts(spark, rows), width=100)
        assert wide.columns == ["day", "block", "cells"]
        sizes.append(len(wide._jdf.queryExecution().analyzed().toString()))
        got = wide.collect()
        assert max(len(r.cells) for r in got) < 200 and len({(r.day, r.block) for r in got}) == len(got)
        cells = [tuple(c) for c in pivot_cells(wide).collect()]
        assert len(cells) == 3 * (devices + 1) and set(cells) == _dense(rows)
    assert sizes[1] < 1.1 * sizes[0]


def test_pivot_of_null_days_and_devices(spark):
    d1, d2 = datetime(2022, 3, 1).date(), datetime(2022, 3, 2).date()
    rows = [(d1, 1, 2), (d1, None, 3), (None, 1, 4), (d2, 7, 5), (None, None, 6)]
    for width in (1, 2, 1000):
        cells = [tuple(c) for c in pivot_cells(anomaly_pivot(None, counts=_counts(spark, rows), width=width)).collect()]
        assert len(cells) == 9 and set(cells) == _dense(rows)
    assert pivot_cells(anomaly_pivot(None, counts=_counts(spark, []), width=10)).count() == 0


def test_both_pivots_take_a_list_of_devices(spark):
    d1, d2 = datetime(2022, 3, 1).date(), datetime(2022, 3, 2).date()
    counts = _counts(spark, [(d1, 1, 2), (d1, 3, 4), (d2, 3, 5)])
    want = {(d1, "Turbine_ID_1", 2), (d1, "Turbine_ID_8", 0), (d2, "Turbine_ID_1", 0), (d2, "Turbine_ID_8", 0)}
    for width in (None, 1, 50):
        cells = [tuple(c) for c in pivot_cells(anomaly_pivot(None, [1, 8], counts, width)).collect()]
        assert len(cells) == 4 and set(cells) == want, width


def test_band_arithmetic_reproduces_logged_bounds(spark):
    """Fixed values: (mean, sigma, lower, upper) logged by three reference runs."""
    from anemoi.operators.baseline import with_band
    logged = [
        (3.0277329744831207, 1.2069551485571886, 0.6138226773687436, 5.441643271597497),
        (3.0017671329298454, 0.8699388594091308, 1.2618894141115837, 4.741644851748108),
        (3.001670220100295, 0.8697335510551618, 1.2622031179899715, 4.741137322210619),
    ]
    df = spark.createDataFrame([r[:2] for r in logged], "mean_power double, std_power double")
    got = [(r.lower_bound, r.upper_bound) for r in with_band(df, 2.0).collect()]
    assert got == [r[2:] for r in logged]
