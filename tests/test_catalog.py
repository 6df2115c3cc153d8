"""Every catalogue query against its DuckDB oracle on the smallest driver tables,
plus plan properties that matter at scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from anemoi.plans.catalog import QUERIES
from anemoi.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(recs, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in recs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    """Values, and their text: column types must print the same way in both client
    libraries. The oracle must also make a view, as the driver does."""
    df = QUERIES[name](spark, SF)
    pdf = df.toPandas()
    duck.sql(ORACLE_SQL[name]).create_view(f"oracle_{name}")
    ddf = duck.sql(f"FROM oracle_{name}").df()
    cols = sorted(df.columns)
    assert cols == sorted(ddf.columns)
    assert _rows(pdf.to_dict("records"), cols) == _rows(ddf.to_dict("records"), cols)
    assert _text_rows(pdf, cols) == _text_rows(ddf, cols)


def test_catalogue_leaves_nothing_persisted(spark):
    for fn in QUERIES.values():
        fn(spark, SF)
    assert spark._jsc.sc().getPersistentRDDs().isEmpty()
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_wide_pivot_of_readings_without_device_or_time(spark, tmp_path):
    """NULL devices and times are columns and days like others, as in the SQL."""
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id,
                                            CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts)
                          FROM '{SF}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    want = con.sql(ORACLE_SQL["anomaly_pivot"]).fetchall()
    got = [tuple(r) for r in QUERIES["anomaly_pivot"](spark, str(tmp_path)).collect()]
    assert any(c is None for _, c, _ in want) and any(d is None for d, _, _ in want)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_wide_pivot_collects_no_devices(spark):
    """No expression per device: neither a wide schema nor a list of ids is in the plan."""
    plan = QUERIES["anomaly_pivot"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Turbine_ID_1" not in plan and "from_json" not in plan.lower()


PROFILED = ("period_profile", "clean", "daily_summary", "profile_from_day_counts")


def test_most_queries_are_built_without_a_job(spark):
    """Only the wide pivot (columns), row numbers (sorted rows) and what reads a profile (band, sorted
    counts) run jobs to build."""
    tracker = spark.sparkContext.statusTracker()
    for name, fn in QUERIES.items():
        fn(spark, SF)                                     # schemas are read once
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"build-{name}")
                  for s in tracker.getJobInfo(j).stageIds]
        data = [s for s in stages if s is not None and "parquet at" not in s.name]
        assert not data or name in ("anomaly_pivot", "tail_scan", *PROFILED), (name, data)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", PROFILED)
def test_profile_queries_read_the_source_a_few_times(spark, monkeypatch, name):
    """Scans of ``events`` over all written steps and the query itself: the band, the anomalies,
    the counted readings, and for what is built on the profile the cleaned readings."""
    from anemoi import scratch
    from anemoi.operators import order_stats
    from anemoi.plans import catalog
    plans = []

    def written(df, name, path=None):
        plans.append(_plan(df))
        return scratch.written(df, name, path)

    monkeypatch.setattr(order_stats, "written", written)
    monkeypatch.setattr(catalog, "written", written)
    plans.append(_plan(QUERIES[name](spark, SF)))
    scans = 1 + sum(p.count("events.parquet") for p in plans)           # 1: the collected band
    assert scans <= (3 if "profile" in name else 4), [p.count("events.parquet") for p in plans]
    assert sum(p.count("Exchange ") for p in plans) <= 14


def test_keyed_queries_do_not_aggregate_by_sorting(spark):
    for name, sorts in (("latest_per_key", 2), ("latest_profile", 2), ("upsert", 4), ("insert_ignore", 9)):
        plan = _plan(QUERIES[name](spark, SF))
        assert "SortAggregate" not in plan and plan.count(" Sort [") + plan.count("- Sort [") <= 2 * sorts, name


def test_no_final_stage_in_one_task(spark):
    for name in ("anomaly_pivot", "distinct_ids"):
        assert "Coalesce 1" not in _plan(QUERIES[name](spark, SF))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["day", "turbine_id", "min_power_output", "max_power_output", "avg_power_output"]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_plan(spark):
    for name, fn in QUERIES.items():
        p = _plan(fn(spark, SF))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_band_filter_reaches_the_scan(spark, tmpdir_run):
    from anemoi.adapters import telemetry
    from anemoi.operators import bounds, flag_outliers
    path = os.path.join(tmpdir_run, "raw")
    telemetry(spark.read.parquet(f"{SF}/events.parquet")).write.parquet(path)
    raw = spark.read.parquet(path)
    lazy = _plan(flag_outliers(raw, bounds(raw)))
    assert "Subquery subquery" in lazy and ".lower_bound" in lazy     # two subqueries merged into one
    b = bounds(raw).first()
    s = _plan(flag_outliers(raw, (b.lower_bound, b.upper_bound)))
    assert "PushedFilters: [Or(LessThan(power_output," in s


def test_projection_is_pruned(spark):
    s = _plan(QUERIES["high_water_mark"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in s


def _text_rows(pdf, cols):
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False):
        row = []
        for v in rec:
            if v is None or (isinstance(v, float) and math.isnan(v)):
                row.append("None")
            elif isinstance(v, float):
                row.append(repr(round(v, 6)))
            else:
                row.append(str(v))
        out.append(tuple(row))
    return sorted(out)
