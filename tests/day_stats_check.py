"""Check the per-day tables of a store against full recomputes."""

from pyspark.sql import functions as F

from anemoi.functions.expressions import ts_literal
from anemoi.operators import anomaly_counts_long, bounds, period_profile
from anemoi.plans.day_stats import bounds_from_stats, elig_counts


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(a), abs(b))


def assert_day_stats_match(spark, st):
    raw, anoms, clean = st.read("raw"), st.read("anomalies"), st.read("clean")
    full = elig_counts(raw, anoms, [], F.lit(None).cast("timestamp_ntz")).where("n > 0") \
        .select("day", "measure", "value", "n")
    kept = st.read("elig_counts").where("n > 0").select("day", "measure", "value", "n")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, kept.collect()))

    gens = st.generations("all_counts")
    assert len(gens) == 1
    ever = st.spark.read.parquet(st.path(f"all_counts/{gens[0]}")).select("measure", "value", "n")
    assert sorted(map(tuple, ever.collect())) == sorted(map(tuple, full.groupBy("measure", "value").agg(F.sum("n")).collect()))

    b1, b2 = bounds_from_stats(st.read("clean_stats")).first(), bounds(clean).first()
    assert (b1 is None) == (b2 is None)
    if b1 is not None:
        for c in ("mean_power", "std_power", "lower_bound", "upper_bound"):
            assert _close(b1[c], b2[c]), c

    if st.exists("anomaly_counts"):
        assert sorted(map(tuple, anomaly_counts_long(anoms).collect())) == \
            sorted(map(tuple, st.read("anomaly_counts").select("day", "turbine_id", "anomaly_count").collect()))

    prof = st.read("profile")
    last = prof.agg(F.max("run_seq")).first()[0]
    got = {r.period: r for r in prof.where(F.col("run_seq") == last).collect()}
    anchor = raw.agg(F.max("timestamp")).first()[0]
    want = {r.period: r for r in period_profile(raw, anoms, anchor=ts_literal(anchor)).collect()}
    assert set(got) == set(want)
    for p, w in want.items():
        for c, v in w.asDict().items():
            if c != "period":
                assert _close(got[p][c], v), (p, c, got[p][c], v)
