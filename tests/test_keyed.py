from pyspark.sql import functions as F

from anemoi.operators.keyed import insert_ignore, latest_per_key, upsert

SCHEMA = "k long, v double, w string, ins string, f string, r long"


def test_upsert_later_row_wins_nulls_included(spark):
    ex = spark.createDataFrame([(1, 1.0, "a", "d0", None, None), (2, 2.0, "b", "d0", None, None)], SCHEMA) \
        .drop("f", "r")
    up = spark.createDataFrame([(1, None, None, "d1", "f1", 5), (1, 9.0, "z", "d1", "f1", 2),
                                (3, 3.0, "c", "d1", "f2", 1)], SCHEMA)
    out = {r.k: r for r in upsert(ex, up, ["k"], seq=["f", "r"], keep_first=["ins"]).collect()}
    assert out[1].v is None and out[1].w is None      # row 5 of f1 is the latest, NULLs overwrite
    assert out[1].ins == "d0"                         # first insertion date kept
    assert out[2].v == 2.0 and out[3].ins == "d1"
    assert set(out) == {1, 2, 3}


def test_upsert_refreshes_unlisted_columns(spark):
    ex = spark.createDataFrame([(1, 1.0, "d0")], "k long, v double, ins string")
    up = spark.createDataFrame([(1, 1.0, "d1")], "k long, v double, ins string")
    assert upsert(ex, up, ["k"]).first().ins == "d1"


def test_insert_ignore_first_wins(spark):
    ex = spark.createDataFrame([(1, 1.0)], "k long, v double")
    new = spark.createDataFrame([(1, 5.0), (2, 7.0), (2, 6.0), (3, None)], "k long, v double")
    got = sorted((r.k, r.v) for r in insert_ignore(ex, new, ["k"], seq=["v"]).collect())
    assert got == [(2, 6.0), (3, None)]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 3, 31), ("b", 2, 20)], "g string, t int, x int")
    got = sorted((r.g, r.t, r.x) for r in latest_per_key(df, ["g"], ["t", "x"]).collect())
    assert got == [("a", 3, 31), ("b", 2, 20)]
    plan = latest_per_key(df, ["g"], ["t"])._jdf.queryExecution().executedPlan().toString()
    # one shuffle on the key; the best row of a key is found before it, and nothing is aggregated by sorting
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2 and "SortAggregate" not in plan


def test_upsert_is_one_aggregate_per_key(spark):
    ex = spark.createDataFrame([(1, 1.0)], "k long, v double")
    up = spark.createDataFrame([(1, 2.0)], "k long, v double").withColumn("s", F.lit(1))
    plan = upsert(ex, up, ["k"], seq=["s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window [" not in plan


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-3, 3).map(float)))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(_row, max_size=8), min_size=1, max_size=4))
def test_keyed_merges_match_a_dict_model(spark, batches):
    """Apply batches one after another; upsert = last write wins (inside a batch
    the later row), insert-ignore = first write wins."""
    schema = "k long, v double, seq long, ins string"
    up_model, ig_model = {}, {}
    up = spark.createDataFrame([], "k long, v double, ins string")
    ig = spark.createDataFrame([], "k long, v double, ins string")
    for b, rows in enumerate(batches):
        df = spark.createDataFrame([(k, v, i, f"b{b}") for i, (k, v) in enumerate(rows)], schema)
        up = spark.createDataFrame(upsert(up, df, ["k"], seq=["seq"], keep_first=["ins"]).collect(),
                                   "k long, v double, ins string")
        add = insert_ignore(ig, df, ["k"], seq=["seq"]).drop("seq")
        ig = spark.createDataFrame(ig.unionByName(add).collect(), "k long, v double, ins string")
        for k, v in rows:
            up_model[k] = (v, up_model.get(k, (None, f"b{b}"))[1])
            ig_model.setdefault(k, (v, f"b{b}"))
    assert {r.k: (r.v, r.ins) for r in up.collect()} == up_model
    assert {r.k: (r.v, r.ins) for r in ig.collect()} == ig_model


def test_reading_upsert_hashes(spark):
    """Fixed-width values and one numeric order: hash aggregates, winners' NULLs survive."""
    from anemoi.schema import KEY, READINGS
    empty = spark.createDataFrame([], READINGS)
    t = "cast('2022-03-01 00:00:00' AS timestamp_ntz)"
    new = spark.sql(f"SELECT {t} AS timestamp, 1L AS turbine_id, x AS wind_speed, x AS wind_direction, y AS power_output, "
                    f"{t} AS insertion_date, DATE'2022-03-01' AS day, s AS seq "
                    "FROM VALUES (1D, 1D, 1L), (2D, CAST(NULL AS DOUBLE), 3L), (3D, 3D, 2L) AS v(x, y, s)")
    out = upsert(empty, new, list(KEY), seq=["seq"], keep_first=["insertion_date"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert [(r.wind_speed, r.power_output) for r in out.collect()] == [(2.0, None)]


def test_grouped_bounds_are_not_forced_into_a_broadcast(spark):
    from anemoi.plans.day_stats import CLEAN_STATS, bounds_from_stats
    plan = bounds_from_stats(spark.createDataFrame([], CLEAN_STATS), groups=("day", "turbine_id"))
    assert "strategy=broadcast" not in plan._jdf.queryExecution().optimizedPlan().toString()
