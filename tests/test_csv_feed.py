import os
import sys

from pyspark.sql import functions as F

from anemoi.sources.csv_feed import parse_readings, scan_feed, split_valid
from anemoi.sources.feed_state import feed_state, latest_offsets, tail_rows
from anemoi.functions.expressions import ts_literal

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def test_row_numbers_across_many_splits(spark, tmpdir_run):
    for g, n in ((1, 3000), (2, 1700)):
        with open(os.path.join(tmpdir_run, f"data_group_{g}.csv"), "w") as f:
            f.write(HEADER)
            for i in range(1, n + 1):
                f.write(f"2022-03-01 00:00:00,{i},{g},{i % 7},{i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = scan_feed(spark, tmpdir_run)
        assert df.rdd.getNumPartitions() > 10
        rows = df.select("file_name", "row_no", "turbine_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 4700
    assert all(int(r.turbine_id) == r.row_no for r in rows)


def test_rejects_and_normalisation(spark, tmpdir_run):
    with open(os.path.join(tmpdir_run, "data_group_1.csv"), "w") as f:
        f.write(HEADER)
        f.write("2022-03-01 00:00:00,1,0,NaN,\n")       # zero, NaN, blank -> NULL
        f.write("bad date,1,1,1,1\n")
        f.write("2022-03-01 01:00:00,,1,1,1\n")         # missing id
        f.write("2022-03-01 02:00:00,1,1,1\n")         # four fields: power is missing
        f.write("03/01/2022 03:00:00,2,1.5,2,3\n")      # slash layout, month first
        f.write("2022-03-01 04:00:00,1,1,1,1,9\n")     # six fields
        f.write("2022-03-01 05:00:00,3.0,1,1,1\n")     # id as written by a float column
        f.write("2022-03-01 06:00:00,3.5,1,1,1\n")     # no id
        f.write("2022-03-01 07:00:00,4\n")             # key only
        f.write("2022-03-01 08:00:00\n")               # no id
    with open(os.path.join(tmpdir_run, "data_group_2.csv"), "w") as f:
        f.write(HEADER)                                 # header only: zero rows, no error
    parsed = parse_readings(scan_feed(spark, tmpdir_run))
    ok, bad = split_valid(parsed)
    okr = sorted(ok.collect(), key=lambda r: r.row_no)
    # a short row with a valid key counts, as a frame pads it; extra fields don't
    assert [r.row_no for r in okr] == [1, 4, 5, 7, 9]
    assert okr[1].power_output is None and okr[1].wind_direction == 1.0
    assert okr[3].turbine_id == 3 and okr[4].turbine_id == 4 and okr[4].wind_speed is None
    assert okr[0].wind_speed is None and okr[0].wind_direction is None and okr[0].power_output is None
    assert str(okr[2].timestamp) == "2022-03-01 03:00:00"
    reasons = sorted((r.row_no, r.reject_reason) for r in bad.collect())
    assert reasons == [(2, "timestamp"), (3, "turbine_id"), (6, "field_count"), (8, "turbine_id"), (10, "turbine_id")]
    texts = {r.row_no: r.reject_text for r in bad.collect()}
    assert '"timestamp":"bad date"' in texts[2]
    assert all(r.reject_text is None for r in parsed.where("reject_reason IS NULL").collect())


def test_tail_and_tracker(spark, tmpdir_run):
    with open(os.path.join(tmpdir_run, "data_group_1.csv"), "w") as f:
        f.write(HEADER)
        for i in range(1, 11):
            f.write(f"2022-03-01 {i:02d}:00:00,1,1,1,{i}\n")
    tracker = spark.createDataFrame(
        [("2022-03-01 00:00:00", "data_group_1.csv", "2022-03-01 03:00:00", 3),
         ("2022-03-02 00:00:00", "data_group_1.csv", "2022-03-01 06:00:00", 6)],
        "d string, file_name string, t string, last_record_csv_row_number long") \
        .select(F.col("d").cast("timestamp_ntz").alias("data_insertion_date"), "file_name",
                F.col("t").cast("timestamp_ntz").alias("last_record_timestamp"), "last_record_csv_row_number")
    off = latest_offsets(tracker)
    tail = tail_rows(scan_feed(spark, tmpdir_run), off)
    assert sorted(r.row_no for r in tail.collect()) == [7, 8, 9, 10]
    st = feed_state(parse_readings(tail), ts_literal("2022-03-03 00:00:00"), prior=off).first()
    assert st.last_record_csv_row_number == 10 and str(st.last_record_timestamp) == "2022-03-01 10:00:00"


def test_tail_by_rank_keeps_ties_and_nulls(spark):
    from anemoi.sources.feed_state import number_rows
    orders = {"a": [i * 7 % 101 for i in range(60)], "b": list(range(1000, 1060)), "c": list(range(60)),
              "t": [1, 2, 2, 3], "n": [None, 1, 2, 3], "z": [5] * 40, "o": [None, None]}
    rows = spark.createDataFrame([(g, o, i) for g, os_ in orders.items() for i, o in enumerate(os_)], "g string, o long, v long")
    cuts = {"a": 10, "b": 0, "c": 75, "t": 2, "n": 2, "z": 7, "o": 1}
    offs = spark.createDataFrame(list(cuts.items()), "file_name string, last_record_csv_row_number long")
    for coalesced in ("false", "true"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
        numbered = number_rows(rows, "g", "o")
        got = {}
        for r in tail_rows(numbered, offs, file_col="g").collect():
            got.setdefault(r.g, []).append(r.o)
        key = lambda x: (x is not None, x or 0)
        want = {g: sorted(v, key=key)[cuts[g]:] for g, v in orders.items()}
        assert {g: sorted(v, key=key) for g, v in got.items()} == {g: v for g, v in want.items() if v}
        nos = {}
        for r in numbered.collect():
            nos.setdefault(r.g, []).append(r.row_no)
        assert all(sorted(v) == list(range(1, len(v) + 1)) for v in nos.values())


def test_row_numbers_of_null_groups_wide_ranges_and_ties(spark, monkeypatch):
    """A NULL group is a group; a range as wide as the type does not overflow; an outlier, or nothing
    but ties, leaves no group in one task."""
    fs = sys.modules["anemoi.sources.feed_state"]      # the package exports a function of that name
    sorted_rows = []
    monkeypatch.setattr(fs, "written", lambda df, name, real=fs.written: sorted_rows.append(real(df, name)) or sorted_rows[0])
    lo, hi = -2 ** 63, 2 ** 63 - 1
    rows = [(None, 3, 0), (None, 1, 1), (None, None, 2), ("w", hi, 3), ("w", lo, 4), ("w", 0, 5)]
    rows += [("t", 5, i) for i in range(4000)] + [("x", i if i < 3999 else hi, i) for i in range(4000)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = fs.number_rows(spark.createDataFrame(rows, "g string, o long, v long").repartition(5), "g", "o").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(got) == len(rows) and {(r.g, r.o, r.v) for r in got} == set(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    for g, rs in groups.items():
        rs.sort(key=lambda r: r.row_no)
        assert [r.row_no for r in rs] == list(range(1, len(rs) + 1))
        order = [(r.o is not None, r.o or 0) for r in rs]
        assert order == sorted(order)
    tasks = {(r.g, r._part): r["count"] for r in sorted_rows[0].groupBy("g", "_part").count().collect()}
    assert all(n < 3200 for n in tasks.values()), tasks


def test_row_numbers_are_the_same_when_recomputed(spark, tmpdir_run):
    """A lost executor makes Spark recompute scan partitions: the split-local
    ids, hence the row numbers, must come out identical each time."""
    for g in (1, 2):
        with open(os.path.join(tmpdir_run, f"data_group_{g}.csv"), "w") as f:
            f.write(HEADER)
            for i in range(1, 2001):
                f.write(f"2022-03-01 {i % 24:02d}:00:00,{g * 10000 + i},1,1,{i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        runs = [sorted((r.file_name, r.row_no, r.turbine_id) for r in scan_feed(spark, tmpdir_run).collect())
                for _ in range(3)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert runs[0] == runs[1] == runs[2]
    assert all(int(t) % 10000 == n for _, n, t in runs[0])
