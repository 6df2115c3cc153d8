import os
from datetime import datetime

from anemoi.plans.store import TableStore
from anemoi.schema import Options
from anemoi.streaming.delivery import start_delivery

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def _file(path, day, turbines, dup=None):
    with open(path, "w") as f:
        f.write(HEADER)
        for h in range(24):
            for t in turbines:
                p = 9.0 if (h, t) == (5, turbines[0]) else 3.0 + (h % 3) * 0.1
                f.write(f"2022-03-{day:02d} {h:02d}:00:00,{t},5,{h + 1},{p}\n")
        if dup:
            f.write(dup)


def test_new_file_delivery(spark, tmpdir_run):
    feed = os.path.join(tmpdir_run, "feed")
    os.makedirs(feed)
    root, ck = os.path.join(tmpdir_run, "tables"), os.path.join(tmpdir_run, "ck")
    _file(os.path.join(feed, "data_group_1.csv"), 1, [1, 2],
          dup="2022-03-01 03:00:00,1,5,4,3.15\n")            # same key later in the file wins
    _file(os.path.join(feed, "data_group_2.csv"), 1, [3])
    clock = iter([datetime(2022, 3, 2), datetime(2022, 3, 3), datetime(2022, 3, 4)])
    reports = []
    opt = Options(archive=False)
    q = start_delivery(spark, feed, root, ck, opt, clock=lambda: next(clock), reports=reports)
    q.awaitTermination(120)
    st = TableStore(spark, root)
    raw = st.read("raw")
    assert raw.count() == 72
    assert raw.where("turbine_id = 1 AND hour(timestamp) = 3").first().power_output == 3.15
    assert st.read("anomalies").count() >= 1
    n_clean = st.read("clean").count()
    assert n_clean == 72 - st.read("anomalies").count()

    # a new file arrives; the old ones are not read again
    _file(os.path.join(feed, "data_group_3.csv"), 2, [1, 2, 3])
    q = start_delivery(spark, feed, root, ck, opt, clock=lambda: next(clock), reports=reports)
    q.awaitTermination(120)
    assert st.read("raw").count() == 144
    assert sum(r.new_rows for _, r in reports) == 145
    assert st.read("daily_summary").count() == 6
    runs = st.read("runs").orderBy("run_seq").collect()
    assert len(runs) == len(reports) and [r.new_rows for r in runs] == [r.new_rows for _, r in reports]
    assert [r.lower_bound for r in runs] == [r.band["lower_bound"] for _, r in reports]
