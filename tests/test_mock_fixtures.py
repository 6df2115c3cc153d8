"""The two two-row fixture shapes of the reference's tests: ISO and slash dates."""

import os
from datetime import datetime

import pytest

from anemoi.plans.daily_run import run_daily
from anemoi.plans.store import TableStore
from anemoi.schema import Options

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
# fixed test data: the fixture rows, as given
ROWS = [("1", "10.5", "100", "1500"), ("2", "15.2", "200", "2000")]


@pytest.mark.parametrize("stamp,day_first,day", [
    ("2022-03-01 00:00:00", False, "2022-03-01"),
    ("01/03/2022 00:00:00", False, "2022-01-03"),     # month first by default (D5)
    ("01/03/2022 00:00:00", True, "2022-03-01"),      # the fixture's intended reading
])
def test_fixture_shapes(spark, tmpdir_run, stamp, day_first, day):
    feed = os.path.join(tmpdir_run, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "data_group_1.csv"), "w") as f:
        f.write(HEADER + "".join(f"{stamp},{t},{w},{d},{p}\n" for t, w, d, p in ROWS))
    r = run_daily(spark, feed, os.path.join(tmpdir_run, "tables"), datetime(2022, 4, 1),
                  Options(day_first=day_first), archive_dir=os.path.join(tmpdir_run, "archive"))
    st = TableStore(spark, os.path.join(tmpdir_run, "tables"))
    raw = sorted((str(x.day), x.turbine_id, x.wind_speed, x.wind_direction, x.power_output)
                 for x in st.read("raw").collect())
    assert raw == [(day, 1, 10.5, 100.0, 1500.0), (day, 2, 15.2, 200.0, 2000.0)]
    # two readings: band 1750 +- 500, nothing outside; both reach clean and the summary
    assert r.band["lower_bound"] == 1250.0 and r.band["upper_bound"] == 2250.0
    assert st.read("clean").count() == 2
    summ = st.read("daily_summary").collect()
    assert sorted((s.turbine_id, s.avg_power_output) for s in summ) == [(1, 1500.0), (2, 2000.0)]
