import json
import os

import pytest

from anemoi.__main__ import main

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def test_cli_run(spark, tmpdir_run, capsys):
    feed = os.path.join(tmpdir_run, "feed")
    os.makedirs(feed)
    with open(os.path.join(feed, "data_group_1.csv"), "w") as f:
        f.write(HEADER)
        for h in range(24):
            f.write(f"2022-03-01 {h:02d}:00:00,1,5,{h + 1},{9.0 if h == 3 else 3.0 + (h % 2) * 0.1}\n")
    rc = main(["run", "--feed", feed, "--root", os.path.join(tmpdir_run, "tables"),
               "--run-ts", "2022-03-02T00:00:00"])
    assert rc == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["new_rows"] == 24 and out["cleaning"] == "done"
    assert os.listdir(os.path.join(tmpdir_run, "archive"))


def test_cli_needs_a_table_folder(spark, tmpdir_run, capsys):
    with pytest.raises(SystemExit) as e:
        main(["run", "--feed", tmpdir_run])
    assert e.value.code == 2 and "anemoi.tables.root" in capsys.readouterr().err


def test_cli_repair(spark, tmpdir_run, capsys):
    assert main(["repair", "--root", os.path.join(tmpdir_run, "tables")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"days": 0}
