"""Command line: ``python -m anemoi run --feed DIR --root DIR [options]``.

``run`` does one daily run (ingest, flag, profile, clean, summarise) in the current
Spark environment (``spark-submit`` or local) and prints its report as JSON.
``repair --root DIR`` forgets all per-day state; the next run rebuilds it.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from anemoi.plans.daily_run import repair, run_daily
from anemoi.schema import Options
from anemoi.session import build_session, table_root


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="anemoi")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="one daily run")
    r.add_argument("--feed", required=True, help="folder receiving data_group_*.csv")
    r.add_argument("--root", help="table folder (default: conf anemoi.tables.root)")
    r.add_argument("--archive", help="archive folder (default: <feed parent>/archive)")
    r.add_argument("--run-ts", help="run time, ISO (default: now, UTC)")
    r.add_argument("--k-sigma", type=float, default=2.0)
    r.add_argument("--scope", choices=["parity", "new_rows"], default="parity")
    r.add_argument("--period", default="full_dataset", help="profile period used to impute")
    r.add_argument("--per-device-bounds", action="store_true")
    r.add_argument("--day-first", action="store_true")
    r.add_argument("--retract", action="store_true")
    r.add_argument("--no-archive", action="store_true")
    r.add_argument("--no-wide-pivot", action="store_true")
    r.add_argument("--master", help="Spark master when not under spark-submit")
    p = sub.add_parser("repair", help="forget all per-day state; the next run rebuilds it")
    p.add_argument("--root", help="table folder (default: conf anemoi.tables.root)")
    p.add_argument("--master", help="Spark master when not under spark-submit")
    a = ap.parse_args(argv)

    spark = build_session(a.master)
    try:
        root = table_root(spark, a.root)
    except ValueError as e:
        ap.error(str(e))
    if a.cmd == "repair":
        print(json.dumps({"days": repair(spark, root)}))
        return 0
    opt = Options(k_sigma=a.k_sigma, outlier_scope=a.scope, impute_period=a.period,
                  bound_groups=("turbine_id",) if a.per_device_bounds else (),
                  day_first=a.day_first, retract=a.retract, archive=not a.no_archive,
                  wide_pivot=not a.no_wide_pivot)
    run_ts = datetime.fromisoformat(a.run_ts) if a.run_ts else datetime.now(timezone.utc).replace(tzinfo=None)
    rep = run_daily(spark, a.feed, root, run_ts, opt, a.archive)
    out = {k: (str(v) if isinstance(v, datetime) else v) for k, v in rep.__dict__.items()}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
