"""Low outliers are tested over all history in every run (D1), without touching history.

A run whose lower bound does not exceed a bound that an earlier run applied after a day last
changed finds no new low outlier on that day: anomalies are never taken back. So only days that
changed, and days with readings between the highest bound applied to them and a higher one, are
scanned and written. What such a run still does to old low outliers is to refresh their insertion
date. That date is derived on read: an anomaly keeps the number of the run that wrote it, and its
date is the time of the latest run after it whose lower bound lies above the reading. ``runs`` holds
one row per run; only those whose bound exceeds the bounds of all later runs can matter.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.functions.expressions import ts_literal
from anemoi.schema import INSERTED, POWER

FLAG = "flag_seq"


class LowTail:
    """Lower bounds that completed runs applied to all history, from ``runs`` (one row per run)."""

    def __init__(self, store):
        rows = [] if not store.exists("runs") else (
            store.read("runs").where((F.col("cleaning") == "done") & F.col("low_tested") & F.col("lower_bound").isNotNull())
            .select("run_seq", "run_ts", "lower_bound", "low_refreshed").collect())
        self.runs = sorted(rows, key=lambda r: r["run_seq"])
        self.seqs = [r["run_seq"] for r in self.runs]
        self.highest = [r["lower_bound"] for r in self.runs]
        for i in reversed(range(len(self.highest) - 1)):
            self.highest[i] = max(self.highest[i], self.highest[i + 1])

    def tested(self, changed: int | None) -> float:
        """The highest lower bound applied to a day that last changed in run ``changed``."""
        i = bisect_left(self.seqs, changed or 0)
        return self.highest[i] if i < len(self.highest) else float("-inf")

    def steps(self) -> list:
        """Runs that refreshed dates and whose bound exceeds all later ones', newest first."""
        out, top = [], float("-inf")
        for r in reversed(self.runs):
            if r["low_refreshed"] and r["lower_bound"] > top:
                out.append(r)
                top = r["lower_bound"]
        return out

    def refreshed(self, anomalies: DataFrame) -> DataFrame:
        """Stored anomalies with their insertion dates as of the last run, without the run number."""
        steps = self.steps()
        if not steps:
            return anomalies.drop(FLAG)
        array = F.array(*[F.struct(F.lit(r["run_seq"]).cast("long").alias("seq"), ts_literal(r["run_ts"]).alias("ts"),
                                   F.lit(r["lower_bound"]).alias("lower")) for r in steps])
        later = F.filter(array, lambda s: (s["lower"] > F.col(POWER)) & (s["seq"] > F.coalesce(F.col(FLAG), F.lit(0))))
        return anomalies.withColumn(INSERTED, F.coalesce(F.get(later, F.lit(0))["ts"], F.col(INSERTED))).drop(FLAG)
