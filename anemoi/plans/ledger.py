"""The per-day ledger: what changed on a day, and which derived table caught up.

One unpartitioned append-only log; a day's state is its row with the largest version.
A run reads the log once, keeps the state in the driver (one row per day that holds
readings: bounded by the calendar) and appends changed rows, one small file per ``flush``.

Markers hold run numbers, not clock times. A run's number is one more than any number the
store has seen, so a run with an equal or earlier run time still counts as later.
"Changed" markers are flushed before a derived table is written, "done" markers after it;
a run that dies in between leaves the next run exactly the days to redo.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoi.schema import DAY, POWER, TS

FACTS = ("rows", "max_ts", "min_power", "max_power")
MARKERS = ("changed", "counted", "anom_changed", "anom_counted", "clean_changed", "cleaned", "summarised")

LEDGER = T.StructType(
    [T.StructField(DAY, T.DateType(), False),
     T.StructField("rows", T.LongType(), True),
     T.StructField("max_ts", T.TimestampNTZType(), True),
     T.StructField("min_power", T.DoubleType(), True),
     T.StructField("max_power", T.DoubleType(), True)]
    + [T.StructField(m, T.LongType(), True) for m in MARKERS]
    + [T.StructField("version", T.LongType(), False)])


def day_facts(raw: DataFrame) -> DataFrame:
    """Row count, latest reading and power range of each day of ``raw``."""
    return raw.groupBy(DAY).agg(F.count(F.lit(1)).alias("rows"), F.max(TS).alias("max_ts"),
                                F.min(POWER).alias("min_power"), F.max(POWER).alias("max_power"))


class Ledger:
    def __init__(self, store):
        self.store, self.days, self.version, self._dirty = store, {}, 0, set()
        if store.exists("ledger"):
            fields = F.struct(*FACTS, *MARKERS, "version")
            for r in store.read("ledger").groupBy(DAY).agg(F.max_by(fields, "version").alias("r")).collect():
                self.days[r[DAY]] = r["r"].asDict()
                self.version = max(self.version, r["r"]["version"])
        seen = [s[m] for s in self.days.values() for m in MARKERS if s[m]]
        tables = [store.read(t).select("run_seq") for t in ("tracker", "runs") if store.exists(t)]
        if tables:
            both = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
            seen.append(both.agg(F.max("run_seq")).first()[0] or 0)
        self.seq = 1 + max(seen, default=0)
        # days that a former run changed without living to count them
        self.unfinished = self.stale("counted", "changed", "anom_changed")

    def put(self, facts: DataFrame) -> None:
        """Facts of days whose readings this run changed."""
        for r in facts.collect():
            s = self.days.setdefault(r[DAY], dict.fromkeys(MARKERS))
            s.update({f: r[f] for f in FACTS}, changed=self.seq)
            self._dirty.add(r[DAY])

    def stamp(self, days, *markers: str) -> None:
        for d in days:
            if d in self.days:
                self.days[d].update(dict.fromkeys(markers, self.seq))
                self._dirty.add(d)

    def flush(self) -> None:
        if not self._dirty:
            return
        self.version += 1
        rows = [(d, *[self.days[d][c] for c in FACTS + MARKERS], self.version) for d in sorted(self._dirty)]
        self.store.append("ledger", self.store.spark.createDataFrame(rows, LEDGER).coalesce(1))
        self._dirty.clear()

    def stale(self, done: str, *dirty: str) -> list:
        """Days where a ``dirty`` marker is later than ``done``."""
        return sorted(d for d, s in self.days.items() if any((s[m] or 0) > (s[done] or 0) for m in dirty))

    def since(self, seq: int) -> list:
        """Days whose readings changed after run ``seq``."""
        return sorted(d for d, s in self.days.items() if (s["changed"] or 0) > seq)

    def anchor(self):
        """Latest reading of all days."""
        return max((s["max_ts"] for s in self.days.values() if s["max_ts"] is not None), default=None)

    def outlier_days(self, lo: float, hi: float, cutoff=None, scope: str = "parity") -> list:
        """Days that can hold a reading outside (lo, hi) under the flagging rule,
        from per-day min/max power: the raw scan then reads only those days."""
        def can(s) -> bool:
            low = s["min_power"] is not None and s["min_power"] < lo
            high = s["max_power"] is not None and s["max_power"] > hi
            if cutoff is None:
                return low or high
            after = s["max_ts"] is not None and s["max_ts"] > cutoff
            return low or (high and after) if scope == "parity" else (low or high) and after

        return sorted(d for d, s in self.days.items() if can(s))
