"""One daily run -- ingest, flag, profile, clean, summarise.

State contract per run (tables resolved at the start of the step that needs
them; writes in this order):

1. raw' = upsert(raw, tails of all feed files); one tracker row per file with
   new rows; the files are archived after both commits.
2. baseline = clean (as of the previous run) when non-empty, else raw'.
3. cutoff = max(clean.timestamp) of the previous run; used only when
   anomalies is non-empty, else every raw' row is tested.
4. anomalies' = upsert(anomalies, flagged raw'), insertion date refreshed.
5. profile' = profile + one row per non-empty look-back period.
6. clean' = insert-ignore(clean, impute(raw' minus anomalies')).
7. daily summary upserted for the days whose clean rows changed.
8. anomaly counts recounted for days that gained anomaly keys; the wide pivot
   rebuilt when they changed.

If the band is undefined (sigma NULL or 0), steps 4-6 are skipped and 7-8 still run.

Every step after the first reads and writes only the days that need it, from
the per-day ledger (:mod:`anemoi.plans.ledger`): "changed" markers are flushed
before a derived table is written, "done" markers after it, so a run that dies
between two writes leaves the next run exactly the days to redo. Runs are
ordered by a number of their own, taken from the store; ``run_ts`` is only
stored, so it may repeat or go back.
"""

from __future__ import annotations

import json
import time
import zlib
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anemoi.functions.expressions import day_of, ts_literal
from anemoi.operators import (
    anomaly_counts_long, anomaly_pivot, bounds, clean_rows, daily_summary, eligible_rows,
    flag_outliers, insert_ignore, upsert,
)
from anemoi.operators.order_stats import sorted_values
from anemoi.operators.profile import period_profile, profile_from_sorted
from anemoi.plans.day_stats import (
    bounds_from_stats, clean_stats, counts_by_period, elig_counts, long_values, signed,
)
from anemoi.plans.ledger import Ledger, day_facts
from anemoi.plans.reflag import FLAG, LowTail
from anemoi.plans.store import TableStore
from anemoi.schema import DAY, DEVICE, INSERTED, KEY, MEASURES, RUNS, TS, Options
from anemoi.scratch import written
from anemoi.sources.archive import archive_files
from anemoi.sources.csv_feed import parse_readings, scan_feed, split_valid
from anemoi.sources.feed_state import feed_state, latest_offsets, tail_rows


@dataclass
class RunReport:
    run_ts: datetime
    files: list = field(default_factory=list)
    new_rows: int = 0
    rejected: int = 0
    baseline_source: str | None = None
    band: dict | None = None
    cleaning: str = "skipped"
    anomaly_days: list = field(default_factory=list)
    flag_days: int | None = None
    archived: list = field(default_factory=list)
    timings: dict = field(default_factory=dict)


@contextmanager
def timed(report: RunReport, step: str):
    t0 = time.perf_counter()
    try:
        yield
    finally:
        report.timings[step] = round(time.perf_counter() - t0, 3)


def sibling(path: str, name: str) -> str:
    """``<parent of path>/<name>`` for local paths and URIs alike."""
    return f"{path.rstrip('/').rsplit('/', 1)[0]}/{name}"


def list_feed(spark: SparkSession, feed_dir: str, glob: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{feed_dir.rstrip('/')}/{glob}")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.globStatus(pattern)
    return sorted(s.getPath().toString() for s in (st or []) if s.isFile())


def _days(df: DataFrame) -> list:
    """Distinct days of a frame: bounded by the calendar, safe to collect."""
    return sorted(r[0] for r in df.select(DAY).distinct().collect())


def merge_batch(store: TableStore, led: Ledger, rows: DataFrame, run_ts: datetime, opt: Options,
                report: RunReport, offsets: DataFrame | None = None) -> list:
    """Parse a batch of feed rows (text columns, ``file_name``, ``row_no``),
    upsert the valid ones into raw and append the tracker rows. Returns the
    days of raw that changed. Re-running the same batch is harmless: keyed."""
    run = ts_literal(run_ts)
    parsed = parse_readings(rows, opt.day_first, opt.zero_is_missing)
    valid, _rejects = split_valid(parsed)
    with timed(report, "ingest.batch_days"):
        # one small job: rows, rejects and valid days of the batch (days are bounded)
        per_day = (parsed.groupBy(F.to_date(TS).alias(DAY))
                   .agg(F.count(F.lit(1)).alias("n"), F.count("reject_reason").alias("bad"))
                   .collect())
    report.new_rows += sum(r["n"] for r in per_day)
    report.rejected += sum(r["bad"] for r in per_day)
    days = sorted(r[DAY] for r in per_day if r[DAY] is not None and r["n"] > r["bad"])
    if days:
        # storage_float: keep only single-precision values (FLOAT columns), still
        # computed in DOUBLE, so averages match single-precision storage
        meas = [F.col(m).cast("float").cast("double").alias(m) if opt.storage_float else F.col(m)
                for m in MEASURES]
        batch = feed_order(valid).select(*KEY, *meas, "feed_seq", run.alias(INSERTED)).withColumn(DAY, day_of(TS))
        merged = upsert(store.read_days("raw", days), batch, list(KEY),
                        seq=["feed_seq"], keep_first=[INSERTED])
        with timed(report, "ingest.raw_upsert"):
            store.overwrite_days("raw", merged)
        with timed(report, "ingest.ledger"):
            led.put(day_facts(store.read_days("raw", days)))
            led.flush()
    if report.rejected:
        with timed(report, "ingest.rejects"):
            store.append("rejects", parsed.where(F.col("reject_reason").isNotNull())
                         .select(run.alias("run_ts"), "file_name", "row_no", "reject_reason",
                                 "reject_text"))
    if per_day:
        with timed(report, "ingest.tracker"):
            store.append("tracker", feed_state(parsed, run, prior=offsets).withColumn("run_seq", F.lit(led.seq)))
    return days


def feed_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``feed_seq``: one number for (file in name order, row in file).

    A fixed-width number keeps the upsert's winner in hash-aggregate buffers. The ranks
    are one row per file of the batch.
    """
    rank = Window.orderBy("file_name")
    files = rows.select("file_name").distinct().withColumn("_file", F.row_number().over(rank).cast("long"))
    return (rows.join(files, "file_name")
            .withColumn("feed_seq", F.col("_file") * F.lit(1 << 40) + F.col("row_no")).drop("_file"))


def ingest(spark: SparkSession, store: TableStore, led: Ledger, feed_dir: str, run_ts: datetime,
           opt: Options, report: RunReport, archive_dir: str | None = None) -> list:
    """Step 1 for feeds that re-deliver growing files under the same name:
    only rows past each file's stored offset are read into raw."""
    files = list_feed(spark, feed_dir, opt.feed_glob)
    report.files = files
    if not files:
        return []
    offsets = latest_offsets(store.read("tracker"))
    text = scan_feed(spark, files, glob=opt.feed_glob)
    new = tail_rows(text, offsets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = merge_batch(store, led, new, run_ts, opt, report, offsets)
    finally:
        new.unpersist()
    if opt.archive:
        report.archived = archive_files(spark, files, archive_dir or sibling(feed_dir, "archive"), run_ts)
    return days


def _ensure_day_stats(store: TableStore, led: Ledger) -> None:
    """Build the per-day state from the full tables where it is absent, and the clean
    stats of days whose clean rows a run changed without living to count them."""
    if not led.days and store.exists("raw"):
        led.put(day_facts(store.read("raw")))
        led.flush()
    if not store.exists("clean"):
        return
    if not store.exists("clean_stats"):
        store.overwrite_days("clean_stats", clean_stats(store.read("clean")))
    elif torn := led.stale("cleaned", "clean_changed"):
        _refresh_clean_stats(store, torn)


def _refresh_clean_stats(store: TableStore, days: list) -> None:
    """Recount the clean stats of ``days``; days without clean rows lose theirs."""
    store.overwrite_days("clean_stats", clean_stats(store.read_days("clean", days)))
    store.drop_days("clean_stats", [d for d in days if not store.has_day("clean", d)])


def repair(spark: SparkSession, root: str) -> int:
    """Forget all per-day state: the next run recounts every day from the readings.
    Returns the number of days."""
    store = TableStore(spark, root)
    for name in ("clean_stats", "elig_counts", "all_counts", "ledger"):
        store.drop(name)
    led = Ledger(store)
    _ensure_day_stats(store, led)
    return len(led.days)


def _band(raw: DataFrame, cs: DataFrame, clean_empty: bool, opt: Options,
          report: RunReport):
    """Step 2: the band from the previous clean table (its per-day moments), or
    from raw on a first load. A global band is collected as two literals; per-group
    bands stay a (persisted) frame. None when undefined (sigma NULL or 0)."""
    report.baseline_source = "raw" if clean_empty else "clean"
    if clean_empty:
        rows = bounds(raw, opt.k_sigma, groups=opt.bound_groups)
    else:
        rows = bounds_from_stats(cs, opt.k_sigma, groups=opt.bound_groups)
    if not opt.bound_groups:
        b = rows.first()
        if b is None:
            return None
        report.band = b.asDict()
        return (b["lower_bound"], b["upper_bound"])
    band = rows.persist(StorageLevel.MEMORY_AND_DISK)
    if band.isEmpty():
        band.unpersist()
        return None
    return band


def _last_band(store: TableStore):
    """(run number, lower_bound) of the newest run that completed its clean step."""
    if not store.exists("runs"):
        return None
    r = (store.read("runs").where((F.col("cleaning") == "done") & F.col("lower_bound").isNotNull())
         .agg(F.max_by(F.struct("run_seq", "lower_bound"), F.col("run_seq")).alias("r")).first()["r"])
    return None if r is None else (r["run_seq"], r["lower_bound"])


def _flag(store: TableStore, raw: DataFrame, led: Ledger, band, cutoff_ts, anomalies_empty: bool,
          run: Column, opt: Options, report: RunReport) -> None:
    """Steps 3-4: flag raw against the band and upsert into anomalies."""
    cutoff = None if anomalies_empty else (
        ts_literal(cutoff_ts) if cutoff_ts is not None else F.lit(None).cast("timestamp_ntz"))
    scan = raw
    if not opt.bound_groups:
        # per-day min/max power: read only days that can hold an outlier
        if anomalies_empty or cutoff_ts is not None:
            cand = led.outlier_days(band[0], band[1], None if anomalies_empty else cutoff_ts,
                                    opt.outlier_scope)
        else:
            cand = led.outlier_days(band[0], float("inf"))    # NULL cutoff: no high tail (D12)
        if opt.outlier_scope == "parity":
            # every day was tested against the bounds of all runs since it changed: a day below them
            # all has no new low outlier, and the dates of the old ones are derived on read
            low = LowTail(store)
            high = set(led.outlier_days(float("-inf"), band[1], None if anomalies_empty else cutoff_ts)
                       if anomalies_empty or cutoff_ts is not None else [])
            cand = [d for d in cand if d in high or band[0] > low.tested(led.days[d]["changed"])]
        elif not opt.refresh_reflagged and (last := _last_band(store)) is not None and band[0] <= last[1]:
            # only days changed since the last run can yield new keys
            cand = sorted(set(cand) & set(led.since(last[0])))
        report.flag_days = len(cand)
        if not cand:
            return
        scan = raw.where(F.col(DAY).isin(cand))
    flagged = flag_outliers(scan, band, cutoff, opt.outlier_scope, groups=opt.bound_groups) \
        .select(*KEY, *MEASURES, run.alias(INSERTED), DAY, F.lit(led.seq).cast("long").alias(FLAG)) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        a_days = _days(flagged)
        if not a_days:
            return
        prev = store.read_days("anomalies", a_days)
        # days that gain anomaly keys: the only days whose eligible set shrinks
        new_days = _days(flagged.join(prev.select(*KEY), list(KEY), "left_anti"))
        report.anomaly_days = new_days
        led.stamp(new_days, "anom_changed")
        led.flush()                                         # before the write
        write = flagged
        if not opt.refresh_reflagged:
            a_days = sorted(set(new_days) | (set(a_days) & set(led.since(led.seq - 1))))
            prev = prev.where(F.col(DAY).isin(a_days))
            write = flagged.where(F.col(DAY).isin(a_days))
        if a_days:
            store.overwrite_days("anomalies", upsert(prev, write, list(KEY)))
    finally:
        flagged.unpersist()


def _profile(store: TableStore, led: Ledger, raw: DataFrame, anomalies: DataFrame, anchor: datetime,
             run: Column, opt: Options, report: RunReport) -> list:
    """Step 5: refresh stale per-day value counts, then append one profile row
    per non-empty look-back period. Returns the refreshed days (their "counted"
    marker is written with the clean step's marker)."""
    starts = [(name, None if lb is None else anchor - lb) for name, lb in opt.periods]
    tag = f"{zlib.crc32(repr(opt.periods).encode()):08x}"
    last = (store.generations("all_counts") or [None])[-1]
    # a run that died while counting leaves all-time counts of unknown state
    whole = last is None or bool(led.unfinished)
    changed = None
    with timed(report, "clean.value_counts"):
        refresh = led.stale("counted", "changed", "anom_changed")
        if refresh:
            new = elig_counts(raw.where(F.col(DAY).isin(refresh)), anomalies.where(F.col(DAY).isin(refresh)),
                              refresh, run).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if not whole:          # against the old counts, before they are replaced
                    store.drop("_signed")
                    changed = written(signed(new, store.read_days("elig_counts", refresh)), "signed", store.path("_signed"))
                store.overwrite_days("elig_counts", new)
            finally:
                new.unpersist()
    with timed(report, "clean.profile"):
        if opt.profile_method != "incremental":
            prof = period_profile(raw, anomalies, opt.periods, method=opt.profile_method, anchor=ts_literal(anchor))
            store.drop("all_counts")           # not moved by this run
        elif not refresh and not whole and last.endswith(tag) and _profiled(store, last):
            # the same readings over the same look-backs: the last rows again
            prof = store.read("profile").where(F.col("run_seq") == _profiled(store, last)).drop(
                "calculation_timestamp", "run_seq").coalesce(1)
        else:
            prof = profile_from_sorted(_all_counts(store, led, raw, anomalies, starts, tag, last, whole, changed),
                                       [name for name, _ in starts])
        store.append("profile", prof.withColumn("calculation_timestamp", run).withColumn("run_seq", F.lit(led.seq)))
        if changed is not None:
            store.drop("_signed")
    return refresh


def _profiled(store: TableStore, generation: str) -> int | None:
    """The newest run in the profile, if it came no earlier than these all-time counts."""
    seq = store.read("profile").agg(F.max("run_seq")).first()[0]
    return seq if seq is not None and seq >= int(generation.split("-")[0]) else None


def _all_counts(store: TableStore, led: Ledger, raw: DataFrame, anomalies: DataFrame, starts: list, tag: str,
                last: str | None, whole: bool, changed: DataFrame | None) -> DataFrame:
    """The next version of the all-time counts, with the look-backs' counts beside them, in value order.

    The version before, moved by the signed counts of the refreshed days (``changed``); or, in a first
    run and after one that died while counting, the sum over all days. Look-backs read the days after
    the earliest start, and the readings of each start's own day.
    """
    days = store.read("elig_counts")
    if whole:
        full = days.where(F.col("n") > 0)
    else:
        full = store.spark.read.parquet(store.path(f"all_counts/{last}")).select("measure", "value", "n")
        if changed is not None:
            full = full.unionByName(changed)
    edge = sorted({s.date() for _, s in starts if s is not None})
    boundary = None
    if at := sorted(set(edge) & set(led.days)):
        boundary = long_values(eligible_rows(raw.where(F.col(DAY).isin(at)), anomalies.where(F.col(DAY).isin(at)))
                               .withColumn(DAY, F.to_date(TS)))
    if edge:
        days = days.where(F.col(DAY) > F.lit(edge[0]))
    now = f"{led.seq:012d}-{time.time_ns():020d}-{tag}"
    rows = sorted_values(counts_by_period(full, days, boundary, starts), ["measure"], "value", store.path(f"all_counts/{now}"))
    if last is not None:
        store.keep_generation("all_counts", now)
    return rows


def _insert_clean(store: TableStore, led: Ledger, raw: DataFrame, anomalies: DataFrame, run: Column,
                  opt: Options, report: RunReport, counted: list) -> list:
    """Step 6: impute and insert-ignore the rows of days whose raw changed since
    the clean step last processed them; refresh their clean stats."""
    with timed(report, "clean.insert"):
        dirty = ("changed", "anom_changed") if opt.retract else ("changed",)
        days = led.stale("cleaned", *dirty)
        if not days:
            led.stamp(counted, "counted")
            led.flush()
            return []
        led.stamp(days, "clean_changed")
        led.flush()                                          # before the write
        cand = clean_rows(raw.where(F.col(DAY).isin(days)), anomalies.where(F.col(DAY).isin(days)),
                          store.read("profile"), opt.impute_period, opt.impute_with)
        prev_d = store.read_days("clean", days)
        new = insert_ignore(prev_d, cand, list(KEY), assume_unique=True) \
            .select(*KEY, *MEASURES, run.alias(INSERTED)).withColumn(DAY, day_of(TS))
        if opt.retract:
            kept = prev_d.join(anomalies.select(*KEY), list(KEY), "left_anti")
            merged = kept.unionByName(new).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                # a day whose rows are all flagged has none to overwrite its partition with
                gone = sorted(set(days) - set(_days(merged)))
                store.overwrite_days("clean", merged)
            finally:
                merged.unpersist()
            store.drop_days("clean", gone)
        else:
            store.append("clean", new)
    with timed(report, "clean.stats"):
        _refresh_clean_stats(store, days)
        # both "done" markers in one flush; a crash before it only repeats idempotent work
        led.stamp(counted, "counted")
        led.stamp(days, "cleaned")
        led.flush()
    return days


def clean_step(spark: SparkSession, store: TableStore, led: Ledger, run_ts: datetime, opt: Options,
               report: RunReport) -> list:
    """Steps 2-6: returns the days the clean step processed."""
    run = ts_literal(run_ts)
    with timed(report, "clean.state"):
        _ensure_day_stats(store, led)
        raw = store.read("raw")
        cs = store.read("clean_stats")
        # previous clean: emptiness and cutoff from per-day stats; anchor from the ledger
        cutoff_ts = cs.agg(F.max("max_ts")).first()[0] if store.exists("clean_stats") else None
        anchor = led.anchor()
        anomalies_empty = store.is_empty("anomalies")
    if anchor is None:
        return []
    with timed(report, "clean.bounds"):
        band = _band(raw, cs, cutoff_ts is None, opt, report)
    if band is None:
        return []
    try:
        with timed(report, "clean.anomalies"):
            _flag(store, raw, led, band, cutoff_ts, anomalies_empty, run, opt, report)
    finally:
        if isinstance(band, DataFrame):
            band.unpersist()
    anomalies = store.stored("anomalies")
    counted = _profile(store, led, raw, anomalies, anchor, run, opt, report)
    days = _insert_clean(store, led, raw, anomalies, run, opt, report, counted)
    report.cleaning = "done"
    return days


def summary_step(spark: SparkSession, store: TableStore, led: Ledger, run_ts: datetime, days: list,
                 report: RunReport, opt: Options) -> None:
    """Steps 7-8, for the days the ledger shows as not yet summarised."""
    run = ts_literal(run_ts)
    if not led.days:
        return
    sdays = led.stale("summarised", "cleaned")
    if sdays:
        with timed(report, "summaries.daily"):
            fresh = daily_summary(store.read_days("clean", sdays)).withColumn(INSERTED, run)
            prev = store.read_days("daily_summary", sdays)
            if opt.retract:
                # devices and days whose readings all left clean lose their summary
                prev = prev.join(fresh.select(DAY, DEVICE), [DAY, DEVICE], "left_semi")
            store.overwrite_days("daily_summary", upsert(prev, fresh, [DAY, DEVICE], keep_first=[INSERTED]))
            if opt.retract:
                store.drop_days("daily_summary", [d for d in sdays if not store.has_day("clean", d)])
    anomalies = store.stored("anomalies")
    changed = False
    with timed(report, "summaries.anomaly_counts"):
        # counts depend on the anomaly keys only: recount the days that gained keys
        adays = led.stale("anom_counted", "anom_changed")
        if not store.exists("anomaly_counts"):
            if store.exists("anomalies"):
                store.overwrite_days("anomaly_counts", anomaly_counts_long(anomalies))
                changed = True
        elif adays:
            store.overwrite_days("anomaly_counts", anomaly_counts_long(
                anomalies.where(F.col(DAY).isin(adays))))
            changed = True
    led.stamp(sdays, "summarised")
    led.stamp(adays, "anom_counted")
    led.flush()
    # the wide table is a function of the counts: rebuilt only when they changed
    if opt.wide_pivot and store.exists("anomaly_counts") and (changed or not store.exists("anomaly_pivot")):
        with timed(report, "summaries.anomaly_pivot"):
            counts = store.read("anomaly_counts")
            store.replace("anomaly_pivot", anomaly_pivot(anomalies, counts=counts).orderBy(DAY))


def run_daily(spark: SparkSession, feed_dir: str, root: str, run_ts: datetime,
              options: Options | None = None, archive_dir: str | None = None) -> RunReport:
    opt = options or Options()
    store = TableStore(spark, root)
    led = Ledger(store)
    report = RunReport(run_ts)
    with timed(report, "ingest"):
        ingest(spark, store, led, feed_dir, run_ts, opt, report, archive_dir)
    derive(spark, store, led, run_ts, opt, report)
    return report


def derive(spark: SparkSession, store: TableStore, led: Ledger, run_ts: datetime, opt: Options,
           report: RunReport) -> None:
    """Steps 2-8 and the run's row in ``runs``."""
    with timed(report, "clean"):
        days = clean_step(spark, store, led, run_ts, opt, report)
    with timed(report, "summaries"):
        summary_step(spark, store, led, run_ts, days, report, opt)
    record_run(spark, store, led, report, opt)


def record_run(spark: SparkSession, store: TableStore, led: Ledger, report: RunReport, opt: Options) -> None:
    """One row per run: the band actually applied (so a flag can be reproduced
    exactly later), batch sizes and step timings."""
    b = report.band or {}
    tested = opt.outlier_scope == "parity" and not opt.bound_groups
    row = (report.run_ts, len(report.files), report.new_rows, report.rejected, report.baseline_source,
           b.get("mean_power"), b.get("std_power"), b.get("lower_bound"), b.get("upper_bound"),
           report.cleaning, json.dumps(report.timings), led.seq, tested, tested and opt.refresh_reflagged)
    store.append("runs", spark.createDataFrame([row], RUNS).coalesce(1))
