"""Feeds that deliver *new* files, as a Structured Streaming query.

The file source remembers which files it has read (in the checkpoint), so a
file is read once, whole; each micro-batch then runs the daily contract
through ``foreachBatch``: merge into raw, flag, profile, clean, summarise.
Not for feeds that rewrite the same file name with more rows: a rewritten
path is not read again by the file source (use :func:`run_daily` for those).

A replayed micro-batch (after a failure) is harmless: raw and anomalies are
keyed upserts, clean is insert-ignore, tracker rows are append-only and read
as "latest per file".
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anemoi.plans.daily_run import RunReport, derive, merge_batch, timed
from anemoi.plans.ledger import Ledger
from anemoi.plans.store import TableStore
from anemoi.schema import CSV_TEXT, Options
from anemoi.sources.csv_feed import with_row_numbers


def feed_stream(spark: SparkSession, feed_dir: str, glob: str, max_files: int | None = None,
                archive_dir: str | None = None) -> DataFrame:
    r = (spark.readStream.schema(CSV_TEXT)
         .option("header", True)
         .option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record")
         .option("pathGlobFilter", glob))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = r.csv(feed_dir)
    return df.select("*", F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_block_start").alias("_split"))


def start_delivery(spark: SparkSession, feed_dir: str, root: str, checkpoint: str,
                   options: Options | None = None,
                   clock: Callable[[], datetime] = datetime.now,
                   available_now: bool = True, interval: str = "1 hour",
                   max_files: int | None = None, archive_dir: str | None = None,
                   reports: list | None = None) -> StreamingQuery:
    """Start the delivery query; ``available_now`` processes what is there and stops."""
    opt = options or Options()
    store = TableStore(spark, root)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        run_ts = clock()
        report = RunReport(run_ts)
        # The micro-batch is a plain scan of its files' splits, so split-local ids
        # are in file order; persisted, so both uses in the numbering agree.
        rows = batch.withColumn("_mono", F.monotonically_increasing_id()) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if rows.isEmpty():
                return
            with timed(report, "ingest"):
                led = Ledger(store)
                merge_batch(store, led, with_row_numbers(rows), run_ts, opt, report)
        finally:
            rows.unpersist()
        derive(spark, store, led, run_ts, opt, report)
        if reports is not None:
            reports.append((epoch_id, report))

    w = (feed_stream(spark, feed_dir, opt.feed_glob, max_files, archive_dir)
         .writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
