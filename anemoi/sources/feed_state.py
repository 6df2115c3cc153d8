"""Per-file offsets of an append-only feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemoi.operators.keyed import latest_per_key
from anemoi.schema import TS
from anemoi.scratch import written


def latest_offsets(tracker: DataFrame) -> DataFrame:
    """Newest tracker row per file: by run number, then insertion date."""
    order = ["run_seq", "data_insertion_date", "last_record_csv_row_number"]
    return latest_per_key(tracker, ["file_name"], [c for c in order if c in tracker.columns],
                          ["last_record_timestamp", "last_record_csv_row_number"])


def tail_rows(rows: DataFrame, offsets: DataFrame, file_col: str = "file_name",
              row_col: str = "row_no") -> DataFrame:
    """Rows past the stored offset of their file (all rows of a new file).

    The offsets frame has one row per file ever delivered; adaptive execution
    broadcasts it while it is small.
    """
    off = offsets.select(F.col("file_name").alias(file_col),
                         F.col("last_record_csv_row_number").alias("_off"))
    return (rows.join(off, [file_col], "left")
                .where(F.col(row_col) > F.coalesce(F.col("_off"), F.lit(0)))
                .drop("_off"))


def number_rows(rows: DataFrame, group: str, order: str, out: str = "row_no") -> DataFrame:
    """1-based row numbers by ``order`` inside each ``group``, NULLs first; a NULL group is a group.

    A range shuffle over (group, order, place in the input) sorts all rows into partitions of
    about equal size, whatever the values: outliers, ties and a group of most of the rows spread
    like any others. The sorted rows are written, so that the borders hold for every reader. A
    row's number is its place in its partition, less the place where its group begins there,
    plus the group's rows in earlier partitions: a sum over one row per partition and group.
    """
    keys = [F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first(), F.col("_tie")]
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                   .withColumns({"_part": F.spark_partition_id(),
                                 "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "numbered")
    parts = rows.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_group", "_p", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_add"))
    same = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_group"))
    return (rows.join(parts, same).withColumn(out, F.col("_at") + F.col("_add"))
            .drop("_part", "_at", "_p", "_group", "_add"))


def feed_state(rows: DataFrame, run_ts: Column, prior: DataFrame | None = None,
               file_col: str = "file_name", order_col: str = "row_no", ts_col: str = TS) -> DataFrame:
    """New tracker rows: per file with new rows, the timestamp of the last row
    in file order and the new row count (prior offset + batch size)."""
    g = rows.groupBy(F.col(file_col).alias("file_name")).agg(
        F.max_by(F.col(ts_col), F.col(order_col)).alias("last_record_timestamp"),
        F.count(F.lit(1)).alias("_n"))
    if prior is not None:
        p = prior.select("file_name", F.col("last_record_csv_row_number").alias("_prior"))
        g = g.join(p, ["file_name"], "left")
        n = F.coalesce(F.col("_prior"), F.lit(0)) + F.col("_n")
    else:
        n = F.col("_n")
    return g.select(run_ts.alias("data_insertion_date"), "file_name", "last_record_timestamp",
                    n.cast("long").alias("last_record_csv_row_number"))
