"""Exact order statistics of weighted values, from one sorted pass.

A per-group ``median()`` or window keeps every distinct value of a group in one task. Here the
values are sorted once by a range shuffle over (groups, value), so a hot group spreads over as
many partitions as its size asks for, and are written with the number of their partition. One
aggregate over that table gives, per partition and group, the weight and what else is asked of
it: a few rows per partition. Running sums over those say which partition holds rank ``k``, and
only the rows of such partitions are ranked one by one. The sorted table is written so that
every reader sees the same partition borders, also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemoi.scratch import written

PART = "_part"


def sorted_values(values: DataFrame, groups: Sequence[str], value: str, path: str | None = None) -> DataFrame:
    """``values`` with a non-NULL value, written in order of (groups, value); ``_part`` numbers
    the partitions in that order."""
    order = [*groups, value]
    rows = (values.where(F.col(value).isNotNull()).repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn(PART, F.spark_partition_id()))
    return written(rows, "sorted", path)


def weights_before(parts: DataFrame, groups: Sequence[str], weight: str) -> DataFrame:
    """``parts`` (one row per group and partition) with ``_before``, the weight of the group's
    earlier partitions, and ``_total``, the group's weight."""
    w = Window.partitionBy(*groups)
    return parts.withColumns({
        "_before": F.coalesce(F.sum(weight).over(w.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)),
        "_total": F.sum(weight).over(w)})


def kth_smallest(values: DataFrame, groups: Sequence[str], value: str, targets: DataFrame,
                 weight: str | None = None, out: str | None = None) -> DataFrame:
    """For each row ``(groups..., k)`` of ``targets`` (0-based rank, counting ``weight`` copies
    per row when given), the value of rank ``k`` within its group. Targets with ``k`` outside
    ``[0, N)`` produce no row. NULL values are ignored; NaN must have been removed."""
    groups, out = list(groups), out or value
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    rows = sorted_values(values.select(*groups, F.col(value).alias("_v"), w.alias("_w")), groups, "_v")
    parts = weights_before(rows.groupBy(*groups, PART).agg(F.sum("_w").alias("_s")), groups, "_s")
    wanted = targets.select(*groups, F.col("k").cast("long").alias("k")).distinct()
    hits = (parts.join(wanted, groups).where((F.col("_before") <= F.col("k")) & (F.col("k") < F.col("_before") + F.col("_s")))
            .select(*groups, PART, "k", "_before"))
    run = Window.partitionBy(*groups, "k").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_before") + F.sum("_w").over(run)
    return (rows.join(hits, [*groups, PART]).withColumn("_end", end)
            .where((F.col("_end") - F.col("_w") <= F.col("k")) & (F.col("k") < F.col("_end")))
            .select(*groups, "k", F.col("_v").alias(out)))
