"""Outlier flagging and anomaly counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoi.operators.baseline import band
from anemoi.schema import DAY, DEVICE, KEY, MEASURES, PIVOT_PREFIX, POWER, TS

READING_COLS = KEY + MEASURES
PIVOT_WIDTH = 1000      # devices of a block of the wide pivot


def outlier_predicate(lo: Column, hi: Column, cutoff: Column | None = None,
                      scope: str = "parity") -> Column:
    """Strict band test; NULL power is never an outlier.

    Without a cutoff both tails are tested over all rows (first run). With one,
    ``parity`` keeps the reference precedence ``p < lo OR (p > hi AND ts > cutoff)``:
    low outliers are re-tested over all history, high ones after the cutoff only.
    ``new_rows`` applies the cutoff to both tails.
    """
    p = F.col(POWER)
    low, high = p < lo, p > hi
    if cutoff is None:
        return low | high
    after = F.col(TS) > cutoff
    if scope == "parity":
        return low | (high & after)
    if scope == "new_rows":
        return (low | high) & after
    raise ValueError(f"unknown outlier scope {scope!r}")


def flag_outliers(raw: DataFrame, bounds_df, cutoff: Column | None = None,
                  scope: str = "parity", groups=()) -> DataFrame:
    """Readings of ``raw`` outside the band of ``bounds_df``.

    ``bounds_df`` is a bounds frame or a ``(lower, upper)`` pair of numbers.
    Numbers become literals and the range test is pushed into the Parquet scan.
    A one-row frame is applied lazily through scalar subqueries, which Catalyst
    merges into one aggregate (no driver round trip). Per-group bands are
    joined on the group columns; the join strategy is left to AQE since their
    number grows with the groups.
    """
    if isinstance(bounds_df, tuple):
        lo, hi = (F.lit(float(x)) for x in bounds_df)
        return raw.where(outlier_predicate(lo, hi, cutoff, scope))
    if groups:
        b = bounds_df.select(*groups, "lower_bound", "upper_bound")
        pred = outlier_predicate(F.col("lower_bound"), F.col("upper_bound"), cutoff, scope)
        return raw.join(b, list(groups)).where(pred).select(*raw.columns)
    lo, hi = band(bounds_df)
    return raw.where(outlier_predicate(lo, hi, cutoff, scope))


def anomaly_counts_long(anomalies: DataFrame) -> DataFrame:
    """Anomalies per (day, device): the primary, unbounded-width form."""
    return (anomalies.groupBy(F.to_date(TS).alias(DAY), F.col(DEVICE))
            .agg(F.count(F.lit(1)).alias("anomaly_count")))


def distinct_ids(anomalies: DataFrame) -> DataFrame:
    """Devices with anomalies, ascending."""
    return anomalies.select(DEVICE).distinct().orderBy(DEVICE)


def wide_rows(counts: DataFrame, days: DataFrame, devices: DataFrame, width: int) -> DataFrame:
    """``days`` x ``devices`` in rows of about ``width`` devices: (day, block, cells), cells
    as (column, n) by device, 0 where a device had no anomaly.

    A device's block is a hash of its id modulo as many blocks as the devices need, found
    by a scalar subquery. Only counted cells are shuffled singly; zeros are added where
    a day's block is put together, in a fixed number of tasks, as the few bytes of a block
    do not tell its cells. The days, one small row each, are broadcast. As in an equi-join,
    a NULL day or device matches no count.
    """
    number = devices.agg(F.greatest(F.ceil(F.count(F.lit(1)) / width), F.lit(1))).scalar()
    block = F.pmod(F.xxhash64(DEVICE), number).alias("block")
    ids = F.transform(F.collect_list(F.struct(DEVICE)), lambda s: s[DEVICE])     # keeps a NULL
    cell = F.struct(F.col(DEVICE), F.col("anomaly_count").cast("long").alias("n"))
    counted = (counts.where(F.col(DEVICE).isNotNull()).groupBy(DAY, block)
               .agg(F.collect_list(cell).alias("counted")))
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (devices.groupBy(block).agg(ids.alias("ids")).crossJoin(F.broadcast(days))
            .repartition(tasks, DAY, "block").join(counted, [DAY, "block"], "left"))
    rest = F.array_except("ids", F.coalesce(F.transform("counted", lambda c: c[DEVICE]), F.array()))
    zeros = F.transform(rest, lambda i: F.struct(i.alias(DEVICE), F.lit(0).cast("long").alias("n")))
    cells = F.sort_array(F.concat(F.coalesce("counted", F.array()), zeros))
    name = lambda c: F.concat(F.lit(PIVOT_PREFIX), c[DEVICE].cast("string"))     # noqa: E731
    return rows.select(DAY, "block", F.transform(
        cells, lambda c: F.struct(name(c).alias("column"), c["n"].alias("n"))).alias("cells"))


def anomaly_pivot(anomalies: DataFrame | None, ids: list | None = None,
                  counts: DataFrame | None = None, width: int | None = None) -> DataFrame:
    """Days x devices, 0 where a device had no anomaly.

    With ``width`` the columns come in blocks of about that many devices, one row per day
    and block (:func:`wide_rows`): schema and plan stay the same for any number of devices,
    and nothing is collected. Without it every device is a column of the schema, which is
    read with one distinct query unless ``ids`` is given; such a plan grows with the devices
    and suits some thousands of them. A day's blocks are then joined to one JSON object and
    read with the wide schema: a plan of a few expressions, where one conditional aggregate
    per device takes seconds to compile. Order by day where it is shown.
    ``counts`` (the long form, e.g. as just written) saves re-aggregating the anomalies.
    """
    long = counts if counts is not None else anomaly_counts_long(anomalies)
    days, devices = long.select(DAY).distinct(), long.select(DEVICE).distinct()
    if ids is not None:
        field = T.StructField(DEVICE, long.schema[DEVICE].dataType)
        devices = long.sparkSession.createDataFrame([(i,) for i in ids], T.StructType([field]))
        long = long.join(devices, DEVICE, "left_semi")
    rows = wide_rows(long, days, devices, width or PIVOT_WIDTH)
    if width:
        return rows
    if ids is None:
        ids = [r[0] for r in devices.orderBy(DEVICE).collect()]
    if not ids:
        return days.where(F.lit(False))
    wide = T.StructType([T.StructField(f"{PIVOT_PREFIX}{i}", T.LongType()) for i in ids])
    cells = F.flatten(F.collect_list("cells"))
    row = F.from_json(F.to_json(F.map_from_entries(cells)), wide)
    return rows.groupBy(DAY).agg(row.alias("row")).select(DAY, "row.*")


def pivot_cells(wide: DataFrame) -> DataFrame:
    """All cells of either wide form, zeros included: (day, column, n)."""
    if "cells" in wide.columns:
        return wide.select(DAY, F.inline("cells"))
    names = [c for c in wide.columns if c != DAY]
    if not names:
        return wide.select(DAY, F.lit("").alias("column"), F.lit(0).cast("long").alias("n")).where(F.lit(False))
    cells = F.from_json(F.to_json(F.struct(*names)), "map<string,bigint>")
    return wide.select(DAY, F.explode(cells).alias("column", "n"))
