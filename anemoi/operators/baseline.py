"""A1-A3: high-water mark, mean / population sigma, and the mean +- k*sigma band."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemoi.schema import POWER, TS


def high_water_mark(df: DataFrame, col: str = TS, name: str = "high_water_mark") -> DataFrame:
    """``MAX(timestamp)`` as a one-row frame (NULL on an empty table)."""
    return df.agg(F.max(col).alias(name))


def with_band(m: DataFrame, k: float = 2.0) -> DataFrame:
    """Keep rows with a defined band (mean present, sigma > 0) and add
    ``lower_bound = mean - k*sigma``, ``upper_bound = mean + k*sigma``."""
    return (m.where(F.col("mean_power").isNotNull() & (F.col("std_power") > 0))
             .withColumn("lower_bound", F.col("mean_power") - F.lit(k) * F.col("std_power"))
             .withColumn("upper_bound", F.col("mean_power") + F.lit(k) * F.col("std_power")))


def band_of(mean: float | None, std: float | None, k: float = 2.0) -> tuple[float, float] | None:
    """The band of collected statistics; None where it is undefined."""
    return None if mean is None or not std or std != std else (mean - k * std, mean + k * std)


def bounds(df: DataFrame, k: float = 2.0, col: str = POWER, groups=()) -> DataFrame:
    """Mean, population sigma and band per group (one row when ``groups`` is empty).

    A group whose mean or sigma is NULL, or whose sigma is 0, has no band and
    is dropped, so nothing is flagged for it.
    """
    g = df.groupBy(*groups) if groups else df
    m = g.agg(F.avg(col).alias("mean_power"), F.stddev_pop(col).alias("std_power"))
    return with_band(m, k)


def band(bounds_df: DataFrame) -> tuple[Column, Column]:
    """Lower and upper bound of a one-row bounds frame as scalar subqueries.

    They stay lazy (no driver round trip); Catalyst merges the two subqueries
    into one aggregate and pushes the comparison into the Parquet scan.
    """
    return (bounds_df.select("lower_bound").scalar(),
            bounds_df.select("upper_bound").scalar())
