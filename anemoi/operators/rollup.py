"""Daily minimum, maximum and mean power per device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.schema import DAY, DEVICE, POWER, TS


def daily_summary(clean: DataFrame) -> DataFrame:
    """One row per (day, device). Partial + final HashAggregate: a hot device
    is pre-aggregated map-side, so skew never reaches one reducer."""
    return (clean
            .groupBy(F.to_date(TS).alias(DAY), F.col(DEVICE))
            .agg(F.min(POWER).alias("min_power_output"),
                 F.max(POWER).alias("max_power_output"),
                 F.avg(POWER).alias("avg_power_output")))
