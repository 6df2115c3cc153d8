"""Driver tables -> telemetry columns (timestamp, turbine_id, three measures).

``events`` plays the sensor feed: ``ts`` is the reading time, ``user_id`` the
device, ``props.k`` the wind speed, ``event_id mod 360`` the direction and
``value`` the power (missing for ``error`` events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.functions.expressions import missing_as_null
from anemoi.schema import DEVICE, TS


def telemetry(events: DataFrame, two_sided: bool = False, zero_is_missing: bool = True) -> DataFrame:
    value = F.col("value")
    if two_sided:
        # The power column only has a high tail; mirroring odd devices adds a low one.
        value = F.when(F.col("user_id") % 2 == 1, F.lit(100.0) - value).otherwise(value)
    power = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(value)
    return events.select(
        F.col("ts").alias(TS),
        F.col("user_id").alias(DEVICE),
        missing_as_null(F.get_json_object("props", "$.k"), zero_is_missing).alias("wind_speed"),
        missing_as_null(F.col("event_id") % 360, zero_is_missing).alias("wind_direction"),
        missing_as_null(power, zero_is_missing).alias("power_output"),
    )


def telemetry_two_sided(events: DataFrame) -> DataFrame:
    return telemetry(events, two_sided=True)
