"""anemoi: Spark-native daily analytics for sensor telemetry.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL built-ins; only :mod:`anemoi.plans.store` and
:mod:`anemoi.plans.daily_run` write tables.
"""

__version__ = "0.1.0"
