"""Session helpers: scale-minded defaults, table folder lookup."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "anemoi",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Create (or reuse) a session with AQE and skew handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table_root(spark: SparkSession, given: str | None = None) -> str:
    """Root folder of the telemetry tables: ``given`` or the setting ``anemoi.tables.root``.

    There is no default: tables belong in a folder that all executors share and keep.
    """
    root = given or spark.conf.get("anemoi.tables.root", None)
    if not root:
        raise ValueError("no table folder: give --root or set anemoi.tables.root")
    return root
