"""Parquet tables under one root, readings partitioned by day.

Keyed writes without MERGE: a writer reads the existing rows of the days it
touches (partition pruning), merges them with the new rows by key, and
replaces exactly those day partitions (dynamic partition overwrite). Other
days' files are never rewritten. A failed write is re-runnable because every
merge is keyed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anemoi.schema import DAY, DAY_PARTITIONED, DEVICE, TABLES, TS

# Sort order inside each written file: readings by (device, time), value
# counts by (measure, value): compact encodings and tight row-group min/max.
SORTED = {
    "raw": (DAY, DEVICE, TS),
    "clean": (DAY, DEVICE, TS),
    "anomalies": (DAY, DEVICE, TS),
    "elig_counts": (DAY, "measure", "value"),
}
CODEC = "zstd"


def _schema(name: str):
    if name in TABLES:
        return TABLES[name]
    from anemoi.plans.day_stats import SCHEMAS
    return SCHEMAS.get(name)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        """Written at least once: a success marker or data. The folder alone, with the
        temporary files of a write that failed, is no table."""
        p, fs = self._fs(self.path(name))
        if not fs.exists(p):
            return False
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return "_SUCCESS" in names or any(not n.startswith(("_", ".")) for n in names)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table, or an empty frame of its schema when it was never written; anomalies
        with the insertion dates of the last run that flagged them."""
        if name == "anomalies" and schema is None:
            from anemoi.plans.reflag import LowTail
            return LowTail(self).refreshed(self.stored(name))
        return self.stored(name, schema)

    def stored(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table as written."""
        schema = schema or _schema(name)
        if not self.exists(name):
            if schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], schema)
        r = self.spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(self.path(name))

    def read_days(self, name: str, days: list) -> DataFrame:
        """Rows of the given days only (partition pruning on ``day``)."""
        df = self.stored(name)
        return df.where(F.col(DAY).isin(days)) if days else df.where(F.lit(False))

    def is_empty(self, name: str) -> bool:
        return (not self.exists(name)) or self.stored(name).isEmpty()

    def _order(self, name: str, df: DataFrame) -> DataFrame:
        schema = _schema(name)
        if schema is None:
            return df
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def _for_write(self, name: str, df: DataFrame) -> DataFrame:
        """Rebalance on ``day`` before a partitioned write: AQE then sizes the
        output files and splits a hot day across tasks instead of writing
        (tasks x days) small files."""
        df = self._order(name, df)
        df = df.hint("rebalance", DAY)
        if name in SORTED:
            df = df.sortWithinPartitions(*SORTED[name])
        return df

    def overwrite_days(self, name: str, df: DataFrame) -> None:
        """Replace the day partitions present in ``df``; leave all others."""
        (self._for_write(name, df).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(DAY).parquet(self.path(name)))

    def append(self, name: str, df: DataFrame) -> None:
        if name in DAY_PARTITIONED or name in ("clean_stats", "elig_counts"):
            self._for_write(name, df).write.mode("append").option("compression", CODEC) \
                .partitionBy(DAY).parquet(self.path(name))
        else:
            self._order(name, df).write.mode("append").option("compression", CODEC).parquet(self.path(name))

    def has_day(self, name: str, day) -> bool:
        """Whether the table has a partition of ``day`` (file metadata only)."""
        p, fs = self._fs(f"{self.path(name)}/{DAY}={day}")
        return bool(fs.exists(p))

    def drop_days(self, name: str, days: list) -> None:
        """Delete whole day partitions (driver-side file metadata only)."""
        for d in days:
            p, fs = self._fs(f"{self.path(name)}/{DAY}={d}")
            if fs.exists(p):
                fs.delete(p, True)

    def drop(self, name: str) -> None:
        """Delete a table."""
        p, fs = self._fs(self.path(name))
        fs.delete(p, True)

    def generations(self, name: str) -> list[str]:
        """Complete versions of a table that is written whole each time, oldest first."""
        p, fs = self._fs(self.path(name))
        if not fs.exists(p):
            return []
        return sorted(f.getPath().getName() for f in fs.listStatus(p) if self.exists(f"{name}/{f.getPath().getName()}"))

    def keep_generation(self, name: str, kept: str) -> None:
        """Delete all other versions."""
        p, fs = self._fs(self.path(name))
        for f in fs.listStatus(p):
            if f.getPath().getName() != kept:
                fs.delete(f.getPath(), True)

    def replace(self, name: str, df: DataFrame) -> None:
        """Drop and recreate (the pivot, whose columns follow the data)."""
        df.write.mode("overwrite").option("compression", CODEC).parquet(self.path(name))
