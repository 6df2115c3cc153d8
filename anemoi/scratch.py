"""Written intermediate tables: they cut lineage, and a lost executor costs a reread.

They live in the folder that all executors share, named by ``spark.checkpoint.dir``. Only a local
session that names none gets a temporary folder of its own; a cluster session must name one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(CONF, None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CONF} to a folder that the driver and all executors share")
    if not getattr(sc, "_anemoi_scratch", None):
        sc._anemoi_scratch = tempfile.mkdtemp(prefix="anemoi-scratch-")
    return sc._anemoi_scratch


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` as a Parquet table of its own (``path``, else a new one), reread."""
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/anemoi/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear(spark: SparkSession) -> None:
    """Delete every intermediate table of the core operators (once results are written)."""
    drop_folder(spark, f"{shared_folder(spark)}/anemoi")
