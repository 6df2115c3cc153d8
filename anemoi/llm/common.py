"""Shared pieces of the training-data operators: scratch tables, row keys, row numbers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemoi.scratch import shared_folder

# white space of every word contract: space and \t \n \v \f \r
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; only a local session may name none."""
    return shared_folder(spark)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and reread.

    Cuts lineage: an executor lost later costs a reread, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/anemoi-llm/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers import their modules there; a cluster's workers have
    none of the driver's files.
    """
    sc = spark.sparkContext
    # rows hold whole texts: smaller Arrow batches than the default, unless the session chose
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))
    if getattr(sc, "_anemoi_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="anemoi-py-"), "anemoi.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._anemoi_shipped = True


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch table under the shared folder (call it once results are written)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/anemoi-llm")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text (null: none); white space is ASCII only."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Join key of a document row that is never null: rows with one id and one text share it."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k_id"),
            F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.coalesce(F.col(text_col), F.lit(""))).alias("k_text")]


def numbered(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with gapless global row numbers from 0 in ``order`` (nulls first).

    A range shuffle sorts in parallel; each partition numbers its own rows and adds the
    number of rows before it, a sum over one row per partition. The sorted rows are
    written first, so that a lost executor cannot change the partition borders.
    """
    part = (df.repartitionByRange(*[F.col(c).asc() for c in order])
            .sortWithinPartitions(*[F.col(c).asc() for c in order])
            .withColumn("__part", F.spark_partition_id())
            .withColumn("__in", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    part = saved(part, "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bound set by the session, not by the data
    start = (part.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
             .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start")))
    return (part.join(F.broadcast(start), "__part")
            .withColumn(name, F.col("__in") + F.col("__start")).drop("__part", "__in", "__start"))
