"""Move consumed feed files to an archive folder with a time-stamped name.

Runs on the driver after the raw table and the tracker are committed (file
metadata only, no data). Uses the Hadoop FileSystem of the path, so it works
for any store Spark can read.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import SparkSession


def archive_files(spark: SparkSession, files: list[str], archive_dir: str, when: datetime) -> list[str]:
    stamp = when.strftime("%Y%m%d_%H%M%S")
    moved = []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in files:
        name = unquote(f.rstrip("/").rsplit("/", 1)[-1])
        dst = f"{archive_dir.rstrip('/')}/{stamp}_{name}"
        src_p = jvm.org.apache.hadoop.fs.Path(f)
        dst_p = jvm.org.apache.hadoop.fs.Path(dst)
        fs = src_p.getFileSystem(conf)
        fs.mkdirs(dst_p.getParent())
        n = 1
        while fs.exists(dst_p):        # an earlier run with the same run time
            n += 1
            dst = f"{archive_dir.rstrip('/')}/{stamp}-{n}_{name}"
            dst_p = jvm.org.apache.hadoop.fs.Path(dst)
        if not fs.rename(src_p, dst_p):
            raise OSError(f"could not archive {f}")
        moved.append(dst)
    return moved
