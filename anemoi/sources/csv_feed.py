"""One scan over all feed CSVs, exact row numbers, parse, validate.

Row numbers of a splittable CSV without a shuffle of the rows: each split is
read in file order by one task, so ``monotonically_increasing_id`` is a dense
run inside it. Per (file, split start) we count rows and take the smallest id;
running sums of those counts per file (one row per split, a few thousand per
terabyte) give each split's offset. Requires ``multiLine=false`` and no filter
before numbering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anemoi.functions.expressions import missing_as_null, parse_timestamp
from anemoi.schema import CSV_TEXT, DEVICE, FEED_PREFIX, MEASURES, TS


def scan_feed(spark: SparkSession, paths, glob: str = FEED_PREFIX + "*.csv") -> DataFrame:
    """All matching CSV files as text columns plus ``file_name`` and ``row_no``
    (1-based data row, header excluded)."""
    df = (spark.read.schema(CSV_TEXT)
          .option("header", True)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .option("multiLine", False)
          .option("pathGlobFilter", glob)
          .csv(paths))
    df = df.select("*", F.col("_metadata.file_name").alias("file_name"),
                   F.col("_metadata.file_block_start").alias("_split"),
                   F.monotonically_increasing_id().alias("_mono"))
    return with_row_numbers(df)


def with_row_numbers(df: DataFrame, file_col: str = "file_name", split_col: str = "_split",
                     mono_col: str = "_mono") -> DataFrame:
    splits = df.groupBy(file_col, split_col).agg(F.count(F.lit(1)).alias("_cnt"),
                                                 F.min(mono_col).alias("_first"))
    before = Window.partitionBy(file_col).orderBy(split_col).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(file_col, split_col, "_first",
                           F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"))
    # One row per split (about 8,000 per TB of input): adaptive execution broadcasts it
    # while it is small, and the rows then don't shuffle.
    out = df.join(splits, [file_col, split_col])
    return out.withColumn("row_no", F.col("_before") + F.col(mono_col) - F.col("_first") + 1) \
              .drop(split_col, mono_col, "_first", "_before")


def _fields(line: Column) -> Column:
    """Number of comma-separated fields of a CSV line; commas inside quotes don't count."""
    return F.size(F.split(F.regexp_replace(line, r'"(?:[^"]|"")*"', ""), ",", -1))


def parse_readings(text: DataFrame, day_first: bool = False, zero_is_missing: bool = True) -> DataFrame:
    """Typed readings plus ``reject_reason`` (NULL for a valid row).

    A row is rejected when it has more fields than columns, or its timestamp or
    device id does not parse. A short row's missing fields are NULL; ids may be
    written with an integral fraction (``1.0``). Measures that do not parse, NaN
    and (by default) 0 become NULL.
    """
    ts = parse_timestamp(F.col(TS), day_first)
    dev = F.regexp_replace(F.trim(F.col(DEVICE)), r"\.0*$", "").try_cast("long")
    # the parser flags short rows too; only extra fields make a row invalid
    extra_fields = (F.coalesce(_fields(F.col("_corrupt_record")) > len(MEASURES) + 2, F.lit(False))
                    if "_corrupt_record" in text.columns else F.lit(False))
    reason = (F.when(extra_fields, F.lit("field_count"))
               .when(ts.isNull(), F.lit("timestamp"))
               .when(dev.isNull(), F.lit(DEVICE)))
    extra = [c for c in text.columns if c not in (TS, DEVICE, *MEASURES, "_corrupt_record")]
    fields = [c for c in (TS, DEVICE, *MEASURES, "_corrupt_record") if c in text.columns]
    return text.select(
        ts.alias(TS), dev.alias(DEVICE),
        *[missing_as_null(F.trim(F.col(m)).try_cast("double"), zero_is_missing).alias(m) for m in MEASURES],
        *extra, reason.alias("reject_reason"),
        # the original text, kept for rejected rows only
        F.when(reason.isNotNull(), F.to_json(F.struct(*fields))).alias("reject_text"))


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = parsed.where(F.col("reject_reason").isNull()).drop("reject_reason", "reject_text")
    bad = parsed.where(F.col("reject_reason").isNotNull())
    return ok, bad
