"""Token counts of flat token files that carry no index, by a scan for separators.

A flat file is the token ids of documents one after another, each ended by the
end-of-document id, cut into blocks of fixed size without regard to documents. The scan

1. finds the separators of every block with one vectorised comparison,
2. runs a prefix scan over the block summaries: tokens and separators before each block,
   and the last separator before it,
3. turns every separator into a document: its length is the distance to the separator
   before it, which may lie in an earlier block.

Documents are numbered within their file. Tokens after the last separator form a document
that is not ``closed``. Prefix sums go over buckets of BUCKET blocks and then over the
buckets, so that no task holds all blocks of a large file.

Defined results: an empty document has 0 tokens; a file of separators only gives empty
documents; blocks may be empty; an empty table gives no rows. For ``flat_files`` a null
text is an empty document, ids may be null or repeat, and extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from anemoi.llm.common import saved, ship, table
from anemoi.llm.tokens import EOD, VOCABULARY, encode

BLOCK = 1 << 18         # tokens
BUCKET = 1024           # blocks


def flat_files(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One flat file per partition of ``docs``: file, block, data (uint16 ids), doc_ids.

    ``doc_ids`` names the documents that end in the block. It is the caller's side record of
    what was written; the scan does not read it.
    """
    def write(batches):
        file, number, parts, held, ids = TaskContext.get().partitionId(), 0, [], 0, []
        names = ["file", "block", "data", "doc_ids"]

        def out(data, ids):
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number], pa.int64()),
                                               pa.array([data], pa.binary()), pa.array([ids], pa.list_(pa.int64()))], names=names)

        end = EOD.to_bytes(2, "little")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_py(), vocabulary) + end
                while held + len(data) > 2 * block:
                    cut = 2 * block - held
                    parts.append(data[:cut])
                    data = data[cut:]
                    yield out(b"".join(parts), ids)
                    number, parts, held, ids = number + 1, [], 0, []
                parts.append(data)
                held += len(data)
                ids.append(doc_id)
        if parts:
            yield out(b"".join(parts), ids)

    ship(docs.sparkSession)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(write, "file int, block long, data binary, doc_ids array<long>"))


def _before(df: DataFrame, values: dict) -> DataFrame:
    """Adds for each block what comes before it in its file: {name: (aggregate, column, start)}."""
    df = df.withColumn("bucket", F.floor(F.col("block") / BUCKET))
    inner = Window.partitionBy("file", "bucket").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    top = df.groupBy("file", "bucket").agg(*[fn(c).alias(n) for n, (fn, c, _) in values.items()])
    top = top.select("file", "bucket", *[fn(n).over(outer).alias(f"o_{n}") for n, (fn, _, _) in values.items()])
    df = df.select("*", *[fn(c).over(inner).alias(f"i_{n}") for n, (fn, c, _) in values.items()])
    df = df.join(top, ["file", "bucket"])
    for n, (fn, _, start) in values.items():
        i, o = F.coalesce(f"i_{n}", F.lit(start)), F.coalesce(f"o_{n}", F.lit(start))
        df = df.withColumn(n, i + o if fn is F.sum else F.greatest(i, o))
    return df.drop("bucket", *[f"{p}_{n}" for n in values for p in "io"])


def separator_scan(blocks: DataFrame, separator: int = EOD) -> DataFrame:
    """file, ordinal, start, n_tokens, closed of every document in (file, block, data)."""
    def scan(batches):
        for batch in batches:
            sizes, found = [], []
            for data in batch.column(2):
                ids = np.frombuffer(data.as_py() or b"", dtype="<u2")
                sizes.append(len(ids))
                found.append(np.flatnonzero(ids == separator))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["file", "block", "size", "at"])

    ship(blocks.sparkSession)
    b = saved(blocks.select("file", "block", "data").mapInArrow(
        scan, "file int, block long, size long, at array<long>"), "separators")
    # where each block starts, then where the last separator before it stands
    b = _before(b.withColumn("n", F.size("at").cast("long")),
                {"first": (F.sum, "size", 0), "ordinal": (F.sum, "n", 0)})
    b = b.withColumn("last", F.when(F.col("n") > 0, F.element_at("at", -1) + F.col("first")))
    b = saved(_before(b, {"previous": (F.max, "last", -1)}), "stitched")
    ends = b.where("n > 0").select("file", "first", "ordinal", "previous", "at", F.posexplode("at").alias("k", "x"))
    before = F.when(F.col("k") > 0, F.get("at", F.col("k") - 1) + F.col("first")).otherwise(F.col("previous"))
    closed = ends.select("file", (F.col("ordinal") + F.col("k")).alias("ordinal"), (before + 1).alias("start"),
                         (F.col("x") + F.col("first") - before - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    tail = (b.groupBy("file").agg(F.max(F.col("first") + F.col("size")).alias("all"), F.sum("n").alias("ordinal"),
                                  F.max(F.coalesce("last", F.lit(-1).cast("long"))).alias("last"))
            .where("last + 1 < all").select("file", "ordinal", (F.col("last") + 1).alias("start"),
                                            (F.col("all") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed")))
    return closed.unionAll(tail)


def counted(docs: DataFrame, vocabulary: str = VOCABULARY, block: int = BLOCK) -> DataFrame:
    """doc_id, file, ordinal, n_tokens of every document, counted in the flat files written from ``docs``."""
    flat = saved(flat_files(docs, vocabulary, block), "flat")
    names = _before(flat.select("file", "block", "doc_ids", F.size("doc_ids").cast("long").alias("n")),
                    {"ordinal": (F.sum, "n", 0)})
    names = names.select("file", "ordinal", F.posexplode("doc_ids").alias("k", "doc_id")).select(
        "file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "doc_id")
    return names.join(separator_scan(flat), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")


def op2_token_counts(spark, sf_dir):
    return counted(table(spark, sf_dir, "documents"))
