"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows are numbered by document id, the number is permuted, and the permuted place p gives
``shard = p % shards`` and ``slot = p // shards``. Whoever knows the row number, the row
count and the seed can compute shard and slot without reading the data (``place``), and go
back (``row_at``). Shard sizes differ by one row at most (law ``rows``).

The permutation works on the smallest even number of bits that holds the row count, less
than four times as many places; numbers that land beyond the count are permuted again
until they fall inside (cycle walking), about four rounds at worst on average.

Defined results: a null text has size 1 and the checksum of the empty text; ties of
document id are ordered by size and checksum, so repeated rows are interchangeable; null
ids come first; extra columns are ignored by ``sharded`` and kept by ``shard_rows``; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import numbered, ship, table

SHARDS = 8
SEED = 20240601
ROUNDS = 6
_M32 = np.uint64(0xFFFFFFFF)


def _keys(seed: int) -> list[np.uint64]:
    """One 32-bit key per round, from the seed by a linear congruence."""
    x, out = seed & 0xFFFFFFFF, []
    for _ in range(ROUNDS):
        x = (x * 1664525 + 1013904223) & 0xFFFFFFFF
        out.append(np.uint64(x))
    return out


def _half_bits(total: int) -> int:
    return max(1, (max(total - 1, 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    """Round function on 32-bit values, kept in 64-bit arithmetic."""
    x = ((x ^ key) * np.uint64(0x9E3779B1)) & _M32
    x = ((x ^ (x >> np.uint64(15))) * np.uint64(0x85EBCA77)) & _M32
    return x ^ (x >> np.uint64(13))


def _once(n: np.ndarray, half: int, keys, back: bool) -> np.ndarray:
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = n >> h, n & mask
    for k in (reversed(keys) if back else keys):
        if back:
            left, right = right ^ (_mix(left, k) & mask), left
        else:
            left, right = right, left ^ (_mix(right, k) & mask)
    return (left << h) | right


def permute(numbers, total: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The permutation of 0..total-1 (or its inverse) at ``numbers``."""
    n = np.asarray(numbers, dtype=np.uint64).copy()
    half, keys = _half_bits(total), _keys(seed)
    todo = np.arange(len(n))
    while len(todo):
        n[todo] = _once(n[todo], half, keys, back)
        todo = todo[n[todo] >= np.uint64(total)]
    return n.astype(np.int64)


def place(row_no, total: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of global row numbers, without reading any data."""
    p = permute(row_no, total, seed)
    return p % shards, p // shards


def row_at(shard, slot, total: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """The global row number that sits at (shard, slot)."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), total, seed, back=True)


def shard_rows(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long): one sort for the numbers, no other shuffle."""
    ship(df.sparkSession)
    rows = numbered(df, order, "__row")
    total = rows.count()

    @F.pandas_udf("long")
    def permuted(n: pd.Series) -> pd.Series:
        return pd.Series(permute(n.to_numpy(), total, seed))

    return (rows.withColumn("__row", permuted("__row"))
            .withColumn("shard", (F.col("__row") % shards).cast("int"))
            .withColumn("slot", F.expr(f"__row div {shards}"))
            .drop("__row"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    rows = shard_rows(sized(docs), ["doc_id", "size", "text_crc32"], shards, seed)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, with ``shard`` and ``slot`` (replaced if there)."""
    rows = docs.withColumn("__tie", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return shard_rows(rows, [id_col, "__tie"], shards, seed).drop("__tie")


def op4_sharding(spark, sf_dir):
    return sharded(table(spark, sf_dir, "documents"))


def permuted_sql(rows: str, total: str, columns: str, seed: int = SEED, shards: int = SHARDS) -> str:
    """DuckDB SQL that deals ``rows`` (with ``no``, its row number) out: columns, shard, slot.

    ``total`` is a table of one row, ``total``. The recursion is the cycle walk.
    """
    step = "SELECT no, k, n >> half AS l, n & mask AS r, half, mask FROM walk, size WHERE k = 0 OR n >= total"
    for key in _keys(seed):
        step = f"""
    SELECT no, k, half, mask, old_r AS l, xor(old_l, xor(z, z >> 13) & mask) AS r FROM (
      SELECT *, (xor(y, y >> 15) * 2246822519::UBIGINT) & 4294967295 AS z FROM (
        SELECT no, k, half, mask, l AS old_l, r AS old_r,
               (xor(r, {key}::UBIGINT) * 2654435761::UBIGINT) & 4294967295 AS y FROM ({step})))"""
    return f"""
WITH RECURSIVE half AS (SELECT total, greatest(1, (length(bin(greatest(total - 1, 1))) + 1) // 2) AS half FROM ({total})),
size AS (SELECT total::UBIGINT AS total, half::UBIGINT AS half, ((1::UBIGINT << half::UBIGINT) - 1)::UBIGINT AS mask FROM half),
dealt AS MATERIALIZED ({rows}),
walk AS (SELECT no, 0 AS k, no::UBIGINT AS n FROM dealt
  UNION ALL SELECT no, k + 1, (l << half) | r FROM ({step}))
SELECT {columns}, (n % {shards})::INT AS shard, (n // {shards})::BIGINT AS slot
FROM dealt JOIN walk USING (no), size WHERE k > 0 AND n < total
"""


# CRC-32 of the UTF-8 bytes, byte by byte over its table of 256 remainders
ORACLE = permuted_sql("""
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS no FROM (
    SELECT doc_id, strlen(t)::BIGINT + 1 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
             xor(c >> 8, remainders[((xor(c, b) & 255) + 1)::INT])), 4294967295)::BIGINT AS text_crc32
    FROM (SELECT doc_id, t, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT) AS bytes
          FROM (SELECT doc_id, coalesce(text, '') AS t, hex(coalesce(text, '')) AS h FROM documents)),
         (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1
             THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS remainders FROM (SELECT unnest(range(256)) AS n)))""",
                      "SELECT count(*) AS total FROM documents",
                      "doc_id, size, text_crc32, 'rows' AS law, NULL::INT AS grown_shard")
