"""Keyed merges over DataFrames (Spark has no unique key).

Readings (fixed-width values, one numeric order column) merge by a single ``groupBy(key)``
with ``max_by``/``min_by`` per column: a hash aggregate, so rows of a hot key combine before
the shuffle. Rows with strings or several order columns would make Spark sort before and
after such an aggregate; they are ranked in a window instead. Where one row per key is
asked for, Spark keeps only the best row of a key per task before the shuffle. NULLs of the
winning row survive either way (a later row with NULL measures does overwrite).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SRC, _RANK = "__src", "__rank"
_FIXED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
          T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def upsert(existing: DataFrame, updates: DataFrame, key: Sequence[str],
           seq: Sequence[str] | None = None, keep_first: Sequence[str] = ()) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE``: per key the latest row wins.

    ``updates`` beat ``existing``; inside ``updates`` the largest ``seq`` wins
    (e.g. ``(file_name, row_no)``: later file order, later row). Columns in
    ``keep_first`` keep the value of the first row ever written for the key
    (the insertion date of raw readings); all other columns come from the
    winner (so an ``insertion_date`` not listed there is refreshed).
    """
    key = list(key)
    seq = list(seq or ())
    cols = [c for c in existing.columns if c not in key]
    keep = [c for c in cols if c in keep_first]
    take = [c for c in cols if c not in keep]
    if (all(isinstance(updates.schema[c].dataType, _FIXED) for c in cols)
            and len(seq) <= 1 and all(isinstance(updates.schema[c].dataType, _INTEGRAL) for c in seq)):
        first = F.lit(-(1 << 63)).cast("long")          # existing rows come before any update
        both = existing.select(*key, *cols, first.alias(_SRC)).unionByName(updates.select(
            *key, *cols, (F.col(seq[0]).cast("long") if seq else F.lit(0).cast("long")).alias(_SRC)))
        return both.groupBy(*key).agg(*[(F.max_by if c in take else F.min_by)(F.col(c), F.col(_SRC)).alias(c)
                                        for c in cols])
    ex = existing.select(*key, *cols, F.lit(0).alias(_SRC), *[F.lit(None).cast(updates.schema[c].dataType).alias(c + "__seq") for c in seq])
    up = updates.select(*key, *cols, F.lit(1).alias(_SRC), *[F.col(c).alias(c + "__seq") for c in seq])
    both = ex.unionByName(up)
    latest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in (_SRC, *[c + "__seq" for c in seq])])
    every = latest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = both.withColumns({c: F.last(c).over(every) for c in keep})
    return both.withColumn(_RANK, F.row_number().over(latest)).where(F.col(_RANK) == 1).select(*key, *cols)


def first_per_key(df: DataFrame, key: Sequence[str], seq: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest ``seq`` (all other columns when ``seq`` is None)."""
    order = seq or [c for c in df.columns if c not in key]
    first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(_RANK, F.row_number().over(first)).where(F.col(_RANK) == 1).drop(_RANK)


def insert_ignore(existing: DataFrame, new: DataFrame, key: Sequence[str],
                  seq: Sequence[str] | None = None, assume_unique: bool = False) -> DataFrame:
    """``INSERT IGNORE``: rows of ``new`` to append. First write wins, both
    against ``existing`` and inside ``new`` (smallest ``seq``). With
    ``assume_unique`` (``new`` is already keyed, e.g. read from a keyed table)
    the per-key pass and its shuffle are skipped."""
    first = new if assume_unique else first_per_key(new, key, seq)
    return first.join(existing.select(*key), list(key), "left_anti")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """``ORDER BY order DESC LIMIT 1`` per key, for all keys at once."""
    key = list(key)
    cols = list(cols or [c for c in df.columns if c not in key])
    latest = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return (df.select(*dict.fromkeys([*key, *cols, *order])).withColumn(_RANK, F.row_number().over(latest))
            .where(F.col(_RANK) == 1).select(*key, *cols))
