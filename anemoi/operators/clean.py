"""Impute missing readings and build the clean rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.schema import IMPUTE_WITH, KEY, MEASURES


def fill_row(profile: DataFrame, period: str, impute_with=IMPUTE_WITH) -> DataFrame:
    """Exactly one row: the fallback per measure from the newest profile of
    ``period`` (NULLs when the period has no profile, so values stay NULL).
    Newest by run number where the table has one, then by time."""
    p = profile.where(F.col("period") == F.lit(period))
    cols = [f"{m}_{impute_with[m]}" for m in MEASURES]
    order = [c for c in ("run_seq", "calculation_timestamp") if c in profile.columns]
    w = F.max_by(F.struct(*cols), F.struct(*order))
    return p.agg(w.alias("w")).select(*[F.col(f"w.{c}").alias(f"__fill_{m}")
                                        for m, c in zip(MEASURES, cols)])


def impute(rows: DataFrame, fill: DataFrame) -> DataFrame:
    """``COALESCE(measure, fallback)``. ``fill`` is a global aggregate, so it has
    exactly one row: a broadcast cross join is bounded and reads the profile once."""
    j = rows.crossJoin(F.broadcast(fill))
    return j.select(*[F.coalesce(F.col(c), F.col(f"__fill_{c}")).alias(c) if c in MEASURES
                      else F.col(c) for c in rows.columns])


def clean_rows(raw: DataFrame, anomalies: DataFrame, profile: DataFrame,
               period: str = "full_dataset", impute_with=IMPUTE_WITH) -> DataFrame:
    """Raw readings that are not anomalies (``NOT EXISTS`` -> left anti join),
    NULL measures filled from the latest profile of ``period``."""
    kept = raw.select(*KEY, *MEASURES).join(anomalies.select(*KEY), list(KEY), "left_anti")
    return impute(kept, fill_row(profile, period, impute_with))
