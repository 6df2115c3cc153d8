"""Column expressions (all built-ins, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemoi.schema import DAY, TS


def missing_as_null(c: Column | str, zero_is_missing: bool = True) -> Column:
    """NaN -> NULL and, by default, 0 -> NULL (a falsy reading counts as missing)."""
    c = F.col(c) if isinstance(c, str) else c
    d = c.cast("double")
    v = F.nanvl(d, F.lit(None).cast("double"))
    return F.nullif(v, F.lit(0.0)) if zero_is_missing else v


def parse_timestamp(c: Column | str, day_first: bool = False) -> Column:
    """Zone-free text -> TIMESTAMP_NTZ; NULL when no layout matches.

    ISO layouts (``yyyy-MM-dd[ T]HH:mm:ss[.f]``, date only) come first, then the
    slash layout ``MM/dd/yyyy[ HH:mm[:ss]]`` (``dd/MM/yyyy`` when ``day_first``).
    """
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), c.try_cast("timestamp_ntz"))
    rx = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d+)?))?)?$"
    a = F.regexp_extract(c, rx, 1)
    b = F.regexp_extract(c, rx, 2)
    month, dom = (b, a) if day_first else (a, b)
    hh = F.regexp_extract(c, rx, 4)
    mm = F.regexp_extract(c, rx, 5)
    ss = F.regexp_extract(c, rx, 6)
    slash = F.when(
        c.rlike(rx),
        F.try_make_timestamp_ntz(
            F.regexp_extract(c, rx, 3).cast("int"), month.cast("int"), dom.cast("int"),
            F.when(hh == "", 0).otherwise(hh.cast("int")),
            F.when(mm == "", 0).otherwise(mm.cast("int")),
            F.when(ss == "", 0).otherwise(ss.cast("decimal(16,6)")),
        ),
    )
    return F.coalesce(iso, slash)


def ts_literal(v: datetime | date | str) -> Column:
    """A TIMESTAMP_NTZ literal (run time, cutoffs) without session-zone effects."""
    if isinstance(v, (datetime, date)):
        v = v.isoformat(sep=" ") if isinstance(v, datetime) else v.isoformat()
    return F.lit(v).cast("timestamp_ntz")


def day_of(ts: Column | str = TS) -> Column:
    """``DATE(timestamp)``: the partition column of every readings table."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts).alias(DAY)
