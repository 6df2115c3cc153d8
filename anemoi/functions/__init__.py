from anemoi.functions.expressions import (  # noqa: F401
    day_of, missing_as_null, parse_timestamp, ts_literal,
)
