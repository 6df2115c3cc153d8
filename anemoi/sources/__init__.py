from anemoi.sources.archive import archive_files  # noqa: F401
from anemoi.sources.csv_feed import parse_readings, scan_feed, split_valid, with_row_numbers  # noqa: F401
from anemoi.sources.feed_state import feed_state, latest_offsets, number_rows, tail_rows  # noqa: F401
