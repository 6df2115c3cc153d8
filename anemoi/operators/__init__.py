from anemoi.operators.anomalies import (  # noqa: F401
    anomaly_counts_long, anomaly_pivot, distinct_ids, flag_outliers, outlier_predicate, pivot_cells,
)
from anemoi.operators.baseline import band, bounds, high_water_mark  # noqa: F401
from anemoi.operators.clean import clean_rows, fill_row, impute  # noqa: F401
from anemoi.operators.keyed import first_per_key, insert_ignore, latest_per_key, upsert  # noqa: F401
from anemoi.operators.order_stats import kth_smallest  # noqa: F401
from anemoi.operators.profile import eligible_rows, period_profile, period_starts  # noqa: F401
from anemoi.operators.rollup import daily_summary  # noqa: F401
