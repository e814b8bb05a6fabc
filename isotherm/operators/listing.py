"""The order in which reports and pair tables are listed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published order of each listing; a leading minus is descending. What follows the
# published columns only makes the order unique.
ORDERS = {
    "anomaly_city_correlations": ("-anomaly_correlation", "city_id_1", "city_id_2"),
    "anomaly_city_lags": ("city_name", "other_city_name", "lag_months"),
    "monthly_trend": ("date", "city_name"),
    "ingestion_health": ("city_id",),
    "success_rate": ("-run_date", "run_mode", "flow_name"),
    "ml_daily_summary": ("-run_date", "run_mode"),
}


def listed(frame: DataFrame, name: str) -> DataFrame:
    """The frame in the order of its listing, NULLs last. A global sort, so for what is shown."""
    columns = [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in ORDERS[name]
    ]
    return frame.orderBy(*columns)
