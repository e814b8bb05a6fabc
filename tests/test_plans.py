"""What the plans must look like for large tables."""

import re

from isotherm.operators import anomaly, clean
from isotherm.plans import stations as st

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(st.station_monthly(spark, SF_DIR).select("city_id", "year", "month", "total_precip_mm"))
    orders = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*orders\.parquet", plan).group(1)
    assert "o_totalprice" not in orders and "o_orderdate" in orders


def test_baseline_years_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "monthly")
    st.station_monthly(spark, SF_DIR).write.partitionBy("year").parquet(path)
    plan = plan_of(anomaly.climatology(spark.read.parquet(path), st.CONFIG))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "1996" in filters and "1999" in filters


def test_daily_rows_shrink_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "daily")
    st.station_daily(spark, SF_DIR).write.parquet(path)
    plan = plan_of(clean.monthly_climate(clean.clean_daily(spark.read.parquet(path))))
    assert plan.count("Exchange") == 1
    assert plan.index("partial_avg") > plan.index("Exchange")


def test_large_sides_are_not_broadcast(spark, tmp_path):
    """Without a size that fits the threshold the joins fall back to a shuffle."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(st.station_anomaly(spark, SF_DIR))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
