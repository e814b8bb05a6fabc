"""One key holds a third of all rows: results stay whole and the hot rows collapse early."""

import pytest
from pyspark.sql import functions as F

from isotherm.operators import clean, health, landing, ml, quality, windows

N = 90_000


@pytest.fixture(scope="module")
def daily(spark):
    """A third of all rows are deliveries of one day of city 0."""
    n = F.col("id")
    hot = n % 3 == 0
    frame = spark.range(0, N, 1, 9).select(
        F.when(hot, 0).otherwise(n % 50).cast("long").alias("city_id"),
        F.when(hot, F.lit("2000-01-01")).otherwise(
            F.date_add(F.lit("2000-01-01"), (n % 700).cast("int")).cast("string")
        ).cast("date").alias("date"),
        n.alias("delivery"),
        (n % 97).cast("double").alias("value"),
    )
    named = frame.select(
        "city_id",
        F.concat(F.lit("city "), "city_id").alias("city_name"),
        F.lit("XX").alias("country_code"),
        F.concat(F.lit("city_"), "city_id").alias("city_slug"),
        F.year("date").cast("long").alias("year"),
        "date",
        "delivery",
        *[F.col("value").alias(c) for c in clean.CLEAN_NAMES],
    ).persist()
    yield named
    named.unpersist()


def shuffled_rows(frame):
    """Rows written by the first shuffle of the executed plan."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()

    def walk(node):
        yield node
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        elif "QueryStage" in name:
            yield from walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    written = [
        node.metrics().apply("shuffleRecordsWritten").value()
        for node in walk(plan)
        if node.nodeName() == "Exchange"
    ]
    return max(written)


def test_monthly_sends_months_not_days(daily):
    monthly = clean.monthly_climate(clean.clean_daily(daily))
    assert monthly.agg(F.sum("days_in_month")).first()[0] == N
    hot = monthly.where("city_id = 0 and year = 2000 and month = 1").first()
    assert hot.days_in_month > N // 3
    # at most the city-months of each of the nine scan tasks
    assert shuffled_rows(clean.monthly_climate(clean.clean_daily(daily))) <= 9 * 50 * 24


def test_repeated_deliveries_collapse_before_the_shuffle(daily):
    newest = landing.newest_per_key(daily, order_by="delivery")
    per_key = daily.groupBy("city_id", "date").agg(F.max("delivery").alias("delivery"))
    assert newest.count() == per_key.count()
    assert newest.join(per_key, ["city_id", "date", "delivery"]).count() == per_key.count()
    # all columns of a key come from the same row
    assert newest.where(F.col("temperature_2m_max") != F.col("delivery") % 97).count() == 0
    assert newest.where(F.col("temperature_2m_max") != F.col("precipitation_sum")).count() == 0
    assert shuffled_rows(landing.newest_per_key(daily, order_by="delivery")) <= N - N // 3 + 9


def test_reports_over_the_hot_city(spark, daily):
    dim = spark.createDataFrame([(0, "city 0", "XX")], "city_id long, city_name string, country_code string")
    from datetime import date

    report = health.ingestion_health(daily, dim, date(2001, 12, 1))
    assert report.agg(F.sum("n_days")).first()[0] == N
    assert shuffled_rows(health.ingestion_health(daily, dim, date(2001, 12, 1))) <= 9 * 50
    assert quality.check_unique(daily, "x", ["city_id", "date"]).first().n_rows == N
    days = daily.select("city_slug", "date")
    cities = daily.select("city_id", "city_name").distinct()
    planned = windows.plan_windows(cities, "coverage", days, date(2000, 1, 1), date(2000, 1, 1))
    present = days.where(F.col("date") == date(2000, 1, 1)).distinct().count()
    assert planned.count() == 50 - present


def test_auc_with_one_score_on_a_third_of_the_rows(spark):
    n = F.col("id")
    scored = spark.range(0, 30_000, 1, 6).select(
        (n % 5 == 0).cast("int").alias("label"),
        F.when(n % 3 == 0, 0.5).otherwise((n % 1000) / 1000).alias("score"),
    )
    pandas = scored.toPandas()
    ranks = pandas["score"].rank()
    positive = pandas["label"] == 1
    p, q = positive.sum(), (~positive).sum()
    expected = (ranks[positive].sum() - p * (p + 1) / 2) / (p * q)
    result = ml.roc_auc(scored, "label", "score").first()
    assert result.roc_auc == pytest.approx(expected, abs=1e-12)
    assert (result.n_positive, result.n_negative) == (p, q)
    # only distinct scores travel
    assert shuffled_rows(ml.roc_auc(scored, "label", "score")) <= 6 * 1001
