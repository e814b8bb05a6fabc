"""Station-shaped inputs derived from the shared tables.

There is no weather in the shared tables, so orders stand in for observations, nations for
cities and events for runs. The divisors are primes in disguise (9999991, 19999999, 999983 over
1000): no derived value then ends exactly half-way at the sixth decimal, where two engines may
round differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.functions.columns import month_index, slugify
from isotherm.operators.anomaly import anomaly_month, climatology
from isotherm.operators.clean import clean_daily, monthly_climate
from isotherm.sources.scratch import staged

TEMPERATURE_SCALE = 9999.991
DEW_SCALE = 19999.999
ACCOUNT_SCALE = 999.983
RAIN_PER_ORDER = 2.5

# The shared orders run from 1995 to 2001.
CONFIG = ClimateConfig(baseline_first_year=1996, baseline_last_year=1999)

# Small blocks, so that the fleet of a small table too is many pairs of blocks.
FLEET_CONFIG = ClimateConfig(baseline_first_year=1996, baseline_last_year=1999, block_size=32)


# Columns the queries use; a given schema saves the footer job of every scan.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def dim_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("country_code"),
    )


def station_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observations per city in the shape of the landed table.

    Orders are reduced to (city, day) right after the one join that needs every order; the city
    names are joined to the reduced rows.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price, balance = F.col("o_totalprice"), F.col("c_acctbal")
    observed = (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .groupBy(
            F.col("c_nationkey").cast("long").alias("city_id"),
            F.col("o_orderdate").cast("date").alias("date"),
        )
        .agg(
            (F.max(price) / TEMPERATURE_SCALE).alias("temperature_2m_max"),
            (F.min(price) / TEMPERATURE_SCALE).alias("temperature_2m_min"),
            (F.avg(price) / TEMPERATURE_SCALE).alias("temperature_2m_mean"),
            (F.avg(price) / DEW_SCALE).alias("dew_point_2m_mean"),
            (F.count(F.lit(1)) * RAIN_PER_ORDER).alias("precipitation_sum"),
            (F.max(balance) / ACCOUNT_SCALE).alias("wind_speed_10m_max"),
            (F.avg(balance) / ACCOUNT_SCALE).alias("shortwave_radiation_sum"),
        )
    )
    return observed.join(dim_city(spark, sf_dir), "city_id").select(
        "city_id",
        "city_name",
        "country_code",
        slugify(F.col("city_name")).alias("city_slug"),
        F.year("date").cast("long").alias("year"),
        "date",
        *CONFIG.variables,
    )


def station_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_climate(clean_daily(station_daily(spark, sf_dir), CONFIG))


def station_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies over a stored monthly table, which climatology and anomalies both read."""
    monthly = staged(station_monthly(spark, sf_dir), "monthly")
    return anomaly_month(monthly, climatology(monthly, CONFIG), CONFIG)


def fleet_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of a fleet that grows with the data: suppliers as cities, line items as observations."""
    items, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    price = F.col("l_extendedprice")
    shipped = F.col("l_shipdate")
    months = items.groupBy(
        F.col("l_suppkey").alias("city_id"),
        F.year(shipped).cast("long").alias("year"),
        F.month(shipped).cast("long").alias("month"),
    ).agg(
        (F.avg(price) / TEMPERATURE_SCALE).alias("avg_tmean_c"),
        (F.max(price) / TEMPERATURE_SCALE).alias("avg_tmax_c"),
        (F.min(price) / TEMPERATURE_SCALE).alias("avg_tmin_c"),
        (F.sum("l_quantity") / ACCOUNT_SCALE).alias("total_precip_mm"),
    )
    names = supplier.select(
        F.col("s_suppkey").alias("city_id"),
        F.col("s_name").alias("city_name"),
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("country_code"),
    )
    return months.join(names, "city_id").select("city_id", "city_name", "country_code", *months.columns[1:])


def fleet_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = staged(fleet_monthly(spark, sf_dir), "fleet")
    return anomaly_month(monthly, climatology(monthly, CONFIG), CONFIG)


def regional_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet with a climate of five regions: a station follows its region's mean, some months late.

    A little of its own mean is left, so stations of one region correlate strongly, at a lag that
    depends on the two.
    """
    own = fleet_monthly(spark, sf_dir).withColumn("t", month_index(F.col("year"), F.col("month")))
    region = own.groupBy((F.col("city_id") % 5).alias("region"), F.col("t").alias("at")).agg(
        F.avg("avg_tmean_c").alias("regional")
    )
    late = (F.col("t") - F.expr("city_id div 5 % 4")) == F.col("at")
    met = own.join(region, (F.col("city_id") % 5 == F.col("region")) & late)
    blended = 0.98 * F.col("regional") + 0.02 * F.col("avg_tmean_c")
    return met.withColumn("avg_tmean_c", blended).drop("region", "at", "regional", "t")


def regional_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = staged(regional_monthly(spark, sf_dir), "regional")
    return anomaly_month(monthly, climatology(monthly, CONFIG), CONFIG)


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs of the fleet: each supplier with the next two of its fifth of the nations."""
    supplier = table(spark, sf_dir, "supplier")
    by = Window.partitionBy(F.col("s_nationkey") % 5).orderBy("s_suppkey")
    ahead = F.array(*[F.lead("s_suppkey", k).over(by) for k in (1, 2)])
    found = supplier.withColumn("ahead", ahead).select(
        F.col("s_suppkey").alias("city_id"), F.explode("ahead").alias("other_city_id")
    )
    return found.where("other_city_id IS NOT NULL")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per (city_slug, year); a document holds at most one year of days."""
    day = F.struct("date", *CONFIG.variables)
    documents = (
        station_daily(spark, sf_dir)
        .groupBy("city_id", "city_slug", "year")
        .agg(F.sort_array(F.collect_list(day)).alias("days"))
    )
    arrays = [F.col("days.date").cast("array<string>").alias("time")]
    arrays += [F.col("days").getField(v).alias(v) for v in CONFIG.variables]
    return documents.select(
        "city_id", "city_slug", "year", F.struct(*arrays).alias("daily")
    )


def faulty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with a defect that depends on the city and the year."""
    city, year, daily = F.col("city_id"), F.col("year"), F.col("daily")
    wind = F.col("daily.wind_speed_10m_max")
    broken = (
        F.when(city % 7 == 6, F.lit(None))
        .when(city % 5 == 1, daily.withField("precipitation_sum", F.lit(None)))
        .when(
            city % 5 == 2,
            daily.withField("wind_speed_10m_max", F.slice(wind, F.lit(2), F.size(wind))),
        )
        .when((city % 5 == 3) & (year % 2 == 0), daily.withField("time", F.slice("daily.time", 1, 0)))
        .otherwise(daily)
    )
    return raw_documents(spark, sf_dir).withColumn("daily", broken)


def drifted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text with parts that their schema does not know, by city and year."""
    city, year, daily = F.col("city_id"), F.col("year"), F.col("daily")
    as_text = lambda v: F.transform(F.col(f"daily.{v}"), lambda x: F.concat(x.cast("string"), F.lit(" mm")))
    plain = F.to_json(F.struct("daily"))
    snowy = F.to_json(F.struct(daily.withField("snow_depth", F.col("daily.precipitation_sum")).alias("daily")))
    dry = F.to_json(F.struct(daily.dropFields("precipitation_sum").alias("daily")))
    retyped = F.to_json(F.struct(daily.withField("precipitation_sum", as_text("precipitation_sum")).alias("daily")))
    units = F.to_json(F.struct(daily.alias("daily"), F.struct(F.lit("mm").alias("precipitation_sum")).alias("daily_units")))
    text = (
        F.when((city % 7 == 3) & (year % 2 == 0), retyped)
        .when(city % 7 == 4, units)
        .when((city % 7 == 5) & (year % 3 == 0), F.substring(plain, 1, 40))
        .when((city % 7 == 6) & (year % 3 == 1), F.lit("[1, 2]"))
        .when(city % 5 == 1, snowy)
        .when(city % 5 == 2, dry)
        .otherwise(plain)
    )
    return raw_documents(spark, sf_dir).select("city_slug", "year", text.alias("document"))


def geocoding_answers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(answers, configured cities) with one city per supplier and two hits per answer.

    Some answers are empty, and some best hits lack a name or a country.
    """
    supplier = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")

    def hit(rank: int):
        return F.struct(
            F.when(key % 4 != 0, F.concat(F.col("s_name"), F.lit(f" {rank}"))).alias("name"),
            F.when(key % 3 != 0, F.lit("XX")).alias("country_code"),
            (F.col("s_acctbal") / 100 + rank).alias("latitude"),
            (F.col("s_acctbal") / 50 + rank).alias("longitude"),
            F.lit("UTC").alias("timezone"),
            F.lit(None).cast("string").alias("admin1"),
            F.lit(None).cast("string").alias("admin2"),
            (key * 1000 + rank).alias("population"),
        )

    answers = supplier.select(
        key.alias("city_id"),
        F.when(key % 10 != 9, F.array(hit(1), hit(2))).alias("results"),
        *[F.lit(None).cast(t).alias(c) for c, t in
          {"name": "string", "country_code": "string", "latitude": "double",
           "longitude": "double", "timezone": "string", "admin1": "string",
           "admin2": "string", "population": "long"}.items()],
        F.concat(F.lit("geocoding/"), key, F.lit(".json")).alias("raw_geocoding_file"),
    )
    configured = supplier.select(
        key.alias("city_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("country_code"),
    )
    return answers, configured


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as runs; every 97th has no status."""
    value, user = F.col("value"), F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("flow_"), user % 2).alias("flow_name"),
        F.col("event_type").alias("run_mode"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None))
        .when(F.col("event_type") == "error", F.lit("failed"))
        .otherwise(F.lit("success"))
        .alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(mins=(user % 60).cast("int"))).alias("finished_at"),
        F.floor(value * 10).alias("rows_bronze"),
        user.alias("rows_gold_ml"),
        F.floor(value).alias("rows_bronze_delta"),
        (user % 7).alias("rows_gold_ml_delta"),
        F.col("ts").cast("date").alias("bronze_max_date"),
        F.trunc(F.col("ts").cast("date"), "month").alias("gold_ml_max_date"),
        F.when(user % 3 == 0, "fresh").when(user % 3 == 1, "stale").otherwise("very_stale")
        .alias("freshness_status"),
    )


def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as training runs; every tenth user has no AUC."""
    value, user = F.col("value"), F.col("user_id")
    share = value / (value + 10)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_id").alias("pipeline_run_id"),
        F.concat(F.lit("flow_"), user % 2).alias("flow_name"),
        F.col("event_type").alias("run_mode"),
        F.lit(CONFIG.model_name).alias("model_name"),
        F.lit(CONFIG.model_version).alias("model_version"),
        F.floor(value * 100).alias("train_size"),
        user.alias("test_size"),
        (F.lit(1.0) / (value + 20)).alias("positive_class_ratio"),
        share.alias("accuracy"),
        F.when(user % 10 != 0, value / (value + 15)).alias("roc_auc"),
        (value / (value + 11)).alias("precision_0"),
        (value / (value + 12)).alias("recall_0"),
        (value / (value + 13)).alias("f1_0"),
        (value / (value + 31)).alias("precision_1"),
        (value / (value + 32)).alias("recall_1"),
        (value / (value + 33)).alias("f1_1"),
        F.col("ts").alias("created_at"),
    )


def scored_events(spark: SparkSession, sf_dir: str, threshold: float = 25.0) -> DataFrame:
    """Events as a scored test set with a score that has ties."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 10 == 0).cast("int").alias("is_event_next_month"),
        (value >= threshold).cast("int").alias("pred_event_next_month"),
        value.alias("prob_event_next_month"),
    )


def load_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as load attempts of cities."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("CITY_"), F.col("user_id")).alias("city_name"),
        (F.col("event_type") != "error").alias("succeeded"),
    )
