"""Registered queries: every operator over the whole shared tables.

Results are rounded to six decimals for the comparison with the SQL oracle; the operators
themselves return full precision.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.config import FEATURE_COLUMNS
from isotherm.functions.columns import logistic
from isotherm.operators import anomaly as anomalies
from isotherm.operators import auc_trend, clean, comoments, drift, features, health, landing, listing, ml
from isotherm.operators import observe, quality, retract, serve, similar, telecon, windows
from isotherm.operators.positions import running_totals
from isotherm.plans import stations as st
from isotherm.schemas import RUN_LOG
from isotherm.sources import readers, writers, zone
from isotherm.sources.scratch import cleared, new_folder, staged
from isotherm.streaming import keyed
from isotherm.streaming.landing import stream_landed_documents, stream_zone

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SPLIT_DAY, WATERMARK_DAY = date(2000, 1, 1), date(2000, 6, 30)
PLAN_START, PLAN_END = date(1993, 3, 15), date(2002, 2, 10)
AS_OF = date(2001, 8, 4)


def comparable(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, without negative zero."""
    return frame.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in frame.schema
        ]
    )


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(spark, sf_dir))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    REGISTRY[function.__name__] = run
    return run


# ---------------------------------------------------------------------------- landing


@query
def station_daily(spark, sf_dir):
    return st.station_daily(spark, sf_dir)


@query
def dim_city_build(spark, sf_dir):
    answers, configured = st.geocoding_answers(spark, sf_dir)
    return readers.build_dim_city(answers, configured)


@query
def raw_validation(spark, sf_dir):
    checked = landing.validate_raw(st.faulty_documents(spark, sf_dir))
    return checked.select(
        "city_slug",
        "year",
        "n_records",
        F.size("errors").cast("long").alias("n_errors"),
        F.array_join("errors", "; ").alias("errors"),
    )


@query
def flatten_daily(spark, sf_dir):
    """Nested documents with uneven arrays back to days."""
    return landing.flatten_daily(st.faulty_documents(spark, sf_dir).drop("city_id"))


@query
def city_slug_join(spark, sf_dir):
    """Days joined to a dimension that lacks some of their cities."""
    daily = st.station_daily(spark, sf_dir).drop("city_id", "city_name", "country_code")
    known = st.dim_city(spark, sf_dir).where(F.col("city_id") % 6 != 5)
    return landing.attach_city(daily, known)


def _stored_and_new(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Stored days up to the watermark; new days from the split day, each delivered twice."""
    daily = st.station_daily(spark, sf_dir)
    stored = daily.where(F.col("date") <= F.lit(WATERMARK_DAY))
    again = daily.where(F.col("date") >= F.lit(SPLIT_DAY))
    revised = F.col("temperature_2m_max") + 1
    new = again.withColumn(
        "delivery",
        F.explode(F.array(F.lit(1), F.lit(2))),
    ).withColumn(
        "temperature_2m_max", F.when(F.col("delivery") == 2, revised).otherwise(F.col("temperature_2m_max"))
    )
    return stored, new


@query
def incremental_high_watermark(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    return landing.land_incremental(new, stored, mode="high_watermark", order_by="delivery")


@query
def incremental_upsert(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    return landing.land_incremental(new, stored, mode="upsert", order_by="delivery")


@query
def stored_upsert(spark, sf_dir):
    """The upsert against a stored table that is partitioned by year."""
    stored, new = _stored_and_new(spark, sf_dir)
    path = new_folder(spark, "daily")
    writers.load_daily(stored, path)
    loaded = writers.load_daily(new, path, mode="upsert", order_by="delivery")
    return loaded.withColumn("year", F.col("year").cast("long"))


@query
def upsert_months(spark, sf_dir):
    """Months over the stored daily table after an upsert, only the rewritten years computed again."""
    stored, new = _stored_and_new(spark, sf_dir)
    path, months = new_folder(spark, "daily"), new_folder(spark, "monthly")
    writers.load_daily(stored, path)
    first = clean.monthly_climate(clean.clean_daily(spark.read.parquet(path), st.CONFIG))
    writers.write_table(first, months, ["year"])
    years = writers.upsert_daily(new, path, order_by="delivery")
    touched = writers.of_years(spark.read.parquet(path), years)
    clean.monthly_climate(clean.clean_daily(touched, st.CONFIG)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("year").parquet(months)
    return spark.read.parquet(months).withColumn("year", F.col("year").cast("long"))


@query
def landing_zone(spark, sf_dir):
    """Documents to a partitioned landing zone (skip, then replace), back to named days."""
    zone = new_folder(spark, "zone")
    documents = staged(
        st.raw_documents(spark, sf_dir).select("daily", "city_slug", "year"), "documents"
    )
    writers.land_documents(documents.where(F.col("year") <= 1998), zone, "backfill")
    writers.land_documents(documents, zone, "backfill")
    writers.land_documents(documents.where(F.col("year") == 2001), zone, "recent")
    good, _ = landing.split_valid(
        landing.validate_raw(readers.read_landed_documents(spark, zone))
    )
    days = landing.attach_city(landing.flatten_daily(good), st.dim_city(spark, sf_dir))
    return days.drop("modified_at")


@query
def raw_files(spark, sf_dir):
    """One JSON file per document, read back by file name and location."""
    root = new_folder(spark, "raw")
    documents = st.raw_documents(spark, sf_dir).select("daily", "city_slug")
    documents.write.option("maxRecordsPerFile", 1).partitionBy("city_slug").json(root)
    raw = landing.with_city_slug(readers.read_raw_daily(spark, root))
    # the writer puts "city_slug=" in front of the directory names
    named = raw.withColumn("city_slug", F.replace("city_slug", F.lit("city_slug="), F.lit("")))
    good, _ = landing.split_valid(landing.validate_raw(named))
    return landing.flatten_daily(good).drop("modified_at")


@query
def dim_city_csv(spark, sf_dir):
    """The dimension through its CSV form."""
    answers, configured = st.geocoding_answers(spark, sf_dir)
    path = new_folder(spark, "dim_city")
    readers.build_dim_city(answers, configured).write.option("header", True).csv(path)
    return readers.read_dim_city(spark, path)


@query
def stream_landing(spark, sf_dir):
    """The landing zone read as a file stream and upserted in micro-batches."""
    folder = new_folder(spark, "stream")
    documents = st.raw_documents(spark, sf_dir).select("daily", "city_slug", "year")
    writers.land_documents(documents, f"{folder}/zone", "recent")
    run = stream_landed_documents(
        spark,
        f"{folder}/zone",
        st.dim_city(spark, sf_dir),
        f"{folder}/daily",
        f"{folder}/quarantine",
        f"{folder}/checkpoint",
    )
    run.awaitTermination()
    loaded = spark.read.parquet(f"{folder}/daily")
    return loaded.withColumn("year", F.col("year").cast("long"))


@query
def window_plan_backfill(spark, sf_dir):
    """Years without a document that reaches December."""
    landed = (
        st.station_daily(spark, sf_dir)
        .groupBy("city_slug", "year")
        .agg(F.max(F.month("date")).alias("last_month"))
        .where(F.col("last_month") == 12)
    )
    cities = st.dim_city(spark, sf_dir)
    return windows.plan_windows(cities, "backfill", landed, PLAN_START, PLAN_END)


@query
def window_plan_recent(spark, sf_dir):
    """One year-to-date window per customer, as a fleet that grows with the data."""
    fleet = st.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("city_id"), F.col("c_name").alias("city_name")
    )
    return windows.plan_windows(fleet, "recent", as_of=AS_OF)


@query
def window_plan_coverage(spark, sf_dir):
    days = st.station_daily(spark, sf_dir).select("city_slug", "date")
    cities = st.dim_city(spark, sf_dir)
    return windows.plan_windows(cities, "coverage", days, PLAN_START, PLAN_END)


@query
def window_plan_missing(spark, sf_dir):
    """The fewest windows that hold all missing days, short landed stretches included."""
    days = st.station_daily(spark, sf_dir).select("city_slug", "date")
    cities = st.dim_city(spark, sf_dir)
    return windows.missing_windows(cities, days, PLAN_START, PLAN_END, merge_days=3)


@query
def schema_drift(spark, sf_dir):
    """Unknown, retyped and unreadable parts of documents with planted ones."""
    return drift.drift_report(st.drifted_documents(spark, sf_dir))


@query
def rewritten_zone(spark, sf_dir):
    """Files streamed by their time of modification: half years first, then whole years under the same names."""
    folder = new_folder(spark, "rewritten")
    documents = staged(st.raw_documents(spark, sf_dir).select("daily", "city_slug", "year"), "documents")
    place = (f"{folder}/zone", st.dim_city(spark, sf_dir), *[f"{folder}/{x}" for x in ("daily", "quarantine", "checkpoint")])
    early = F.size(F.filter("daily.time", lambda day: F.substring(day, 6, 2) <= "06"))
    first = documents.withColumn(
        "daily", F.struct(*[F.slice(F.col("daily")[c], F.lit(1), early).alias(c) for c in ("time", *st.CONFIG.variables)])
    )
    zone.write_documents(first.where(F.size("daily.time") > 0), place[0])
    stream_zone(spark, *place).awaitTermination()
    zone.write_documents(documents, place[0])
    stream_zone(spark, *place).awaitTermination()
    return spark.read.parquet(place[2]).withColumn("year", F.col("year").cast("long"))


@query
def keyed_stream(spark, sf_dir):
    """Deliveries late, repeated and out of order through keyed state: what is left is the newest of each day."""
    folder = new_folder(spark, "keyed")
    stored, new = _stored_and_new(spark, sf_dir)
    new = staged(new.withColumn("delivery", F.col("delivery").cast("long")), "deliveries")
    first, second = new.where("delivery = 1"), new.where("delivery = 2")
    batches = [
        stored.withColumn("delivery", F.lit(0).cast("long")).unionByName(second.where("month(date) % 2 = 0")),
        first.unionByName(second.where("month(date) = 2")),
        second.unionByName(first.where("month(date) = 3")),
    ]
    for number, batch in enumerate(batches):
        batch.write.mode("append").parquet(f"{folder}/deliveries")
        days = spark.readStream.schema(batch.schema).parquet(f"{folder}/deliveries")
        keyed.append_newest_days(days, f"{folder}/log", f"{folder}/checkpoint", order_by="delivery").awaitTermination()
    return keyed.current_days(spark, f"{folder}/log", order_by="delivery")


@query
def landed_summary(spark, sf_dir):
    return windows.landed_summary(st.load_attempts(spark, sf_dir), "recent")


@query
def failed_cities(spark, sf_dir):
    return windows.failed_cities(st.load_attempts(spark, sf_dir))


# ---------------------------------------------------------------------------- clean, anomaly


@query
def clean_daily(spark, sf_dir):
    return clean.clean_daily(st.station_daily(spark, sf_dir), st.CONFIG)


@query
def monthly_climate(spark, sf_dir):
    return st.station_monthly(spark, sf_dir)


@query
def climatology(spark, sf_dir):
    return anomalies.climatology(st.station_monthly(spark, sf_dir), st.CONFIG)


def _corrected_states(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """States of months and climatology after days of a stored table were corrected, added and withdrawn."""
    right = staged(clean.clean_daily(st.station_daily(spark, sf_dir), st.CONFIG), "right")
    day = F.col("day_of_year")
    wrong = (day + F.col("city_id")) % 9 == 0
    before = right.where(day % 11 != 0).withColumns(
        {
            "tmean_c": F.when(wrong, F.col("tmean_c") + 40).otherwise(F.col("tmean_c")),
            "precip_mm": F.when(~wrong, F.col("precip_mm")),
            "is_heat_day": F.when(wrong, 1 - F.col("is_heat_day")).otherwise(F.col("is_heat_day")),
        }
    )
    strange = right.where(day % 50 == 1).withColumn("city_id", F.col("city_id") + 1000)
    before = before.unionByName(strange)
    months = staged(retract.month_states(before), "months")
    cells = staged(retract.baseline_states(retract.months_of(months), st.CONFIG), "cells")

    goes = before.where(wrong | (F.col("city_id") >= 1000))
    comes = right.where(wrong | (day % 11 == 0))
    change = staged(retract.month_changes(goes, comes), "change")
    new_months = staged(retract.apply_months(months, change), "new_months")
    keys = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in clean.MONTHLY_KEYS]
    old_months = months.alias("s").join(change.alias("c"), keys, "left_semi")
    of_cells = staged(
        retract.baseline_changes(retract.months_of(old_months), retract.months_of(new_months), st.CONFIG), "of_cells"
    )
    new_cells = retract.apply_baseline(cells, of_cells)
    return (
        retract.kept(months, change, clean.MONTHLY_KEYS).unionByName(new_months),
        retract.kept(cells, of_cells, retract.BASELINE_KEYS).unionByName(new_cells),
    )


@query
def retracted_months(spark, sf_dir):
    """Months from states that wrong days were taken out of."""
    return retract.months_of(_corrected_states(spark, sf_dir)[0])


@query
def retracted_climatology(spark, sf_dir):
    """The climatology from states that the months of wrong days were taken out of."""
    return retract.climatology_of(_corrected_states(spark, sf_dir)[1])


@query
def stored_monthly(spark, sf_dir):
    """The monthly table after a full refresh over an older version, published as a view."""
    path = new_folder(spark, "monthly")
    monthly = st.station_monthly(spark, sf_dir)
    writers.write_table(monthly.where(F.col("year") < 1998), path, ["year"])
    writers.write_table(monthly, path, ["year"], ["city_id", "month"])
    stored = readers.read_table(spark, path).withColumn("year", F.col("year").cast("long"))
    return writers.publish_view(stored, "clean_monthly_climate").sparkSession.table(
        "clean_monthly_climate"
    )


@query
def anomaly_month(spark, sf_dir):
    return st.station_anomaly(spark, sf_dir)


@query
def anomaly_events(spark, sf_dir):
    return anomalies.anomaly_events(st.station_anomaly(spark, sf_dir), st.CONFIG)


# ---------------------------------------------------------------------------- correlations


@query
def anomaly_correlations(spark, sf_dir):
    return telecon.pair_correlations(st.station_anomaly(spark, sf_dir), st.CONFIG)


@query
def anomaly_lags(spark, sf_dir):
    return telecon.lag_correlations(st.station_anomaly(spark, sf_dir), st.CONFIG)


@query
def best_lag(spark, sf_dir):
    lags = telecon.lag_correlations(st.station_anomaly(spark, sf_dir), st.CONFIG)
    return telecon.best_lag(lags)


@query
def strongest_links(spark, sf_dir):
    """`best_lag` without the pair table."""
    return telecon.strongest_links(st.station_anomaly(spark, sf_dir), st.CONFIG)


@query
def fleet_monthly(spark, sf_dir):
    return st.fleet_monthly(spark, sf_dir)


@query
def fleet_correlations(spark, sf_dir):
    """All pairs of a fleet in many blocks."""
    return telecon.pair_correlations(st.fleet_anomaly(spark, sf_dir), st.FLEET_CONFIG)


@query
def fleet_links(spark, sf_dir):
    return telecon.strongest_links(st.fleet_anomaly(spark, sf_dir), st.FLEET_CONFIG)


@query
def candidate_lags(spark, sf_dir):
    """Lags of the candidate pairs alone."""
    pairs = staged(st.neighbours(spark, sf_dir), "pairs")
    return telecon.lag_correlations(st.fleet_anomaly(spark, sf_dir), st.FLEET_CONFIG, pairs)


@query
def similar_links(spark, sf_dir):
    """All strong links of the regional fleet, found without looking at all pairs."""
    anomaly = staged(st.regional_anomaly(spark, sf_dir), "anomaly")
    return similar.similar_links(anomaly, st.FLEET_CONFIG)


@query
def strongest_similar(spark, sf_dir):
    anomaly = staged(st.regional_anomaly(spark, sf_dir), "anomaly")
    return similar.strongest_similar(anomaly, st.FLEET_CONFIG)


def _earlier_fleet(anomaly: DataFrame) -> DataFrame:
    """The fleet's anomalies as they stood before months came in, were corrected, withdrawn and sent twice."""
    city, year, month = F.col("city_id"), F.col("year"), F.col("month")
    known = anomaly.where((year < 2001) | (city % 3 == 0))
    wrong = (city % 7 == 0) & (month == 5)
    moved = F.when(wrong, F.col("anomaly_tmean_c") + 0.5).when(city % 11 != 3, F.col("anomaly_tmean_c"))
    known = known.withColumn("anomaly_tmean_c", moved).where((city % 13 != 5) | (month != 2))
    return known.unionByName(anomaly.where((city % 5 == 1) & (year == 1997)))


def _updated_links(spark, sf_dir) -> comoments.StoredLinks:
    stored = comoments.StoredLinks(spark, new_folder(spark, "moments"))
    with cleared(spark):  # the state is all that is read afterwards
        months = st.fleet_anomaly(spark, sf_dir).select("city_id", "city_name", "year", "month", "anomaly_tmean_c")
        anomaly = staged(months, "anomaly")
        stored.update(_earlier_fleet(anomaly), st.FLEET_CONFIG)
        stored.update(anomaly, st.FLEET_CONFIG)
    return stored


@query
def updated_correlations(spark, sf_dir):
    """Correlations of a stored state into which only the changed months went."""
    return _updated_links(spark, sf_dir).correlations()


@query
def updated_links(spark, sf_dir):
    """The strongest lags of the same state after its versions were made one."""
    stored = _updated_links(spark, sf_dir)
    stored.compact()
    return telecon.best_lag(stored.lags(strongest=True))


@query
def links_as_of(spark, sf_dir):
    """Links that no later month has a part in."""
    return telecon.strongest_links(st.fleet_anomaly(spark, sf_dir), st.FLEET_CONFIG, as_of=(1999, 12))


# ---------------------------------------------------------------------------- features, model


@query
def listing_order(spark, sf_dir):
    """The published order of the pair listing, as positions."""
    pairs = telecon.pair_correlations(st.station_anomaly(spark, sf_dir), st.CONFIG)
    rows = pairs.withColumn("anomaly_correlation", F.round("anomaly_correlation", 6))
    shown = staged(listing.listed(rows, "anomaly_city_correlations").withColumn("place", F.monotonically_increasing_id()), "listing")
    counted = running_totals(shown.withColumn("one", F.lit(1).cast("long")), "place", ["one"])
    return counted.select("city_id_1", "city_id_2", (F.col("one_before") + 1).alias("position"))


@query
def rolling_features(spark, sf_dir):
    rolled = features.rolling_features(st.station_anomaly(spark, sf_dir))
    return rolled.select("city_id", "year", "month", "time_index", *features.ROLLING_COLUMNS)


@query
def next_month_label(spark, sf_dir):
    rolled = features.rolling_features(st.station_anomaly(spark, sf_dir))
    return features.next_month_label(rolled).select(
        "city_id", "year", "month", "is_event_next_month"
    )


def _features(spark, sf_dir) -> DataFrame:
    anomaly = staged(st.station_anomaly(spark, sf_dir), "anomaly")
    return features.ml_features(anomaly, telecon.strongest_links(anomaly, st.CONFIG))


@query
def ml_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query
def ordered_split(spark, sf_dir):
    marked = ml.mark_split(_months_as_features(spark, sf_dir), 0.75, "ordered", ["avg_tmean_c"])
    return marked.select("city_id", "year", "month", "position", "is_train")


@query
def time_split(spark, sf_dir):
    marked = ml.mark_split(_months_as_features(spark, sf_dir), 0.75, "time", ["avg_tmean_c"])
    return marked.select("city_id", "year", "month", "is_train")


def _months_as_features(spark, sf_dir) -> DataFrame:
    monthly = st.station_monthly(spark, sf_dir)
    return staged(
        monthly.select(
            "city_id",
            "year",
            "month",
            "avg_tmean_c",
            (F.col("heat_day_count") > 10).cast("int").alias("is_event_next_month"),
        ),
        "months",
    )


@query
def class_weights(spark, sf_dir):
    weighted = ml.with_class_weights(st.scored_events(spark, sf_dir))
    return weighted.select("event_id", "is_event_next_month", "class_weight")


@query
def class_distribution(spark, sf_dir):
    return ml.class_distribution(st.scored_events(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    return ml.classification_report(st.scored_events(spark, sf_dir))


@query
def roc_auc(spark, sf_dir):
    return ml.roc_auc(st.scored_events(spark, sf_dir))


@query
def metrics_record(spark, sf_dir):
    scored = staged(st.scored_events(spark, sf_dir), "scored")
    return ml.metrics_record(scored, scored, st.CONFIG)


@query
def event_probability(spark, sf_dir):
    """Logistic form of a margin, and the event at the threshold of the configuration."""
    probability = logistic((F.col("value") - 25) / 10)
    return st.table(spark, sf_dir, "events").select(
        "event_id",
        probability.alias("prob_event_next_month"),
        (probability >= st.CONFIG.event_probability).cast("int").alias("pred_event_next_month"),
    )


@query
def probability_forms(spark, sf_dir):
    """The event's probability from a vector of probabilities, from a margin as vector or number, and from the label."""
    events = st.table(spark, sf_dir, "events")
    margin = (F.col("value") - 25) / 10
    share = logistic(margin)
    forms = {
        "probability": {"probability": array_to_vector(F.array(1 - share, share)), "rawPrediction": F.lit(0.0)},
        "margin_vector": {"rawPrediction": array_to_vector(F.array(-margin, margin))},
        "margin": {"rawPrediction": margin},
        "label": {"prediction": (F.col("value") >= 25).cast("double")},
    }
    frames = []
    for form, columns in forms.items():
        scored = events.withColumns(columns)
        probability = ml.event_probability(None, scored)
        frames.append(
            scored.select(
                "event_id",
                F.lit(form).alias("form"),
                probability.alias("prob_event_next_month"),
                (probability >= st.CONFIG.event_probability).cast("int").alias("pred_event_next_month"),
            )
        )
    return _union(frames)


@query
def auc_by_day(spark, sf_dir):
    """Days of scores as sketches, months from the days' sketches, and whether both are as near the exact area as they say."""
    events = st.table(spark, sf_dir, "events").select("event_id", F.trunc(F.col("ts").cast("date"), "month").alias("month"), F.col("ts").cast("date").alias("day"))
    scored = staged(st.scored_events(spark, sf_dir).join(events, "event_id"), "scored")
    days = staged(auc_trend.score_sketches(scored, ["month", "day"]), "sketches")
    months = auc_trend.merged_sketches(days, ["month"])

    def judged(trend: DataFrame, period: str) -> DataFrame:
        exact = _exact_auc(scored, period)
        near = F.abs(F.col("roc_auc") - F.col("exact")) <= F.col("error_bound")
        return trend.join(exact, period).select(
            F.lit(period).alias("period"), F.col(period).alias("starts"), "n_positive", "n_negative", near.alias("within_bound")
        )

    return judged(auc_trend.auc_trend(days), "day").unionByName(judged(auc_trend.auc_trend(months), "month"))


def _exact_auc(scored: DataFrame, period: str) -> DataFrame:
    """The exact area for each period; its distinct scores meet in one window, which the sketches are there to avoid."""
    positive = F.col("is_event_next_month").cast("long")
    scores = scored.groupBy(period, "prob_event_next_month").agg(F.sum(positive).alias("p"), F.sum(1 - positive).alias("n"))
    before = Window.partitionBy(period).orderBy("prob_event_next_month").rowsBetween(Window.unboundedPreceding, -1)
    ranked = scores.withColumn("beaten", F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("n") / 2)
    return ranked.groupBy(period).agg((F.sum(F.col("p") * F.col("beaten")) / F.sum("p") / F.sum("n")).alias("exact"))


@query
def metrics_document(spark, sf_dir):
    """The class lines of a metrics document that was written as JSON and read back."""
    scored = staged(st.scored_events(spark, sf_dir), "scored")
    path = new_folder(spark, "metrics")
    writers.write_metrics_document(ml.metrics_document(ml.metrics_record(scored, scored, st.CONFIG), scored), path)
    line = "struct<class: string, precision: double, recall: double, f1: double, support: long>"
    schema = (
        f"model_name string, test_size long, roc_auc double, target_column string, feature_columns array<string>, "
        f"classification_report array<{line}>, class_distribution_test array<struct<class: long, n: long>>"
    )
    document = spark.read.schema(schema).json(path)
    return document.select(
        "model_name",
        "test_size",
        "roc_auc",
        "target_column",
        F.size("feature_columns").cast("long").alias("n_features"),
        F.size("class_distribution_test").cast("long").alias("n_classes"),
        F.inline("classification_report"),
    )


@query
def exported_predictions(spark, sf_dir):
    """Scored rows to a table and to CSV, read back from the CSV."""
    folder = new_folder(spark, "predictions")
    scored = st.scored_events(spark, sf_dir)
    writers.write_predictions(scored, f"{folder}/table", f"{folder}/csv")
    return spark.read.schema(scored.schema).option("header", True).csv(f"{folder}/csv")


@query
def rf_predictions(spark, sf_dir):
    """Train on the first three quarters, score every complete feature row."""
    rows = staged(_features(spark, sf_dir), "features")
    train, _ = ml.ordered_split(rows, st.CONFIG.train_fraction)
    return ml.score(rows, ml.train_forest(train, st.CONFIG), st.CONFIG.event_probability)


@query
def rf_agreement(spark, sf_dir):
    """Keys of the scored rows, whether label and probability agree, and whether the forest ranks better than chance."""
    rows = staged(_features(spark, sf_dir), "features")
    train, _ = ml.ordered_split(rows, st.CONFIG.train_fraction)
    share = st.CONFIG.event_probability
    found = staged(ml.score(train, ml.train_forest(train, st.CONFIG), share, keep=["is_event_next_month"]), "scored")
    area = ml.roc_auc(found).select((F.col("roc_auc") > 0.6).alias("better")).scalar()
    probability, call = F.col(ml.PROBABILITY), F.col(ml.PREDICTION)
    return found.select(
        "city_id",
        "year",
        "month",
        "anomaly_tmean_c",
        ((call == (probability >= share).cast("int")) & probability.between(0, 1)).alias("agrees"),
        area.alias("ranks_better_than_chance"),
    )


@query
def complete_feature_rows(spark, sf_dir):
    """Keys of the rows that a model may see, with planted NULL and NaN features."""
    month = F.col("month")
    rows = _features(spark, sf_dir).withColumns(
        {
            "roll_std_3": F.when(month != 1, F.col("roll_std_3")),
            "delta_1m": F.when(month == 2, float("nan")).otherwise(F.col("delta_1m")),
        }
    )
    return ml.complete_rows(rows, FEATURE_COLUMNS).select("city_id", "year", "month")


@query
def model_round_trip(spark, sf_dir):
    """Rows whose score changes by saving and loading, and rows where label and probability disagree."""
    rows = staged(_features(spark, sf_dir), "features")
    train, _ = ml.ordered_split(rows, st.CONFIG.train_fraction)
    model = ml.train_forest(train, replace(st.CONFIG, n_trees=10))
    path = new_folder(spark, "model")
    writers.save_model(model, path)
    keys, share = ["city_id", "year", "month"], st.CONFIG.event_probability
    probability, call = F.col(ml.PROBABILITY), F.col(ml.PREDICTION)
    fresh = ml.score(rows, model, share).select(*keys, probability.alias("fresh"))
    loaded = ml.score(rows, writers.load_model(path), share)
    return loaded.join(fresh, keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(probability != F.col("fresh")).alias("n_changed"),
        F.count_if(call != (probability >= share).cast("int")).alias("n_disagreeing"),
        F.count_if(~probability.between(0, 1)).alias("n_out_of_range"),
    )


# ---------------------------------------------------------------------------- observability


@query
def run_log_view(spark, sf_dir):
    return observe.run_log_view(st.run_log(spark, sf_dir))


@query
def run_daily_summary(spark, sf_dir):
    return observe.newest_first(observe.run_daily_summary(st.run_log(spark, sf_dir)))


@query
def ml_metrics_view(spark, sf_dir):
    return observe.ml_metrics_view(st.ml_metrics(spark, sf_dir))


@query
def ml_daily_summary(spark, sf_dir):
    return observe.newest_first(observe.ml_daily_summary(st.ml_metrics(spark, sf_dir)))


@query
def stored_log(spark, sf_dir):
    """Three batches appended to an absent log: ids count on across them."""
    path = new_folder(spark, "log")
    log = st.run_log(spark, sf_dir)
    for status in ("success", "failed", None):
        batch = log.where(F.col("status").eqNullSafe(status)).withColumnRenamed("id", "event_id")
        stored = writers.append_log(batch, path, RUN_LOG, order_by="event_id")
    return stored


@query
def run_stats(spark, sf_dir):
    daily = staged(st.station_daily(spark, sf_dir), "daily")
    monthly = clean.monthly_climate(clean.clean_daily(daily, st.CONFIG))
    return observe.run_stats(daily, monthly, st.run_log(spark, sf_dir), AS_OF)


@query
def log_append(spark, sf_dir):
    """Ids of a batch, the whole log once more, that follows the stored log."""
    log = st.run_log(spark, sf_dir)
    numbered = observe.with_next_ids(
        log.withColumn("source_id", F.col("id")).drop("id"), log, order_by="source_id"
    )
    return numbered.select("id", "source_id", "run_mode", "started_at")


@query
def last_success(spark, sf_dir):
    found = observe.last_success(st.run_log(spark, sf_dir))
    return found.select("last_success.rows_bronze", "last_success.rows_gold_ml")


@query
def ingestion_health(spark, sf_dir):
    return health.ingestion_health(st.station_daily(spark, sf_dir), st.dim_city(spark, sf_dir), AS_OF)


@query
def freshness_counts(spark, sf_dir):
    return health.freshness_counts(
        health.ingestion_health(st.station_daily(spark, sf_dir), st.dim_city(spark, sf_dir), AS_OF)
    )


@query
def ingestion_status(spark, sf_dir):
    return health.ingestion_status(
        health.ingestion_health(st.station_daily(spark, sf_dir), st.dim_city(spark, sf_dir), AS_OF)
    )


@query
def recent_ml_summary(spark, sf_dir):
    return health.recent_ml_summary(observe.ml_daily_summary(st.ml_metrics(spark, sf_dir)))


@query
def ml_health(spark, sf_dir):
    metrics = st.ml_metrics(spark, sf_dir)
    report = health.ml_health(observe.ml_daily_summary(metrics), metrics)
    return report.withColumn("failures", F.array_join("failures", "; "))


# ---------------------------------------------------------------------------- dashboards


@query
def monthly_trend(spark, sf_dir):
    return serve.monthly_trend(st.station_monthly(spark, sf_dir))


@query
def metric_trend_of_cities(spark, sf_dir):
    names = ["NATION_3", "NATION_7", "NATION_11"]
    return serve.monthly_trend(st.station_monthly(spark, sf_dir), names, ["total_precip_mm"])


@query
def metric_summary(spark, sf_dir):
    trend = serve.monthly_trend(st.station_monthly(spark, sf_dir), metrics=["avg_tmean_c"])
    return serve.metric_summary(trend, "avg_tmean_c")


@query
def city_names(spark, sf_dir):
    return serve.city_names(st.station_monthly(spark, sf_dir))


@query
def success_rate(spark, sf_dir):
    return serve.success_rate(observe.run_daily_summary(st.run_log(spark, sf_dir)))


@query
def latest_per_mode(spark, sf_dir):
    return serve.latest_per_mode(observe.ml_daily_summary(st.ml_metrics(spark, sf_dir)))


# ---------------------------------------------------------------------------- checks


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _layers(spark, sf_dir) -> dict[str, DataFrame]:
    daily = staged(st.station_daily(spark, sf_dir), "daily")
    cleaned = clean.clean_daily(daily, st.CONFIG)
    monthly = staged(clean.monthly_climate(cleaned), "monthly")
    climate = anomalies.climatology(monthly, st.CONFIG)
    anomaly = staged(anomalies.anomaly_month(monthly, climate, st.CONFIG), "anomaly")
    lags = staged(telecon.lag_correlations(anomaly, st.CONFIG), "lags")
    return {
        "landing_daily_weather": daily,
        "clean_daily_weather_features": cleaned,
        "clean_monthly_climate": monthly,
        "climatology_city_month": climate,
        "anomaly_city_month": anomaly,
        "anomaly_city_events": anomalies.anomaly_events(anomaly, st.CONFIG),
        "anomaly_city_correlations": telecon.pair_correlations(anomaly, st.CONFIG),
        "anomaly_city_lags": lags,
        "ml_features": features.ml_features(anomaly, telecon.best_lag(lags)),
        "pipeline_runs": st.run_log(spark, sf_dir),
    }


@query
def dq_report(spark, sf_dir):
    """All standing checks of all layer tables, one pass per table."""
    layers = _layers(spark, sf_dir)
    return _union([quality.check(f, name, quality.rules_for(name)) for name, f in layers.items()])


@query
def dq_faults(spark, sf_dir):
    """Standing checks over tables with planted faults, so that rules fail."""
    cleaned = clean.clean_daily(st.station_daily(spark, sf_dir), st.CONFIG)
    day = F.col("day_of_year") % 50
    cleaned = cleaned.withColumns(
        {
            "tmax_c": F.when(day == 7, 99.0).when(day != 8, F.col("tmax_c")),
            "tmin_c": F.when(day == 9, -99.0).otherwise(F.col("tmin_c")),
            "precip_mm": F.when(day == 10, -1.0).otherwise(F.col("precip_mm")),
            "city_id": F.when(day != 11, F.col("city_id")),
            "date": F.when(day != 12, F.col("date")),
        }
    )
    monthly = st.station_monthly(spark, sf_dir)
    month = F.col("month")
    monthly = monthly.withColumns(
        {
            "city_name": F.when(month != 3, F.col("city_name")),
            "year": F.when(month != 4, F.col("year")),
            "month": F.when(month == 2, 14).when(month != 5, month),
        }
    )
    events = anomalies.anomaly_events(st.station_anomaly(spark, sf_dir), st.CONFIG)
    flags = ("is_hot_event", "is_cold_event", "is_extreme_event")
    events = events.withColumns(
        {
            "month": F.when(month == 6, 0).otherwise(month),
            "z_score": F.when(month != 7, F.col("z_score")),
            **{f: F.when(month != 8, F.col(f)) for f in flags},
        }
    )
    tables = {
        "clean_daily_weather_features": cleaned,
        "clean_monthly_climate": monthly,
        "anomaly_city_events": events,
    }
    return _union([quality.check(f, name, quality.rules_for(name)) for name, f in tables.items()])


@query
def dq_contracts(spark, sf_dir):
    """Contracts of tables with planted faults: a column gone, one of another kind, one that may be wider."""
    daily = st.station_daily(spark, sf_dir)
    monthly = st.station_monthly(spark, sf_dir)
    anomaly = st.station_anomaly(spark, sf_dir)
    tables = {
        "landing_daily_weather": daily,
        "clean_monthly_climate": monthly.drop("avg_tmax_c").withColumn("month", F.col("month").cast("string")),
        "climatology_city_month": anomalies.climatology(monthly, st.CONFIG).withColumn("month", F.col("month").cast("int")),
        "anomaly_city_month": anomaly.drop("season", "month_name"),
        "anomaly_city_events": anomalies.anomaly_events(anomaly, st.CONFIG),
        "not_declared": daily,
    }
    return quality.contract_report(spark, tables)


@query
def target_values(spark, sf_dir):
    return quality.target_values(st.scored_events(spark, sf_dir))


@query
def dq_unique_keys(spark, sf_dir):
    daily = staged(st.station_daily(spark, sf_dir), "daily")
    monthly = clean.monthly_climate(clean.clean_daily(daily, st.CONFIG))
    return _union(
        [
            quality.check_unique(daily, "landing_daily_weather", ["city_id", "date"]),
            quality.check_unique(monthly, "clean_monthly_climate", ["city_id", "year", "month"]),
            quality.check_unique(st.load_attempts(spark, sf_dir), "load_attempts", ["city_name"]),
        ]
    )
