"""Explicit schemas of inputs and logs; nothing is inferred at read time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from isotherm.config import DAILY_VARIABLES

CORRUPT_COLUMN = "_corrupt_record"


def raw_document_schema(variables: Sequence[str] = DAILY_VARIABLES) -> T.StructType:
    """A raw document: one `daily` struct of parallel arrays, plus the parser's reject column."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    return T.StructType(
        [
            T.StructField("daily", T.StructType(arrays)),
            T.StructField(CORRUPT_COLUMN, T.StringType()),
        ]
    )


DIM_CITY = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("admin1", T.StringType()),
        T.StructField("admin2", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("raw_geocoding_file", T.StringType()),
    ]
)

CONFIGURED_CITY = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("country_code", T.StringType()),
    ]
)

_GEOCODING_HIT = [
    T.StructField("name", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("admin1", T.StringType()),
    T.StructField("admin2", T.StringType()),
    T.StructField("population", T.LongType()),
]

# A landed geocoding answer: a `results` list, or the chosen hit written out flat.
GEOCODING_DOCUMENT = T.StructType(
    [T.StructField("results", T.ArrayType(T.StructType(_GEOCODING_HIT)))] + _GEOCODING_HIT
)

RUN_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("flow_name", T.StringType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
        T.StructField("rows_bronze", T.LongType()),
        T.StructField("rows_gold_ml", T.LongType()),
        T.StructField("rows_bronze_delta", T.LongType()),
        T.StructField("rows_gold_ml_delta", T.LongType()),
        T.StructField("bronze_max_date", T.DateType()),
        T.StructField("gold_ml_max_date", T.DateType()),
        T.StructField("freshness_status", T.StringType()),
    ]
)

ML_METRICS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("pipeline_run_id", T.LongType()),
        T.StructField("flow_name", T.StringType()),
        T.StructField("run_mode", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("train_size", T.LongType()),
        T.StructField("test_size", T.LongType()),
        T.StructField("positive_class_ratio", T.DoubleType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("precision_0", T.DoubleType()),
        T.StructField("recall_0", T.DoubleType()),
        T.StructField("f1_0", T.DoubleType()),
        T.StructField("precision_1", T.DoubleType()),
        T.StructField("recall_1", T.DoubleType()),
        T.StructField("f1_1", T.DoubleType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
