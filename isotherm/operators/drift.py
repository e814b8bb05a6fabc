"""What raw documents hold that their schema does not know: variables, types and paths, by city."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import DAILY_VARIABLES

# Kinds of a variant's schema: lists of numbers, of texts, or nothing but nulls.
_NUMBERS = r"^ARRAY<(BIGINT|DOUBLE|FLOAT|VOID|DECIMAL\(\d+,\d+\))>$"
_TEXTS = r"^ARRAY<(STRING|VOID)>$"


def as_variants(documents: DataFrame) -> DataFrame:
    """`document` (text) as a variant, NULL where it is no JSON; other columns stay."""
    return documents.withColumn("document", F.try_parse_json("document"))


def document_paths(variants: DataFrame) -> DataFrame:
    """One row for each field of a document and of its `daily` object: city_slug, year, path, found_type.

    The fields are those that occur, whatever they are called. A document that is no JSON object has
    one row with path `$`.
    """
    spark = variants.sparkSession
    rows = variants.select("city_slug", "year", "document")
    fields = rows.lateralJoin(spark.tvf.variant_explode(F.col("document").outer())).where("key IS NOT NULL")
    top = fields.select(
        "city_slug", "year", F.concat(F.lit("$."), "key").alias("path"), F.schema_of_variant("value").alias("found_type")
    )
    daily = fields.where("key = 'daily'").select("city_slug", "year", F.col("value").alias("daily"))
    inner = daily.lateralJoin(spark.tvf.variant_explode(F.col("daily").outer())).where("key IS NOT NULL")
    below = inner.select(
        "city_slug", "year", F.concat(F.lit("$.daily."), "key").alias("path"), F.schema_of_variant("value").alias("found_type")
    )
    kind = F.coalesce(F.schema_of_variant("document"), F.lit("unreadable"))
    odd = rows.select("city_slug", "year", F.lit("$").alias("path"), kind.alias("found_type"))
    odd = odd.where(~F.col("found_type").startswith("OBJECT"))
    return top.unionByName(below).unionByName(odd)


def drift_report(documents: DataFrame, variables: Sequence[str] = DAILY_VARIABLES) -> DataFrame:
    """city_slug, path, finding and n_documents of all fields that are unknown or of another type.

    `documents` has city_slug, year and document (text). Types are compared by kind: a list of
    numbers, whole or not, is one kind, and a list of nulls fits any. Findings are `unknown`, `retyped`
    and `unreadable`; one aggregate with map-side combine.
    """
    path, kind = F.col("path"), F.col("found_type")
    known = (
        F.when(path == "$.daily", kind.startswith("OBJECT"))
        .when(path == "$.daily.time", kind.rlike(_TEXTS))
        .when(path.isin([f"$.daily.{v}" for v in variables]), kind.rlike(_NUMBERS))
    )
    finding = (
        F.when(path == "$", F.lit("unreadable")).when(known.isNull(), F.lit("unknown")).when(~known, F.lit("retyped"))
    )
    rows = document_paths(as_variants(documents)).withColumn("finding", finding).where("finding IS NOT NULL")
    return rows.groupBy("city_slug", "path", "finding").agg(F.count(F.lit(1)).alias("n_documents"))
