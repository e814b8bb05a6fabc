"""Split, training, evaluation and scoring of the next-month event model."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.config import FEATURE_COLUMNS, TARGET_COLUMN, ClimateConfig
from isotherm.functions.columns import logistic, month_index, ratio
from isotherm.operators.positions import running_totals
from isotherm.sources.scratch import briefly_staged, staged

FEATURES, WEIGHT = "features", "class_weight"
PROBABILITY, PREDICTION = "prob_event_next_month", "pred_event_next_month"
LAST_ID = 2**63 - 1
ID_COLUMNS = ("city_id", "city_name", "country_code", "year", "month")


def complete_rows(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in `columns`; a column that is not there is a KeyError."""
    require_columns(frame, columns)
    return frame.na.drop(subset=list(columns))


def require_columns(frame: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise KeyError(f"features without {', '.join(missing)}: build the feature table first")


def mark_split(
    features: DataFrame,
    fraction: float,
    mode: Literal["ordered", "time"] = "ordered",
    columns: Sequence[str] = FEATURE_COLUMNS,
) -> DataFrame:
    """Complete rows with `is_train`; the first `fraction` of the order is the training side.

    `ordered` orders by city, then time, and cuts at an exact row: the position of a row is its
    number within the city (months, so bounded) plus the rows of all smaller city ids.
    `time` orders by month over all cities and cuts between two months.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError(f"fraction {fraction} leaves a side empty: it must lie inside (0, 1)")
    if mode not in ("ordered", "time"):
        raise ValueError(f"unknown split mode: {mode}")
    require_columns(features, [*columns, TARGET_COLUMN])
    rows = complete_rows(features, columns).withColumn(
        "time_index", month_index(F.col("year"), F.col("month"))
    )
    cutoff = rows.select(F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("cutoff")).scalar()
    if mode == "time":
        per_month = rows.groupBy("time_index").agg(F.count(F.lit(1)).alias("n"))
        # one row per calendar month
        ahead = running_totals(per_month, "time_index", ["n"])
        marked = ahead.select(
            "time_index", (F.col("n_before") + F.col("n") <= cutoff).alias("is_train")
        )
        return rows.join(marked, "time_index")
    # rows without a city come last
    rows = rows.withColumn("_city", F.coalesce("city_id", F.lit(LAST_ID)))
    per_city = rows.groupBy("_city").agg(F.count(F.lit(1)).alias("n"))
    ahead = running_totals(per_city, "_city", ["n"]).select("_city", "n_before")
    in_city = Window.partitionBy("_city").orderBy("time_index")
    return (
        rows.join(ahead, "_city")
        .withColumn("position", F.col("n_before") + F.row_number().over(in_city))
        .drop("n_before", "_city")
        .withColumn("is_train", F.col("position") <= cutoff)
    )


def ordered_split(
    features: DataFrame,
    fraction: float = 0.75,
    mode: Literal["ordered", "time"] = "ordered",
    columns: Sequence[str] = FEATURE_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    """Disjoint (train, test); an empty side is a ValueError. The marked rows are stored once."""
    return sides(staged(mark_split(features, fraction, mode, columns), "split"))


def sides(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of marked rows, best a stored table; an empty side is a ValueError."""
    train, test = marked.where("is_train"), marked.where("not is_train")
    for name, side in (("training", train), ("test", test)):
        if side.isEmpty():
            raise ValueError(f"empty {name} side: choose another fraction or add months")
    return train, test


def with_class_weights(train: DataFrame, target: str = TARGET_COLUMN) -> DataFrame:
    """Balanced weights n / (classes present * n of the class) for a 0/1 target.

    The two counts come from a one-row subquery, so the training rows are not shuffled on a key
    that has only two values.
    """
    counts = train.select(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("positive")
        ).alias("counts")
    ).scalar()
    n, positive = counts["n"], counts["positive"]
    negative = n - positive
    classes = (positive > 0).cast("int") + (negative > 0).cast("int")
    own = F.when(F.col(target) == 1, positive).otherwise(negative)
    return train.withColumn(WEIGHT, n.cast("double") / (classes * own))


def assemble(frame: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(frame)


def train_forest(
    train: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    columns: Sequence[str] = FEATURE_COLUMNS,
) -> PipelineModel:
    """Fit the class-balanced forest; the stored model holds assembler and forest.

    The weighted rows are stored first: fitting reads them several times (label range, split
    candidates, bagging), and a stored table is cut into partitions by its size, however many
    shuffle partitions made it.
    """
    assembler = VectorAssembler(inputCols=list(columns), outputCol=FEATURES)
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=TARGET_COLUMN,
        weightCol=WEIGHT,
        numTrees=config.n_trees,
        maxDepth=config.max_depth,
        featureSubsetStrategy="sqrt",
        seed=config.seed,
    )
    weighted = with_class_weights(train.select(*columns, TARGET_COLUMN))
    with briefly_staged(weighted, "training_rows") as rows:
        model = forest.fit(assembler.transform(rows))
    return PipelineModel([assembler, model])


def event_probability(model: PipelineModel, scored: DataFrame) -> Column:
    """Probability of class 1: the model's own, else the logistic of its margin, else its label.

    A model that has seen class 0 alone has no entry for class 1, whose probability is then 0.
    """
    if "probability" in scored.columns:
        return F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))
    if "rawPrediction" in scored.columns:
        raw = F.col("rawPrediction")
        if scored.schema["rawPrediction"].dataType.typeName() == "double":
            return logistic(raw)
        return logistic(vector_to_array(raw)[1])
    return F.col("prediction").cast("double")


def score(
    features: DataFrame,
    model: PipelineModel,
    threshold: float = 0.5,
    columns: Sequence[str] = FEATURE_COLUMNS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Predictions for all complete rows: ids present, anomaly, 0/1 event, probability."""
    scored = model.transform(complete_rows(features, columns))
    ids = [c for c in ID_COLUMNS if c in features.columns]
    probability = event_probability(model, scored)
    return scored.withColumn(PROBABILITY, probability).select(
        *ids,
        *keep,
        "anomaly_tmean_c",
        (F.col(PROBABILITY) >= threshold).cast("int").alias(PREDICTION),
        PROBABILITY,
    )


def classification_report(
    scored: DataFrame, label: str = TARGET_COLUMN, prediction: str = PREDICTION
) -> DataFrame:
    """Per-class precision, recall, F1 and support, with accuracy, macro and weighted averages.

    One pass reduces the rows to at most one cell per (label, prediction); everything after it
    works on that handful. Undefined ratios are 0.
    """
    actual, predicted = F.col(label).cast("long"), F.col(prediction).cast("long")
    cells = scored.groupBy(actual.alias("actual"), predicted.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    none = F.lit(0).cast("long")

    def side(cls: Column, support: Column, called: Column) -> Column:
        return F.struct(cls.alias("class"), support.alias("support"), called.alias("called"))

    # each cell counts towards its actual class and towards the class it was called
    sides = F.inline(
        F.array(side(F.col("actual"), F.col("n"), none), side(F.col("predicted"), none, F.col("n")))
    )
    hit = (F.col("actual") == F.col("predicted")).alias("same")
    per_class = (
        cells.select(hit, F.col("n"), sides)
        .groupBy("class")
        .agg(
            F.sum("support").alias("support"),
            F.sum("called").alias("called"),
            F.sum(F.when(F.col("same"), F.col("support")).otherwise(0)).alias("hits"),
        )
        .withColumns(
            {
                "precision": _or_zero(ratio(F.col("hits"), F.col("called"))),
                "recall": _or_zero(ratio(F.col("hits"), F.col("support"))),
            }
        )
        .withColumn(
            "f1",
            _or_zero(
                F.try_divide(
                    2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
                )
            ),
        )
    )
    scores = ("precision", "recall", "f1")
    support = F.sum("support")
    accuracy = ratio(F.sum("hits"), support)

    def line(name: str, values: list[Column]) -> Column:
        named = [_or_zero(v).alias(s) for v, s in zip(values, scores)]
        return F.struct(F.lit(name).alias("class"), *named, support.alias("support"))

    summary = per_class.agg(
        F.array(
            line("accuracy", [accuracy] * 3),
            line("macro avg", [F.avg(s) for s in scores]),
            line(
                "weighted avg",
                [F.try_divide(F.sum(F.col(s) * F.col("support")), support) for s in scores],
            ),
        ).alias("lines")
    ).select(F.inline("lines"))
    classes = per_class.select(F.col("class").cast("string").alias("class"), *scores, "support")
    return classes.unionByName(summary)


def _or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0.0))


def roc_auc(scored: DataFrame, label: str = TARGET_COLUMN, score: str = PROBABILITY) -> DataFrame:
    """Exact ROC-AUC in one row: the share of (positive, negative) pairs ranked right.

    Rows collapse to their distinct scores first; ties count half. NULL unless both classes
    are present.
    """
    positive = F.col(label).cast("long")
    per_score = (
        scored.where(F.col(score).isNotNull() & positive.isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.sum(positive).alias("positives"), F.sum(1 - positive).alias("negatives"))
    )
    ranked = running_totals(per_score, "score", ["negatives"])
    beaten = F.col("negatives_before") + F.col("negatives") / F.lit(2.0)
    return ranked.agg(
        F.try_divide(
            F.sum(F.col("positives") * beaten),
            F.sum("positives").cast("double") * F.sum("negatives").cast("double"),
        ).alias("roc_auc"),
        F.coalesce(F.sum("positives"), F.lit(0)).alias("n_positive"),
        F.coalesce(F.sum("negatives"), F.lit(0)).alias("n_negative"),
    )


def class_distribution(frame: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Rows per class, with the share of each class."""
    counts = frame.groupBy(F.col(label).cast("long").alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.select(F.sum("n").alias("total")).scalar()
    return counts.withColumn("share", ratio(F.col("n"), total))


def metrics_record(
    train: DataFrame,
    scored_test: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    flow_name: str = "train-baseline",
    run_mode: str = "daily",
) -> DataFrame:
    """One row for the metrics log. Metrics of a class that never occurs are NaN.

    The scored test set is reduced to its confusion cells and its AUC; nothing else leaves Spark.
    """
    report = classification_report(scored_test)

    def of(cls: str, measure: str) -> Column:
        return F.max(F.when(F.col("class") == cls, F.col(measure)))

    nan = F.lit(float("nan"))
    per_class = [
        F.coalesce(of(c, m), nan).alias(f"{m}_{c}")
        for c in ("0", "1")
        for m in ("precision", "recall", "f1")
    ]
    auc = roc_auc(scored_test).select("roc_auc").scalar()
    positives = scored_test.select(F.avg(F.col(TARGET_COLUMN).cast("double"))).scalar()
    train_size = train.select(F.count(F.lit(1))).scalar()
    summary = report.agg(
        of("accuracy", "f1").alias("accuracy"),
        of("macro avg", "support").alias("test_size"),
        *per_class,
    )
    return summary.select(
        F.lit(None).cast("long").alias("pipeline_run_id"),
        F.lit(flow_name).alias("flow_name"),
        F.lit(run_mode).alias("run_mode"),
        F.lit(config.model_name).alias("model_name"),
        F.lit(config.model_version).alias("model_version"),
        train_size.alias("train_size"),
        F.col("test_size").cast("long").alias("test_size"),
        positives.alias("positive_class_ratio"),
        "accuracy",
        auc.alias("roc_auc"),
        *[f"{m}_{c}" for c in ("0", "1") for m in ("precision", "recall", "f1")],
    )


def metrics_document(
    record: DataFrame, scored_test: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """The metrics record as one nested document: report per class, class counts, model inputs.

    The lists inside hold one entry per class, so two or three.
    """
    lines = classification_report(scored_test).agg(
        F.sort_array(F.collect_list(F.struct("class", "precision", "recall", "f1", "support")))
    )
    classes = class_distribution(scored_test).agg(
        F.sort_array(F.collect_list(F.struct("class", "n")))
    )
    return record.withColumns(
        {
            "classification_report": lines.scalar(),
            "class_distribution_test": classes.scalar(),
            "feature_columns": F.array(*[F.lit(c) for c in columns]),
            "target_column": F.lit(TARGET_COLUMN),
        }
    )
