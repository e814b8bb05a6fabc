"""Quality of documents by hierarchical empirical Bayes: own evidence, path, host, all documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.batches import map_pieces
from isotherm.sources.scratch import staged

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>{}[]~^_\\/=+@"
_PUNCTUATION = b".,;:!?"
_CONTINUATION = bytes(range(0x80, 0xC0))

FEATURES = (
    "log_words",
    "distinct",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "punctuation",
    "exclamation",
    "bars",
    "echo",
    "same_lines",
    "closed_lines",
    "log_lines",
)


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the document classifier. `sample` bounds the labelled rows it sees."""

    sample: int = 4000
    ridge: float = 1.0
    rounds: int = 25
    least: float = 1e-4
    threshold: float = 0.5


def described(text: bytes) -> list[float]:
    """Style of a text in numbers; all zero without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    solid = b"".join(words)
    chars = len(solid.translate(None, _CONTINUATION))
    size = len(solid)

    def share(of: bytes, total: int) -> float:
        return (size - len(solid.translate(None, of))) / total

    lines = [line.rstrip() for line in text.split(b"\n") if line.strip()]
    return [
        float(np.log1p(n)),
        len(set(words)) / n,
        chars / n,
        share(_UPPER, chars),
        share(_DIGITS, chars),
        share(_SYMBOLS, chars),
        share(_PUNCTUATION, n),
        share(b"!", n),
        share(b"|", n),
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        sum(line.endswith((b".", b"!", b"?")) for line in lines) / len(lines),
        float(np.log1p(len(lines))),
    ]


@dataclass
class Classifier:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logit(self, features: np.ndarray) -> np.ndarray:
        return _design(features, self.center, self.scale) @ self.weights


def _design(features: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((features - center) / scale, -8, 8)
    return np.concatenate([np.ones((len(z), 1)), z, z * z / 4], axis=1)


def fit(features: np.ndarray, labels: np.ndarray, settings: Fit) -> Classifier:
    """Ridge logistic regression by Newton steps, on the features and their squares."""
    center, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = _design(features, center, scale)
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], settings.ridge)
    penalty[0] = 1e-6
    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (labels - p) - penalty * weights
        bend = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return Classifier(center, scale, weights)


def _features(documents: DataFrame, host: str, path: str) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [described(b"" if t is None else t.encode()) for t in batch.column("text").to_pylist()]
        flat = pa.array(np.array(rows, np.float64).ravel())
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "host": batch.column("host"),
                "path": batch.column("path"),
                "features": pa.ListArray.from_arrays(ends, flat),
            }
        )

    rows = documents.select("doc_id", "text", F.col(host).alias("host"), F.col(path).alias("path"))
    return map_pieces(rows, "text", step, "doc_id bigint, host string, path string, features array<double>")


def held_out(doc_id, folds: int = 4, fold: int = 2):
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _classifier(described_docs: DataFrame, labels: DataFrame, settings: Fit) -> Classifier | None:
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("label"))
        .where(~held_out(F.col("doc_id")))
    )
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.where(draw < min(1.0, settings.sample / max(n, 1)))
    rows = described_docs.join(chosen, "doc_id").select("doc_id", "features", "label")
    sample = sorted(rows.limit(2 * settings.sample).collect(), key=lambda r: (r["doc_id"], r["features"]))
    y = np.array([r["label"] for r in sample])
    if not len(y) or y.min() == y.max():
        return None
    return fit(np.array([r["features"] for r in sample]), y, settings)


def _strength(groups: DataFrame, n: str, total: str, squares: str) -> float:
    """How many documents a group's parent counts for: variance inside over variance between.

    By the method of moments, from one row of sums over all groups.
    """
    row = groups.agg(
        F.count("*").alias("g"),
        F.sum(n).alias("n"),
        F.sum(F.col(n) * F.col(n)).cast("double").alias("nn"),
        F.sum(total).alias("t"),
        F.sum(F.col(total) * F.col(total) / F.col(n)).alias("tt"),
        F.sum(squares).alias("s"),
    ).first()
    if not row["n"] or row["n"] <= row["g"] or row["g"] < 2:
        return float(row["n"] or 1)
    inside = max(row["s"] - row["tt"], 0.0) / (row["n"] - row["g"]) + 1e-9
    between = row["tt"] - row["t"] ** 2 / row["n"] - (row["g"] - 1) * inside
    between /= row["n"] - row["nn"] / row["n"]
    return float(min(max(inside / max(between, 1e-12), 1.0), 1e9))


def site_quality(
    documents: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", settings: Fit = Fit()
) -> DataFrame:
    """doc_id, held_out, evidence, host_prior, path_prior, quality and kept for each row.

    `evidence` is a document classifier's probability of label 1 from the text's style, learned from
    at most `sample` labelled rows (in expectation) outside the held-out fold. A host's prior is the
    mean evidence of its other documents, shrunk toward the mean of all documents; a path's prior
    (a path is a value of `path` within a host) is shrunk toward its host's. The weight of the parent
    is estimated from the data for both levels, so sparse sites lean on it. A document's own evidence
    is left out of its priors. `quality` is the evidence with the training prior exchanged for the
    path's prior: odds(quality) = odds(evidence) x odds(path_prior) / odds(mean of all).

    Null text counts as text without words. A null host or path is a value of its own. Documents
    without a label, null ids and repeated rows are judged row by row; several labels of a document
    are averaged. Without both kinds of label evidence is 0.5. Other columns are not read. Sums for a
    host or path are partial aggregates, so a host with a third of all rows is one row when it moves.
    """
    docs = staged(_features(documents, host, path), "features")
    classifier = _classifier(docs, labels, settings)
    shared = documents.sparkSession.sparkContext.broadcast(classifier)

    def judge(batches):
        for batch in batches:
            n = batch.num_rows
            values = batch.column("features").flatten().to_numpy().reshape(n, len(FEATURES))
            logit = shared.value.logit(values) if shared.value else np.zeros(n)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            # rounded, so that sums over other partitions do not show
            p = np.round(np.clip(p, settings.least, 1 - settings.least), 9)
            yield pa.RecordBatch.from_pydict(
                {**{c: batch.column(c) for c in ("doc_id", "host", "path")}, "evidence": pa.array(p)}
            )

    judged = staged(docs.mapInArrow(judge, "doc_id bigint, host string, path string, evidence double"), "evidence")
    sums = [
        F.count("*").alias("n"),
        F.sum("evidence").alias("total"),
        F.sum(F.col("evidence") * F.col("evidence")).alias("squares"),
    ]
    paths = staged(judged.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(f"host_{c}") for c in ("n", "total", "squares")])
    hosts = staged(hosts, "hosts")
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_total").alias("total")).first()
    mean = whole["total"] / whole["n"] if whole["n"] else 0.5
    host_weight = _strength(hosts, "host_n", "host_total", "host_squares")
    path_weight = _strength(paths, "n", "total", "squares")
    sites = paths.drop("squares").join(
        hosts.drop("host_squares").withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))
    )
    sites = staged(sites.drop("_host"), "sites").withColumnsRenamed({"host": "_host", "path": "_path"})
    own = F.col("evidence")
    host_prior = (F.col("host_total") - own + host_weight * mean) / (F.col("host_n") - 1 + host_weight)
    path_prior = (F.col("total") - own + path_weight * F.col("host_prior")) / (F.col("n") - 1 + path_weight)

    def odds(p):
        return p / (1 - p)

    prior = F.least(F.greatest(F.col("path_prior"), F.lit(settings.least)), F.lit(1 - settings.least))
    base = min(max(mean, settings.least), 1 - settings.least)
    ratio = odds(own) * odds(prior) / odds(base)
    return (
        judged.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
        .withColumn("host_prior", host_prior)
        .withColumn("path_prior", path_prior)
        .withColumn("quality", F.round(ratio / (1 + ratio), 6))
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "evidence",
            F.round("host_prior", 6).alias("host_prior"),
            F.round("path_prior", 6).alias("path_prior"),
            "quality",
            (F.col("quality") >= settings.threshold).alias("kept"),
        )
    )
