"""Logistic regression on encoded rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import materialize

SEED = 11
SLICE = 10_000


@dataclass(frozen=True)
class Trained:
    model: LogisticRegressionModel
    area_under_pr: float
    area_under_roc: float


def equal_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Every distinct (label, features) with its number as ``weight``, stored: whoever reads it several times counts once."""
    counted = rows.groupBy("label", "features", *more).agg(F.count("*").cast("double").alias("weight"))
    return materialize(counted, "equal-rows")


def fit(rows: DataFrame, max_iter: int = 100) -> LogisticRegressionModel:
    """Logistic regression without intercept and penalty; the optimiser is L-BFGS.

    Equal rows enter once with their number as weight (``equal_rows`` may have been called before): the same sums, over
    fewer rows in every pass.
    """
    weighted = rows if "weight" in rows.columns else equal_rows(rows)
    regression = LogisticRegression(fitIntercept=False, regParam=0.0, maxIter=max_iter, tol=1e-6, weightCol="weight")
    return regression.fit(weighted)


def in_share(key: Column, share: float) -> Column:
    """Whether a row belongs to the first ``share`` (in thousandths) by the md5 of its key: the same in any engine."""
    place = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("bigint")
    return place % 1000 < round(1000 * share)


def split_by_key(rows: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; all rows of a key are in one of them, whatever the partitioning and however often it is repeated."""
    first = in_share(F.col(key), share)
    return rows.where(first), rows.where(~first)


def train(
    rows: DataFrame, train_share: float = 0.8, test_share: float = 0.2, max_iter: int = 100
) -> Trained:
    """Fit on a random share of the rows and measure on the rest.

    Each row draws its part once, in the only pass over all rows; both parts are stored as distinct rows with weights.
    """
    drawn = F.rand(SEED) < train_share / (train_share + test_share)
    parts = equal_rows(rows.withColumn("training", drawn), "training")
    model = fit(parts.where("training"), max_iter)
    measured = areas(score(model, parts.where("not training")))
    return Trained(model, measured["auPRC"], measured["auROC"])


def score(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """Label and raw probability of the positive class, no threshold applied; a ``weight`` stays with its row."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    weight = [name for name in rows.columns if name == "weight"]
    return model.transform(rows).select("label", probability.alias("score"), *weight)


def areas(scored: DataFrame) -> dict[str, float]:
    """Areas under both curves of (label, score) rows, with a ``weight`` or one each; every distinct score is a point of the curve.

    Equal rows are counted once and stored, so that each curve sorts distinct scores only.
    """
    number = F.sum("weight") if "weight" in scored.columns else F.count("*")
    points = scored.groupBy("label", "score").agg(number.cast("double").alias("weight"))
    points = materialize(points, "score-points")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0, weightCol="weight")
    return {
        name: evaluator.setMetricName(metric).evaluate(points)
        for name, metric in (("auPRC", "areaUnderPR"), ("auROC", "areaUnderROC"))
    }


def feature_means(model: LogisticRegressionModel, rows: DataFrame, index: DataFrame) -> DataFrame:
    """(feature, mean_label, mean_score) over the rows (with a ``weight`` or not) that have each feature; equal rows are scored once."""
    score_of = F.get(vector_to_array("probability"), F.lit(1))
    held = F.filter(
        F.transform(vector_to_array("features"), lambda x, at: F.when(x != 0, (at + 1).cast("bigint"))), lambda at: at.isNotNull()
    )
    number = F.col("weight") if "weight" in rows.columns else F.lit(1)
    equal = rows.groupBy("features").agg(F.sum(number).alias("n"), F.sum(F.col("label") * number).alias("labels"))
    each = model.transform(equal).select("n", "labels", score_of.alias("score"), F.explode(held).alias("idx"))
    sums = each.groupBy("idx").agg(F.sum("n").alias("n"), F.sum("labels").alias("labels"), F.sum(F.col("score") * F.col("n")).alias("scores"))
    means = sums.select("idx", (F.col("labels") / F.col("n")).alias("mean_label"), (F.col("scores") / F.col("n")).alias("mean_score"))
    return means.join(index, "idx").select("feature", "mean_label", "mean_score")


def metrics_frame(spark: SparkSession, trained: Trained) -> DataFrame:
    return spark.createDataFrame(
        [("auPRC", float(trained.area_under_pr)), ("auROC", float(trained.area_under_roc))],
        "metric string, value double",
    )


def weights(
    spark: SparkSession, model: LogisticRegressionModel, index: DataFrame, model_id: str
) -> DataFrame:
    """Weight of every feature: coefficient ``i`` belongs to the feature with index ``i + 1``.

    The vector is on the driver; it goes out in slices of ``SLICE``, each a row of its own.
    """
    values = model.coefficients.toArray()
    slices = [(at, values[at:at + SLICE].tolist()) for at in range(0, len(values), SLICE)]
    rows = spark.createDataFrame(slices, "start bigint, weights array<double>")
    cells = rows.select("start", F.posexplode("weights").alias("at", "weight"))
    numbered = cells.select((F.col("start") + F.col("at") + 1).alias("idx"), "weight")
    return numbered.join(index, "idx").select(
        F.lit(model_id).alias("model_id"), "feature", "weight"
    )


def prefixes(feature_columns: DataFrame, model_id: str) -> DataFrame:
    """The prefix of every feature column of a model."""
    return feature_columns.select(F.lit(model_id).alias("model_id"), "column", "short")
