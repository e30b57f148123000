"""TF-IDF and logistic-regression text classifier on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.arithmetic import percent

# Positive target, feature buckets, iterations.
POSITIVE_TARGET, FEATURES, ITERATIONS = 4, 20_000, 10


def binarize(rows: DataFrame, target: str = "target") -> DataFrame:
    """``label`` 1 for the positive target, 0 for all others and null."""
    return rows.withColumn("label", F.when(F.col(target) == POSITIVE_TARGET, 1).otherwise(0))


def words(rows: DataFrame, text: str = "text") -> DataFrame:
    """``words``: lower-case, split at white space."""
    return Tokenizer(inputCol=text, outputCol="words").transform(rows)


def content_words(rows: DataFrame, text: str = "text") -> DataFrame:
    """``words``, and ``filtered`` without English stop words."""
    return StopWordsRemover(inputCol="words", outputCol="filtered").transform(words(rows, text))


def stages(features: int = FEATURES, iterations: int = ITERATIONS) -> Pipeline:
    """Hashing keeps the model at ``features`` weights, however large the vocabulary."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol="text", outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="filtered"),
            HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=features),
            IDF(inputCol="rawFeatures", outputCol="features"),
            LogisticRegression(labelCol="label", featuresCol="features", maxIter=iterations),
        ]
    )


# The first three stages read the text row by row; the other two are fitted.
_ROW_STAGES = 3


def hashed(rows: DataFrame, features: int = FEATURES) -> DataFrame:
    """Add ``rawFeatures``, all that the fitted stages need of a text: joins then carry a sparse vector, not the text."""
    for stage in stages(features).getStages()[:_ROW_STAGES]:
        rows = stage.transform(rows)
    return rows.drop("words", "filtered")


def fit_hashed(train: DataFrame, features: int = FEATURES, iterations: int = ITERATIONS) -> PipelineModel:
    """Fit on ``rawFeatures`` and ``label``; the model has all five stages and reads texts."""
    every = stages(features, iterations).getStages()
    kept = train.select("rawFeatures", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = Pipeline(stages=every[_ROW_STAGES:]).fit(kept)
    finally:
        kept.unpersist()
    return PipelineModel([*every[:_ROW_STAGES], *fitted.stages])


def fit(train: DataFrame, features: int = FEATURES, iterations: int = ITERATIONS) -> PipelineModel:
    """Fit on ``text`` and ``label``."""
    return fit_hashed(hashed(train.select("text", "label"), features), features, iterations)


def classify_hashed(model: PipelineModel, rows: DataFrame, keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """Predictions for rows that ``hashed`` has prepared."""
    return PipelineModel(model.stages[_ROW_STAGES:]).transform(rows).select(*keep, "prediction")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def classify(model: PipelineModel, rows: DataFrame, keep: tuple[str, ...] = ("text", "label")) -> DataFrame:
    return model.transform(rows).select(*keep, "prediction")


def accuracy(predictions: DataFrame) -> float:
    """Fraction of predictions equal to the label, by Spark ML's evaluator."""
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="accuracy"
    ).evaluate(predictions)


def accuracy_row(predictions: DataFrame, rounding: str = "exact") -> DataFrame:
    """The same as one row: rows, hits, fraction and percent with two decimals."""
    counted = predictions.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("prediction") == F.col("label")).alias("correct"),
    )
    return counted.selectExpr(
        "total",
        "correct",
        "correct / greatest(total, 1) AS accuracy",
        f"{percent('correct', 'total', rounding, 2)} AS accuracy_pct",
    )
