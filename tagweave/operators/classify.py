"""Classifiers: training, accuracy, saving and loading."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import IndexToString, Normalizer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F


def fit_logistic(df: DataFrame, label: str = "label", features: str = "features") -> LogisticRegressionModel:
    """Logistic regression with elastic-net penalty; more than two labels are multinomial."""
    return LogisticRegression(
        labelCol=label,
        featuresCol=features,
        predictionCol="prediction",
        # Training effort and penalty.
        maxIter=15,
        regParam=0.3,
        elasticNetParam=0.8,
    ).fit(df.select(label, features))


def fit_tree(
    df: DataFrame, label: str = "label", features: str = "features"
) -> DecisionTreeClassificationModel:
    """Decision tree on Gini impurity."""
    return DecisionTreeClassifier(
        labelCol=label,
        featuresCol=features,
        predictionCol="prediction",
        # Size of the tree.
        maxDepth=5,
        maxBins=32,
        impurity="gini",
        seed=42,
    ).fit(df.select(label, features))


def classifier_pipeline(
    rows: DataFrame, measurements: list[str], category: str, classifier: str = "logistic"
) -> PipelineModel:
    """Everything between raw rows and the name of a category, fitted and kept as one model.

    The categories are indexed by frequency, the measurements put together and
    brought to unit length, the classifier trained, and its prediction turned back
    into the category. A stored copy scores rows that have the measurements only;
    rows that lack one get no prediction but an error.
    """
    if classifier not in ("logistic", "tree"):
        raise ValueError(f"unknown classifier {classifier!r}")
    index = StringIndexer(inputCol=category, outputCol="label", stringOrderType="frequencyDesc").fit(rows)
    prepared = [
        VectorAssembler(inputCols=measurements, outputCol="raw_features", handleInvalid="error"),
        Normalizer(inputCol="raw_features", outputCol="features", p=2.0),
    ]
    featured = index.transform(rows)
    for step in prepared:
        featured = step.transform(featured)
    model = (fit_logistic if classifier == "logistic" else fit_tree)(featured)
    name = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)
    # Steps that need no fitting are taken over as they are; the rows are read by the two fits above.
    return PipelineModel([index, *prepared, model, name])


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right, as one row."""
    right = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(right).alias("accuracy"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_logistic(path: str) -> LogisticRegressionModel:
    return LogisticRegressionModel.load(path)


def load_tree(path: str) -> DecisionTreeClassificationModel:
    return DecisionTreeClassificationModel.load(path)
