"""Two classification jobs, from file to evaluated and saved model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tagweave.operators.classify import (
    accuracy,
    classifier_pipeline,
    fit_logistic,
    fit_tree,
    load_logistic,
    load_pipeline,
    save_model,
)
from tagweave.operators.features import (
    assemble_features,
    fit_vector_index,
    in_training,
    l2_normalize,
    numbered_copies,
    string_index,
)
from tagweave.sources.files import read_csv, read_libsvm
from tagweave.storage import stage


class Trained(NamedTuple):
    model: object
    predictions: DataFrame
    accuracy: float


def measurement_classifier(
    spark: SparkSession, path: str, schema: StructType | str, model_path: str | None = None
) -> Trained:
    """Logistic regression on a CSV whose last column is the category.

    The measurements are normalised to unit length; accuracy is on the training
    rows. With ``model_path`` the model is saved and predictions come from the
    loaded copy. The text is parsed once and staged; the fit keeps its own cache.
    """
    rows = stage(read_csv(spark, path, schema), "rows")
    indexed = string_index(rows, rows.columns[-1], "label")
    measured = assemble_features(indexed, rows.columns[:-1], "raw_features")
    featured = l2_normalize(measured, "raw_features")
    model = fit_logistic(featured)
    if model_path:
        save_model(model, model_path)
        model = load_logistic(model_path)
    predictions = model.transform(featured)
    return Trained(model, predictions, accuracy(predictions, "label").first().accuracy)


def train_pipeline(
    spark: SparkSession, path: str, schema: StructType | str, model_path: str, classifier: str = "logistic"
) -> PipelineModel:
    """Train on a CSV whose last column is the category and store the whole pipeline at ``model_path``."""
    rows = stage(read_csv(spark, path, schema), "rows")
    model = classifier_pipeline(rows, rows.columns[:-1], rows.columns[-1], classifier)
    save_model(model, model_path)
    return model


def score_csv(spark: SparkSession, path: str, schema: StructType | str, model_path: str) -> DataFrame:
    """The rows of a CSV, which need no category, with the category that a stored pipeline predicts."""
    rows = read_csv(spark, path, schema)
    return load_pipeline(model_path).transform(rows).select(*rows.columns, "predicted")


def tree_classifier(spark: SparkSession, path: str, num_features: int | None = None) -> Trained:
    """Decision tree on LibSVM data: trained on 80 % of the rows, tested on the rest.

    The text is parsed once and staged; the passes of the label index, the
    feature index and the tree read the staged columns they need. LibSVM rows
    have no key: their content decides between training and test, with the number of
    the copy where rows are equal, so the split does not depend on partitioning.
    """
    parsed = read_libsvm(spark, path, num_features)
    numbered = numbered_copies(parsed.withColumn("_slots", vector_to_array("features")), ["label", "_slots"], "_content", "_copy")
    numbered = numbered.withColumn("_row", F.concat_ws(":", "_content", "_copy"))
    rows = stage(numbered.withColumn("train", in_training("_row")).drop("_slots", "_content", "_copy", "_row"), "rows")
    indexed = string_index(rows, "label", "index_label")
    features = fit_vector_index(indexed, "features", "index_features").transform(indexed)
    model = fit_tree(features.filter("train"), "index_label", "index_features")
    predictions = model.transform(features.filter("not train")).drop("train")
    return Trained(model, predictions, accuracy(predictions, "index_label").first().accuracy)
