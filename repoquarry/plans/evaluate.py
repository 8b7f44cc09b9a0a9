"""The steps both classifiers share: split, train, evaluate, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import modeling
from ..session import materialize, release
from .reports import model_report


@dataclass
class Evaluation:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    importances: DataFrame
    report: DataFrame
    distribution: DataFrame  # label, n: of all rows, before the split
    skipped: DataFrame | None = None  # one row: n_used, n_skipped of what the rows were made from


def fit_and_evaluate(
    rows: DataFrame,
    ids: Sequence[str],
    features: Sequence[str],
    classes: Sequence[str],
    title: str,
    model_type: str = "decision_tree",
    max_depth: int | None = None,
) -> Evaluation | None:
    """None when the rows hold fewer than two classes and nothing can be learned.

    The feature rows come materialized: they are read by the split, by every pass of
    the training and by the evaluation.
    """
    release(rows.sparkSession)
    distribution = materialize(modeling.label_distribution(rows))
    if distribution.limit(2).count() < 2:
        return None
    split = materialize(modeling.split_dataset(rows, ids))
    train, test = split.where("not is_test"), split.where("is_test")
    model = modeling.train_classifier(train, features, classes, model_type=model_type, max_depth=max_depth)
    predictions = materialize(modeling.predict(model, test))
    metrics = modeling.class_metrics(predictions)
    importances = modeling.feature_importances(model, rows, features)
    return Evaluation(
        model,
        predictions,
        metrics,
        modeling.confusion_matrix(predictions, classes),
        importances,
        model_report(title, model_type, len(features), train.count(), test.count(), metrics, importances, classes),
        distribution.orderBy(F.desc("n"), "label"),
    )
