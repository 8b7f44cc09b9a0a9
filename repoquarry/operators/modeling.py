"""Split, train, predict and evaluate."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import hash_ordered, hash_cuts, hash_edges

# Trees of a forest, seed, and the deepest tree the library accepts.
TREES = 100
SEED = 42
MAX_DEPTH = 30
MAX_BINS = 32  # candidate splits of a feature: the library compares quantiles, not every value
FIT_TASKS = 32  # tasks of a fit, while they have no more than TASK_ROWS rows: each sends histograms of all nodes of a level
TASK_ROWS = 100_000
MAX_CLASSES = 1_000  # values of a label column; quotas of all of them come to the driver


def label_distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n"))


def split_quotas(rows: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class: (label, size, test_rows); one row per class.

    The test set has ``ceil(test_size * total)`` rows. Training quotas are the
    proportional shares rounded down, the rows left go to the largest remainders.
    """
    sizes = label_distribution(rows, label).withColumnRenamed("n", "size")
    everything = Window.partitionBy(F.lit(0))  # one row per class
    total = F.sum("size").over(everything)
    shared = (
        sizes.withColumn("total", total)
        .withColumn("train", F.col("total") - F.ceil(F.col("total") * F.lit(test_size)))
        .withColumn("scaled", F.col("size").cast("decimal(38,0)") * F.col("train"))
        .withColumn("floored", F.expr("scaled div total"))
        .withColumn("remainder", F.col("scaled") - F.col("floored").cast("decimal(38,0)") * F.col("total"))
    )
    place = F.row_number().over(everything.orderBy(F.desc("remainder"), label))
    extra = F.col("train") - F.sum("floored").over(everything)
    train = F.col("floored") + F.when(place <= extra, 1).otherwise(0)
    return shared.select(label, "size", (F.col("size") - train).alias("test_rows"))


def split_dataset(
    rows: DataFrame, ids: Sequence[str], label: str = "label", test_size: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: stratified by label, plain when some class has one row only.

    The classes are counted once and their quotas come to the driver, so more than
    ``MAX_CLASSES`` of them are an error. Rows are compared with one cut per class.
    """
    quotas = split_quotas(rows, label, test_size).limit(MAX_CLASSES + 1).collect()
    if len(quotas) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} values and is no class column")
    columns = rows.columns
    ordered = hash_ordered(rows, ids, seed)
    if all(row["size"] >= 2 for row in quotas):
        wanted = F.lit(0)
        for row in quotas:
            wanted = F.when(F.col("__group").eqNullSafe(F.lit(row[label])), F.lit(row["test_rows"])).otherwise(wanted)
        group, quota = F.col(label), wanted
    else:
        total = sum(row["size"] for row in quotas)
        group, quota = F.lit("all"), F.lit(math.ceil(total * test_size))
    edges = hash_edges(ordered, group, quota)
    cuts = hash_cuts(ordered, group, edges).select(F.col("__group").alias("__cut_group"), "__cut")
    marked = ordered.withColumn("__group", group).join(
        F.broadcast(cuts), F.col("__group").eqNullSafe(F.col("__cut_group")), "left"
    )
    is_test = F.coalesce(F.col("__place") <= F.col("__cut"), F.lit(False))
    return marked.select(*columns, is_test.alias("is_test"))


def bounded_rows(rows: DataFrame, most: int) -> DataFrame:
    """All rows if they are ``most`` at most, else a share of about that size by hash."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(1_000_000)) < int(1_000_000 * most / n))


def in_fit_tasks(rows: DataFrame, least: int = FIT_TASKS, task_rows: int = TASK_ROWS) -> DataFrame:
    """All rows, in no more partitions than a fit needs.

    In every pass each task sends the histograms of all nodes it has met, empty or not, so what a pass
    shuffles grows with the tasks.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(least, cores, math.ceil(rows.count() / task_rows)))


def train_classifier(
    rows: DataFrame,
    features: Sequence[str],
    classes: Sequence[str],
    label: str = "label",
    model_type: str = "decision_tree",
    max_depth: int | None = None,
    max_bins: int = MAX_BINS,
) -> PipelineModel:
    """Fit a tree or a forest to all rows; ``prediction`` of the fitted model is a class name.

    Without ``max_depth`` trees grow as deep as the library allows. A fitted tree lives
    on the driver and grows with its rows.
    """
    rows = in_fit_tasks(rows)
    depth = MAX_DEPTH if max_depth is None else max_depth
    shared = {"featuresCol": "__features", "labelCol": "__label", "predictionCol": "__class", "maxDepth": depth,
              "maxBins": max_bins, "seed": SEED}
    if model_type == "decision_tree":
        learner = DecisionTreeClassifier(**shared)
    elif model_type == "random_forest":
        learner = RandomForestClassifier(numTrees=TREES, **shared)
    else:
        raise ValueError(f"unsupported model type {model_type!r}; use 'decision_tree' or 'random_forest'")
    # the class names are known, so indexing them needs no pass over the data
    indexer = StringIndexerModel.from_labels(list(classes), inputCol=label, outputCol="__label")
    return Pipeline(
        stages=[
            indexer,
            VectorAssembler(inputCols=list(features), outputCol="__features"),
            learner,
            IndexToString(inputCol="__class", outputCol="prediction", labels=list(classes)),
        ]
    ).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    hidden = ("__label", "__features", "__class", "rawPrediction", "probability")
    return model.transform(rows).drop(*hidden)


def feature_importances(model: PipelineModel, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance) in descending order."""
    learner = next(stage for stage in model.stages if hasattr(stage, "featureImportances"))
    values = learner.featureImportances.toArray().tolist()
    named = F.array(*[F.struct(F.lit(name).alias("feature"), F.lit(value).alias("importance"))
                      for name, value in zip(features, values)])
    return rows.sparkSession.range(1).select(F.inline(named)).orderBy(F.desc("importance"), "feature")


def outcome_counts(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): all that evaluation needs, at most one row per pair of classes."""
    return predicted.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_metrics(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class of the test set, averages, accuracy.

    Where predictions leave the classes of the test set, precision and recall over
    these classes differ, and the row ``micro avg`` stands in place of ``accuracy``. A
    ratio without rows is 0.
    """
    pairs = outcome_counts(predicted, label, prediction)
    hit = F.col("label") == F.col("prediction")
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                         F.when(hit, F.col("n")).otherwise(0).alias("hits"), F.lit(0).cast("long").alias("guessed")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"),
                         F.lit(0).cast("long").alias("hits"), F.col("n").alias("guessed")),
            )
        )
    )
    sums = (
        sides.groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("guessed").alias("guessed"))
        .where(F.col("support") > 0)
        .withColumn("precision", _ratio(F.col("hits"), F.col("guessed")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    scores = ("precision", "recall", "f1")
    support = F.sum("support")
    recall, precision = F.sum("hits") / support, _ratio(F.sum("hits"), F.sum("guessed"))
    micro = {"precision": precision, "recall": recall, "f1": _ratio(2 * precision * recall, precision + recall)}
    name = F.when(F.sum("guessed") == support, "accuracy").otherwise("micro avg")
    summary = sums.agg(
        F.struct(name.alias("class"), *[micro[s].alias(s) for s in scores], support.alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(s).alias(s) for s in scores],
                 support.alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("class"), *[(F.sum(F.col(s) * F.col("support")) / support).alias(s)
                                                         for s in scores], support.alias("support")).alias("w"),
    ).where(F.col("a.support") > 0).select(F.inline(F.array("a", "m", "w")))
    return sums.select("class", *scores, "support").unionByName(summary)


def confusion_matrix(
    predicted: DataFrame, classes: Sequence[str], label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per class of the test set, one count column per class, in class order.

    ``classes`` lists all classes in order; only those of the test set appear.
    """
    pairs = outcome_counts(predicted, label, prediction)
    present = {row[0] for row in pairs.select("label").distinct().collect()}  # one row per class
    shown = [name for name in classes if name in present]
    order = F.array_position(F.array(*map(F.lit, shown)), F.col("label"))
    return (
        pairs.where(F.col("label").isin(*shown))
        .groupBy("label").pivot("prediction", shown).agg(F.sum("n")).fillna(0).orderBy(order)
    )
