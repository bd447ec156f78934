"""Classification metrics. Everything follows from the confusion table, which has at most classes squared rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One set of metric names for model selection, search and final evaluation.
METRICS = ("accuracy", "balanced_accuracy", "precision", "recall", "f1_macro", "f1_micro")


def confusion(predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``label, prediction, n`` (per ``keys``, for instance per model)."""
    return predictions.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, classes: list[str]) -> DataFrame:
    """One row per true class, one column per class."""
    return predictions.groupBy("label").pivot("prediction", classes).count().na.fill(0)


def class_table(table: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``label, tp, support, predicted, precision, recall, f1`` for every class seen as label or prediction."""
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(
            F.col("label").alias("label"),
            F.when(F.col("label") == F.col("prediction"), n).otherwise(zero).alias("tp"),
            n.alias("support"),
            zero.alias("predicted"),
        ),
        F.struct(F.col("prediction").alias("label"), zero.alias("tp"), zero.alias("support"), n.alias("predicted")),
    )
    sums = (
        table.select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.label").alias("label"))
        .agg(
            F.sum("s.tp").alias("tp"), F.sum("s.support").alias("support"), F.sum("s.predicted").alias("predicted")
        )
    )
    share = lambda top, bottom: F.when(bottom > 0, top / bottom).otherwise(0.0)
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return (
        sums.withColumn("precision", share(tp, predicted))
        .withColumn("recall", share(tp, support))
        .withColumn("f1", share(2 * tp, support + predicted))
    )


def summary(table: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row (per ``keys``) with all metrics. Accuracy is that of the pooled predictions."""
    classes = class_table(table, keys)
    accuracy = F.sum("tp") / F.sum("support")
    return classes.groupBy(*keys).agg(
        accuracy.alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1_macro"),
        accuracy.alias("f1_micro"),
    )


def fold_accuracy(predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the accuracies of the folds."""
    correct = (F.col("label") == F.col("prediction")).cast("double")
    folds = predictions.groupBy(*keys, "fold").agg(F.avg(correct).alias("a"))
    return folds.groupBy(*keys).agg(F.avg("a").alias("accuracy"))


def report(table: DataFrame) -> DataFrame:
    """``row, precision, recall, f1, support``: one row per class, then accuracy, macro and weighted averages."""
    classes = class_table(table)
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    accuracy = F.sum("tp") / total
    macro = [F.avg(m).alias(m) for m in measures]
    weighted = [(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures]
    rows = [
        classes.select(F.col("label").alias("row"), *measures, "support"),
        classes.agg(*[accuracy.alias(m) for m in measures], total.alias("support")).withColumn("row", F.lit("accuracy")),
        classes.agg(*macro, total.alias("support")).withColumn("row", F.lit("macro avg")),
        classes.agg(*weighted, total.alias("support")).withColumn("row", F.lit("weighted avg")),
    ]
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


def rank_models(metrics: DataFrame, metric: str = "f1_macro", minimum: float = 0.0, top: int | None = None) -> DataFrame:
    """Models that reach the minimum, best first; equal models keep their given order (``model_order``)."""
    ranked = metrics.filter(F.col(metric) >= minimum).orderBy(F.desc(metric), "model_order")
    return ranked if top is None else ranked.limit(top)


def vote_hard(predictions: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Most frequent prediction per record over all models; ties go to the lowest label.

    Votes are counted per (record, label) first, so the second grouping sees one row per label.
    """
    votes = predictions.groupBy(id_col, "prediction").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy(id_col).agg(F.max("votes").alias("votes"), F.collect_list(F.struct("votes", "prediction")).alias("all"))
    winner = F.array_min(F.transform(F.filter("all", lambda v: v["votes"] == F.col("votes")), lambda v: v["prediction"]))
    return best.select(id_col, winner.alias("prediction"), "votes")


def vote_soft(probabilities: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Label with the highest mean probability; ties go to the lowest label."""
    means = probabilities.groupBy(id_col, "label").agg(F.round(F.avg("probability"), 6).alias("probability"))
    best = means.groupBy(id_col).agg(
        F.max("probability").alias("probability"), F.collect_list(F.struct("probability", "label")).alias("all")
    )
    winner = F.array_min(F.transform(F.filter("all", lambda v: v["probability"] == F.col("probability")), lambda v: v["label"]))
    return best.select(id_col, winner.alias("prediction"), "probability")
