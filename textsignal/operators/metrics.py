"""Classification metrics from (y_true, y_pred) rows.

Everything is derived from one small table of counts per (group, true, predicted): the data is read
once and shuffled only as partial counts.
"""
from pyspark.sql import Window as W, functions as F

AVERAGES = ["accuracy", "macro avg", "weighted avg"]


def pair_counts(preds, by=()):
    return preds.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def _safe(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def per_class(preds, by=()):
    """Precision, recall, F1 and support of each class seen as truth or prediction."""
    pairs = pair_counts(preds, by)
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y_true").alias("cls"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p"), hit.cast("long").alias("h")),
        F.struct(F.col("y_pred").alias("cls"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p"), F.lit(0).cast("long").alias("h")))
    sums = (pairs.select(*by, F.inline(sides)).groupBy(*by, F.col("cls").alias("class"))
            .agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("h").alias("hits")))
    precision, recall = _safe(F.col("hits"), F.col("predicted")), _safe(F.col("hits"), F.col("support"))
    return (sums.withColumn("precision", precision).withColumn("recall", recall)
            .withColumn("f1", _safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
            .select(*by, "class", "precision", "recall", "f1", "support"))


def accuracy(preds, by=()):
    pairs = pair_counts(preds, by)
    return pairs.groupBy(*by).agg(
        (F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))


def weighted_f1(preds, by=()):
    return per_class(preds, by).groupBy(*by).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def report(preds, by=()):
    """Class rows, then accuracy, macro and weighted averages. On the accuracy row all four values are the
    accuracy."""
    classes = per_class(preds, by)
    number = ["precision", "recall", "f1"]
    macro = classes.groupBy(*by).agg(*[F.avg(c).alias(c) for c in number], F.sum("support").alias("support"))
    weighted = classes.groupBy(*by).agg(
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in number],
        F.sum("support").alias("support"))
    acc = accuracy(preds, by)
    cols = [*by, "class", *number, "support"]
    as_row = lambda df, name: df.withColumn("class", F.lit(name)).select(*cols)
    acc_row = acc.select(*by, F.lit("accuracy").alias("class"),
                         *[F.col("accuracy").alias(c) for c in [*number, "support"]])
    double = lambda df: df.withColumn("support", F.col("support").cast("double")).select(*cols)
    return (double(classes).unionByName(acc_row.select(*cols)).unionByName(double(as_row(macro, "macro avg")))
            .unionByName(double(as_row(weighted, "weighted avg"))))


def confusion_long(preds):
    """(y_true, y_pred, n) over all pairs of labels, zeros included."""
    pairs = pair_counts(preds)
    labels = pairs.select(F.explode(F.array("y_true", "y_pred")).alias("l")).agg(
        F.array_sort(F.collect_set("l")).alias("ls")).scalar()
    # Classes × classes: the label list is an array, so the grid is two explodes of it.
    present = pairs.select("y_true").distinct().withColumn("y_pred", F.explode(labels))
    absent = pairs.select(F.col("y_pred").alias("y_true")).distinct().withColumn("y_pred", F.explode(labels))
    grid = present.unionByName(absent).distinct()
    return grid.join(pairs, ["y_true", "y_pred"], "left").na.fill(0, ["n"])


def confusion_wide(preds, labels):
    """One row per label, also for one that is only predicted, and one column per predicted label; `labels` fixes the columns."""
    return confusion_long(preds).groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n")).na.fill(0)


def ranking(preds, by="model"):
    """(model, accuracy, f1_weighted), best first."""
    return (accuracy(preds, [by]).join(weighted_f1(preds, [by]), by)
            .orderBy(F.desc("f1_weighted"), by))


def best_model(scores, order="position", score="f1_weighted"):
    """The row with the strictly highest score; the first one in `order` wins a tie."""
    best = F.max_by(F.struct(*scores.columns), F.struct(F.col(score), -F.col(order)))
    return scores.agg(best.alias("b")).select("b.*")


def best_predictions(preds, best):
    """Predictions of the best model; `best` is a one-row table."""
    return preds.filter(F.col("model") == best.select("model").scalar())


def ranked_probabilities(df, id_col):
    """Rank of each (label, prob) row within its id, highest first."""
    w = W.partitionBy(id_col).orderBy(F.desc("prob"), "label")
    return df.withColumn("rank", F.row_number().over(w))
