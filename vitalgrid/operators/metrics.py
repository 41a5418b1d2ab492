"""Classification metrics as aggregates."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import UNIT_LEVELS, cell_names, key_counts, running_totals


def _ratio(part, whole):
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0)))


def confusion_counts(scored: DataFrame, by: Sequence[str] = (), label="health_risk", prediction="prediction"):
    y, p = F.col(label) == 1, F.col(prediction) == 1

    def count(condition):
        return F.count(F.when(condition, 1))

    return scored.groupBy(*by).agg(
        count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(~y & ~p).alias("tn")
    )


def confusion_matrix(scored: DataFrame, by: Sequence[str] = (), label="health_risk", prediction="prediction"):
    return scored.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def confusion_metrics(scored: DataFrame, by: Sequence[str] = (), label="health_risk", prediction="prediction"):
    """accuracy, precision, recall and f1 of class 1, each 0 where its denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_counts(scored, by, label, prediction).select(
        *by,
        (tp + fp + fn + tn).alias("n"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_counts(scored: DataFrame, by: Sequence[str] = (), label="health_risk") -> DataFrame:
    """How many label values occur: a curve needs more than one."""
    return scored.groupBy(*by).agg(F.countDistinct(label).alias("classes"))


def roc_auc(scored: DataFrame, by: Sequence[str] = (), label="health_risk", score="score") -> DataFrame:
    """Area under the ROC curve with tied scores at mid-rank; 0 when only one class is there.

    Scores are compared as they are. Rows collapse to one per distinct score first, and the
    negatives below each score come from running totals over cells.
    """
    one = F.lit(1).cast("long")
    counts = key_counts(
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull()),
        F.col(score).cast("double"),
        by,
        UNIT_LEVELS,
        {"pos": F.when(F.col(label) == 1, one).otherwise(0), "neg": F.when(F.col(label) == 1, 0).otherwise(one)},
    )
    ranked = running_totals(counts, by, ["_key"], ["neg"], cell_names(UNIT_LEVELS))
    # pairs won, doubled to stay whole: 2 * below + equal
    below = (F.col("running_neg") - F.col("neg")).cast("decimal(18,0)")
    won = F.col("pos").cast("decimal(18,0)") * (below * 2 + F.col("neg").cast("decimal(18,0)"))
    sums = ranked.groupBy(*by).agg(
        F.sum(won.cast("decimal(38,0)")).cast("double").alias("_won"),
        F.sum("pos").cast("double").alias("_pos"),
        F.sum("neg").cast("double").alias("_neg"),
    )
    return sums.select(*by, _ratio(F.col("_won"), 2 * F.col("_pos") * F.col("_neg")).alias("roc_auc"))


def evaluate(
    scored: DataFrame, by: Sequence[str] = (), label="health_risk", prediction="prediction", score="score"
) -> DataFrame:
    """One row per group: n, accuracy, precision, recall, f1 and roc_auc."""
    basic = confusion_metrics(scored, by, label, prediction)
    area = roc_auc(scored, by, label, score)
    if by:
        return basic.join(area, list(by), "left").withColumn("roc_auc", F.coalesce("roc_auc", F.lit(0.0)))
    return basic.withColumn("roc_auc", F.coalesce(area.scalar(), F.lit(0.0)))


def error_rate_daily(scored: DataFrame, by: Sequence[str] = ("location",), label="health_risk") -> DataFrame:
    """Predictions per day: how many, share of class 1, mean score and share of errors."""
    wrong = (F.col("prediction") != F.col(label)).cast("int")
    return scored.groupBy(*by, F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg(F.col("prediction").cast("double")).alias("positive_rate"),
        F.avg("score").alias("mean_score"),
        F.avg(wrong).alias("error_rate"),
    )
