"""Confusion counts and everything derived from them, for any number of candidates at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the counts, the ratios, and the labels of the two-by-two table.
COUNTS = ("cm_true_negative", "cm_false_positive", "cm_false_negative", "cm_true_positive")
QUALITY = ("accuracy", "precision", "recall", "f1_score")
RATES = ("tnr", "fnr", "fpr")
ACTUAL = ("Actual Negative", "Actual Positive")
PREDICTED = ("Predicted Negative", "Predicted Positive")


def confusion_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """True and false negatives and positives, one row per value of ``by``.

    ``weight`` names a row count when the input is already grouped. Without ``by`` an empty input
    gives one row of zeros. A label or prediction that is neither 0 nor 1 (NULL, NaN and fractions
    included) stops the job; ``invalid_predictions`` counts them.
    """
    n = F.lit(1) if weight is None else F.col(weight)
    actual, said, usable = _classes(label, prediction)
    cells = zip(COUNTS, ((0, 0), (0, 1), (1, 0), (1, 1)))
    sums = [_total(F.when((actual == a) & (said == b), n)).alias(name) for name, (a, b) in cells]
    counted = (df.groupBy(*by) if by else df.groupBy()).agg(*sums, _total(F.when(~usable, n)).alias("__bad"))
    refused = F.raise_error(F.concat(F.col("__bad").cast("string"), F.lit(" rows have a label or prediction that is neither 0 nor 1")))
    checked = [F.when(F.col("__bad") == 0, F.col(c)).otherwise(refused.cast("bigint")).alias(c) for c in COUNTS]
    return counted.select(*by, *checked)


def invalid_predictions(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(n_rows, n_missing, n_other): rows, those whose label or prediction is NULL or NaN, and those with
    another value than 0 and 1."""
    _, _, usable = _classes(label, prediction)
    missing = F.lit(False)
    for c in (label, prediction):
        value = F.col(c).cast("double")
        missing = missing | value.isNull() | F.coalesce(F.isnan(value), F.lit(False))
    return (df.groupBy(*by) if by else df.groupBy()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(missing, 1)).alias("n_missing"),
        F.count(F.when(~missing & ~usable, 1)).alias("n_other"),
    )


def _classes(label: str, prediction: str) -> tuple[Column, Column, Column]:
    actual, said = F.col(label).cast("double"), F.col(prediction).cast("double")
    return actual, said, F.coalesce(actual.isin(0.0, 1.0) & said.isin(0.0, 1.0), F.lit(False))


def _total(n: Column) -> Column:
    return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")


def with_quality(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall and F1; an undefined ratio is 0."""
    tn, fp, fn, tp = map(F.col, COUNTS)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Add specificity, miss rate and fall-out; an undefined rate is 0."""
    tn, fp, fn, tp = map(F.col, COUNTS)
    return counts.withColumns({"tnr": _ratio(tn, tn + fp), "fnr": _ratio(fn, fn + tp), "fpr": _ratio(fp, fp + tn)})


def evaluate(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = (), rates: bool = True
) -> DataFrame:
    """All metrics in one pass over the predictions."""
    out = with_quality(confusion_counts(df, label, prediction, by))
    return with_rates(out) if rates else out


def confusion_table(counts: DataFrame) -> DataFrame:
    """The two-by-two table as shown to people: one row per predicted class, one column per actual."""
    tn, fp, fn, tp = map(F.col, COUNTS)
    rows = F.array(
        F.struct(F.lit(PREDICTED[0]).alias("predicted"), tn.alias("neg"), fn.alias("pos")),
        F.struct(F.lit(PREDICTED[1]).alias("predicted"), fp.alias("neg"), tp.alias("pos")),
    )
    return counts.select(F.explode(rows).alias("r")).select(
        "r.predicted", F.col("r.neg").alias("actual_negative"), F.col("r.pos").alias("actual_positive")
    )


def long_form(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(metric, value) rows of a metrics frame."""
    names = [c for c in metrics.columns if c not in by]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in names])
    return metrics.select(*by, F.explode(pairs).alias("m")).select(*by, "m.metric", "m.value")


def fold_accuracy(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    fold: str = "fold",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy of every fold on its own; a row without a fold stops the job."""
    none = F.raise_error(F.lit("a row has no fold")).cast(df.schema[fold].dataType)
    out = with_quality(confusion_counts(df.withColumn(fold, F.coalesce(F.col(fold), none)), label, prediction, [*by, fold]))
    return out.select(*by, fold, "accuracy")


def mean_accuracy(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean over the folds, rounded at the 12th digit so equal candidates tie; NULL if a fold
    has no score."""
    complete = F.count("accuracy") == F.count(F.lit(1))
    mean = F.when(complete, F.round(F.avg("accuracy"), 12)).alias("accuracy_crossval")
    return (scores.groupBy(*by) if by else scores.groupBy()).agg(mean)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / F.nullif(bottom, F.lit(0)).cast("double"))
