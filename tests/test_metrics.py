import random

import pytest

from plumbline.functions import metrics
from plumbline.functions.explain import importance_frame
from plumbline.plans.select import best_candidate, expand_grid, winner


def scored(spark, pairs):
    return spark.createDataFrame([(a, float(b)) for a, b in pairs], "label int, prediction double")


def by_hand(pairs):
    tn, fp, fn, tp = (sum(p == q for p in pairs) for q in ((0, 0), (0, 1), (1, 0), (1, 1)))
    ratio = lambda a, b: a / b if b else 0.0
    return {
        "cm_true_negative": tn, "cm_false_positive": fp, "cm_false_negative": fn, "cm_true_positive": tp,
        "accuracy": ratio(tp + tn, len(pairs)), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn), "tnr": ratio(tn, tn + fp), "fnr": ratio(fn, fn + tp), "fpr": ratio(fp, fp + tn),
    }


CASES = {
    "mixed": [(random.Random(i).randint(0, 1), random.Random(i * 7).randint(0, 1)) for i in range(200)],
    "no predicted positives": [(0, 0), (1, 0), (1, 0)],
    "no actual positives": [(0, 0), (0, 1)],
    "all positive": [(1, 1), (1, 1)],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_metrics(spark, case):
    assert metrics.evaluate(scored(spark, CASES[case])).first().asDict() == by_hand(CASES[case])


@pytest.mark.parametrize("bad", [None, float("nan"), 2.0, 0.9, -1.0])
def test_predictions_that_are_no_class_stop_the_job(spark, bad):
    rows = [(0, 0.0, 1), (1, 1.0, 1), (1, bad, 1)]
    df = spark.createDataFrame(rows, "label int, prediction double, fold int")
    for judged in (metrics.evaluate(df), metrics.fold_accuracy(df), metrics.confusion_counts(df, by=["fold"])):
        with pytest.raises(Exception, match="neither 0 nor 1"):
            judged.collect()
    counts = metrics.invalid_predictions(df).first()
    missing = bad is None or bad != bad
    assert (counts["n_rows"], counts["n_missing"], counts["n_other"]) == (3, int(missing), int(not missing))


def test_rows_without_a_fold_stop_the_job(spark):
    df = spark.createDataFrame([(0, 0.0, 1), (1, 1.0, None)], "label int, prediction double, fold int")
    with pytest.raises(Exception, match="no fold"):
        metrics.fold_accuracy(df).collect()


def test_a_candidate_without_a_score_comes_last(spark):
    rows = [(0, 0, None), (0, 1, 0.9), (1, 0, 0.2), (1, 1, 0.1)]
    means = metrics.mean_accuracy(spark.createDataFrame(rows, "ordinal int, fold int, accuracy double"), ["ordinal"])
    assert {r["ordinal"]: r["accuracy_crossval"] for r in means.collect()} == {0: None, 1: 0.15}
    assert best_candidate(means).first()["ordinal"] == 1


def test_grouped_and_weighted(spark):
    pairs = CASES["mixed"]
    rows = [(i % 3, a, float(b), 1 + i % 4) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "g int, label int, prediction double, n bigint")
    got = {r["g"]: r for r in metrics.confusion_counts(df, by=["g"], weight="n").collect()}
    for g in range(3):
        assert got[g]["cm_true_positive"] == sum(n for h, a, b, n in rows if h == g and a == b == 1)


def test_plain_metrics_leave_out_rates(spark):
    assert "fnr" not in metrics.evaluate(scored(spark, [(0, 1)]), rates=False).columns


def test_confusion_table_has_all_cells(spark):
    table = metrics.confusion_table(metrics.confusion_counts(scored(spark, [(0, 0), (1, 0)])))
    assert {r["predicted"]: (r["actual_negative"], r["actual_positive"]) for r in table.collect()} == {
        "Predicted Negative": (1, 1),
        "Predicted Positive": (0, 0),
    }


def test_long_form(spark):
    rows = metrics.long_form(metrics.evaluate(scored(spark, [(1, 1), (0, 1)]))).collect()
    assert {r["metric"]: r["value"] for r in rows} == by_hand([(1, 1), (0, 1)])


def test_mean_accuracy_is_unweighted(spark):
    rows = [(0, 1, 1.0)] * 8 + [(0, 0, 1.0)] * 2 + [(1, 1, 1.0)]
    df = spark.createDataFrame(rows, "fold int, label int, prediction double")
    assert metrics.mean_accuracy(metrics.fold_accuracy(df)).first()[0] == 0.9


def test_best_candidate_takes_the_first_of_equals(spark):
    rows = [(2, f, a) for f, a in enumerate((0.7, 0.8, 0.9))] + [(1, f, a) for f, a in enumerate((0.9, 0.7, 0.8))] + [(0, 0, 0.1)]
    means = metrics.mean_accuracy(spark.createDataFrame(rows, "ordinal int, fold int, accuracy double"), ["ordinal"])
    assert best_candidate(means).first()["ordinal"] == 1


@pytest.mark.parametrize(
    "rows,want",
    [
        ([(0, 0.9, 0.5, 0.5), (1, 0.8, 0.9, 0.9)], 0),
        ([(0, 0.9, 0.5, 0.9), (1, 0.9, 0.6, 0.1)], 1),
        ([(0, 0.9, 0.5, 0.1), (1, 0.9, 0.5, 0.2)], 1),
        ([(1, 0.9, 0.5, 0.1), (0, 0.9, 0.5, 0.1)], 0),
    ],
)
def test_winner(spark, rows, want):
    board = spark.createDataFrame(rows, "ordinal int, accuracy double, precision double, recall double")
    assert winner(board).first()["ordinal"] == want
    assert winner(board.orderBy("recall")).first()["ordinal"] == want


def test_grid_order():
    grid = expand_grid({"b": [1, 2], "a": ["x", "y"], "C": [None]})
    assert grid == [{"C": None, "a": a, "b": b} for a in "xy" for b in (1, 2)]


def test_importances_are_sorted_by_signed_value(spark):
    rows = importance_frame(spark, {"a": -3.0, "d": 0.5, "c": 2.0, "b": 0.5}).collect()
    assert [r["feature"] for r in rows] == ["c", "b", "d", "a"]
