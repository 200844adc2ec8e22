import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.metrics import mean_accuracy
from plumbline.plans import train, tune
from plumbline.plans.families import DEFAULTS, FAMILIES, GRIDS, LONG_NAMES, cross_validate, family
from plumbline.plans.prepared import FOLDS, Prepared
from plumbline.plans.select import expand_grid, winner
from plumbline.sources.sinks import RunLog, input_example, read_pointer, signature

RNG = np.random.default_rng(8)
N = 1500
DATA = pd.DataFrame({"k": np.arange(N), "a": RNG.random(N), "b": RNG.integers(0, 5, N), "c": RNG.random(N) < 0.5})
DATA["y"] = ((DATA.a * 5 + DATA.b + 2 * DATA.c > 5) ^ (RNG.random(N) < 0.1)).astype(int)

SETTINGS = {
    "lr": {"C": 0.5},
    "rf": {"n_estimators": 3, "max_depth": 4},
    "adaboost": {"n_estimators": 3, "learning_rate": 0.5},
    "dt": {"max_depth": 4, "min_samples_split": 30},
}
SMALL = {
    "lr": {"C": [0.1, 10.0], "penalty": ["l2"], "solver": ["sag", "lbfgs"], "max_iter": [100, 500]},
    "rf": {"n_estimators": [2, 3], "max_depth": [2, 4], "min_samples_split": [2, 60], "min_samples_leaf": [1], "max_features": ["sqrt"]},
    "adaboost": {"n_estimators": [1, 3], "learning_rate": [0.1, 1.0], "base_max_depth": [1, 2]},
    "dt": {"criterion": ["gini", "entropy"], "max_depth": [6, 3], "min_samples_split": [2, 60], "min_samples_leaf": [4]},
}


@pytest.fixture(scope="module")
def p(spark):
    prepared = Prepared(spark.createDataFrame(DATA), "y", ["k"])
    yield prepared
    prepared.release()


def test_binned_rows_are_not_cached_a_second_time(p):
    """A copy of the kept rows beside them took as much memory again and had one reader."""
    assert p.binned.count() == p.rows()
    assert not p.binned.storageLevel.useMemory and not p.binned.storageLevel.useDisk
    assert p.df.storageLevel.useMemory


def test_grid_sizes():
    assert {n: len(expand_grid(g)) for n, g in GRIDS.items()} == {"lr": 60, "rf": 54, "adaboost": 27, "dt": 72}
    assert list(LONG_NAMES) == ["lr", "rf", "adaboost", "dt"] == list(FAMILIES)
    assert DEFAULTS["rf"] == {"n_estimators": 100, "max_depth": 10}


def test_unknown_family_and_parameters(p):
    with pytest.raises(ValueError, match="not supported"):
        family("svm")
    with pytest.raises(ValueError, match="not supported"):
        train.train_one(p, "svm")
    for bad in ({"penalty": "l1"}, {"solver": "guess"}):
        with pytest.raises(ValueError):
            family("lr").fit(p, bad)
    with pytest.raises(TypeError):
        family("dt").fit(p, {"n_estimators": 3})


def test_prepared_counts(p):
    assert p.rows() == p.train.count() == 1200
    for k in range(FOLDS):
        assert p.rows("cv_fold", k) == p.train.where(F.col("cv_fold") != k).count()


@pytest.mark.parametrize("name", ["dt", "rf", "adaboost", "lr"])
def test_grid_scores_equal_single_fits(p, name):
    """What a search reads off shared fits is what separate fits give."""
    candidates = expand_grid(SMALL[name])
    scores = tune.grid_frame(p, name, candidates).collect()
    assert len(scores) == len(candidates) * FOLDS
    for i in (0, len(candidates) // 2, len(candidates) - 1):
        alone = cross_validate(p, name, candidates[i], "grid_fold").collect()
        assert {r["fold"]: r["accuracy"] for r in scores if r["ordinal"] == i} == {r["fold"]: r["accuracy"] for r in alone}


@pytest.mark.parametrize("name", list(SETTINGS))
def test_train_one(spark, p, tmp_path, name):
    out = str(tmp_path)
    result = train.train_one(p, name, SETTINGS[name], out)
    assert result.metrics["accuracy"] > 0.7 and 0.7 < result.accuracy_crossval < 1
    assert "fnr" not in result.metrics
    folder = f"{out}/models"
    log = RunLog(spark, folder)
    assert log.latest(name) == result.run_id and log.latest("other") is None
    saved = spark.read.json(log.path(result.run_id, f"{name}_metrics")).first().asDict()
    assert saved == result.metrics and isinstance(saved["cm_true_positive"], int)
    assert read_pointer(spark, f"{folder}/model_run_id").first()["run_id"] == result.run_id
    assert [(r["run_id"], r["run_name"], r["family"]) for r in log.runs.collect()] == [(result.run_id, f"{name}_run_ci", name)]
    values = {(r["kind"], r["name"]): r["value_num"] for r in log.values.collect()}
    assert values["metric", "accuracy_crossval"] == result.accuracy_crossval
    assert (("importance", "importance_a") in values) == (name != "lr")
    if name != "lr":
        table = spark.read.csv(log.path(result.run_id, f"{name}_feature_importance"), header=True, schema="feature string, importance double")
        shares = [r["importance"] for r in table.collect()]
        assert shares == sorted(shares, reverse=True)
    again = train.load_fit(spark, name, log.path(result.run_id, f"{name}_model"))
    assert train.judge(p, again, rates=False) == result.metrics


def test_tune_all(spark, p, tmp_path):
    grids = {n: {k: v[:1] for k, v in g.items()} for n, g in SMALL.items()}
    board, results = tune.tune_all(p, grids, str(tmp_path))
    rows = board.collect()
    assert [r["family"] for r in sorted(rows, key=lambda r: r["ordinal"])] == list(LONG_NAMES)
    best = max(rows, key=lambda r: (r["accuracy"], r["precision"], r["recall"], -r["ordinal"]))
    assert winner(board).first()["family"] == best["family"]
    folder = f"{tmp_path}/models_tuned"
    assert read_pointer(spark, f"{folder}/best_tuned_model_run_id").first()["run_id"] == results[best["family"]].run_id
    log = RunLog(spark, folder)
    again = train.load_fit(spark, best["family"], log.path(best["run_id"], f"{best['long_name']}_tuned_model"))
    assert train.judge(p, again, rates=True) == results[best["family"]].metrics
    assert log.runs.count() == 4
    logged = log.values.where("kind = 'metric'").groupBy("run_id").count().collect()
    assert {r["count"] for r in logged} == {11}
    assert log.values.where("kind = 'importance'").select("run_id").distinct().count() == 4
    assert json.loads(rows[0]["params"])


def test_a_candidate_that_cannot_start_does_not_end_the_search(spark):
    """No feature tells the classes apart, so no boosted fit can start; the tree family still ranks."""
    rows = [(i, float(i % 2), (i // 2) % 2) for i in range(400)]
    q = Prepared(spark.createDataFrame(rows, "k int, a double, y int"), "y", ["k"])
    scores = family("adaboost").grid_scores(q, [{"n_estimators": 2}], "grid_fold")
    assert len(scores) == FOLDS and all(a is None or 0 <= a <= 1 for _, _, a in scores)
    q.release()


def test_left_out_parameters_are_the_estimators(p):
    """An unlimited tree, not the depth of the plain run."""
    whole = train.train_one(p, "dt", cross_validate=False)
    assert whole.params == {} and whole.fit.trees[0].depth.max() > DEFAULTS["dt"]["max_depth"] - 1


def test_grid_plan(p):
    plan = tune.grid_plan(p, "dt", expand_grid(GRIDS["dt"])).collect()
    assert len(plan) == 72 * FOLDS
    assert {r["n_train"] for r in plan if r["fold"] == 2} == {p.rows("grid_fold", 2)}
    assert plan[0]["max_depth"] is None


def test_cross_validation_uses_stratified_folds(p):
    scores = cross_validate(p, "dt", {"max_depth": 3})
    assert sorted(r["fold"] for r in scores.collect()) == list(range(FOLDS))
    mean = mean_accuracy(scores).first()[0]
    assert mean == pytest.approx(np.mean([r["accuracy"] for r in scores.collect()]))


def test_table_without_a_key(spark):
    df = spark.createDataFrame(DATA.drop(columns="k"))
    results = []
    for parts in (1, 5):
        q = Prepared(df.repartition(parts), "y")
        results.append(train.train_one(q, "dt", {"max_depth": 3}))
        q.release()
    assert results[0].metrics == results[1].metrics
    assert results[0].accuracy_crossval == results[1].accuracy_crossval


def test_signature_and_example(p):
    df = p.train.select("k", "a", "b", "c", "y")
    rows = {r["name"]: (r["type"], r["role"], r["required"]) for r in signature(df, "y", ["k"]).collect()}
    assert rows == {n: ("double", "input", True) for n in "abc"} | {"prediction": ("double", "output", True)}
    gap = df.withColumn("a", F.when(F.col("k") > 3, F.col("a")))
    assert not {r["name"]: r["required"] for r in signature(gap, "y", ["k"]).collect()}["a"]
    first = input_example(df, ["a", "b"], ["k"]).collect()
    assert [tuple(r) for r in first] == [tuple(r) for r in df.orderBy("k").select("a", "b").limit(5).collect()]


def test_from_files(spark, tmp_path):
    """The whole way from a CSV file to the pointer."""
    from plumbline.plans.run import train_file, tune_file

    path = str(tmp_path / "t.csv")
    DATA.rename(columns={"y": "diabetes"}).to_csv(path, index=False)
    result = train_file(spark, path, "dt", str(tmp_path / "one"), key_cols=["k"])
    assert result.params == DEFAULTS["dt"] and result.metrics["accuracy"] > 0.7
    grids = {n: {k: v[-1:] for k, v in SMALL[n].items()} for n in ("dt", "lr")}
    board = tune_file(spark, path, str(tmp_path / "all"), key_cols=["k"], grids=grids)
    assert [r["family"] for r in board.orderBy("ordinal").collect()] == ["lr", "dt"]
    pointer = read_pointer(spark, str(tmp_path / "all/models_tuned/best_tuned_model_run_id")).first()["run_id"]
    assert pointer == winner(board).first()["run_id"]
    with pytest.raises(KeyError):
        train_file(spark, path, "dt", str(tmp_path / "none"), label="absent")


class Killed(Exception):
    pass


def killed_after(monkeypatch, n):
    """Every write and every publishing rename counts; the one after ``n`` ends the writer."""
    from pyspark.sql import DataFrameWriter

    from plumbline.sources import sinks

    left = [n]

    def counted(f):
        def run(*args, **options):
            left[0] -= 1
            if left[0] < 0:
                raise Killed
            return f(*args, **options)

        return run

    for kind in ("parquet", "json", "csv", "text"):
        monkeypatch.setattr(DataFrameWriter, kind, counted(getattr(DataFrameWriter, kind)))
    monkeypatch.setattr(sinks, "rename_over", counted(sinks.rename_over))
    return left


def test_a_run_is_there_whole_or_not_at_all(spark, p, tmp_path, monkeypatch):
    """The writer is ended between every two of its writes; readers see whole runs and a pointer to one."""
    out = str(tmp_path)
    folder, log = f"{out}/models", RunLog(spark, f"{out}/models")
    fit = family("dt").fit(p, {"max_depth": 2})
    monkeypatch.setattr(type(family("dt")), "fit", lambda self, p, params: fit)
    first = train.train_one(p, "dt", {"max_depth": 2}, out, cross_validate=False)
    for n in range(40):
        with monkeypatch.context() as m:
            left = killed_after(m, n)
            try:
                done = train.train_one(p, "dt", {"max_depth": 2}, out, cross_validate=False)
            except Killed:
                done = None
        runs = {r["run_id"] for r in log.runs.collect()}
        values = log.values.groupBy("run_id").count().collect()
        assert {r["run_id"] for r in values} == runs and len({r["count"] for r in values}) == 1
        pointed = [r["run_id"] for r in read_pointer(spark, f"{folder}/model_run_id").collect()]
        assert len(pointed) == 1 and pointed[0] in runs
        for run in runs - {first.run_id}:
            assert spark.read.json(log.path(run, "dt_metrics")).count() == 1
            assert train.load_fit(spark, "dt", log.path(run, "dt_model")).importances() == fit.importances()
        if done:
            break
    assert n > 8 and left[0] == 0 and pointed == [done.run_id] and log.latest("dt") == done.run_id


@pytest.mark.parametrize("name", ["dt", "adaboost"])
def test_a_stopped_search_goes_on(spark, p, tmp_path, monkeypatch, name):
    """What was scored before the stop is not fitted again, and the result is that of an unbroken search."""
    want = tune.tune(p, name, SMALL[name])
    fitted = []
    real = type(family(name)).grid_scores

    def counted(self, p, candidates, fold_col):
        if stop and len(fitted) >= 1:
            raise Killed
        fitted.append([json.dumps(c, sort_keys=True) for c in candidates])
        return real(self, p, candidates, fold_col)

    monkeypatch.setattr(type(family(name)), "grid_scores", counted)
    stop = True
    with pytest.raises(Killed):
        tune.tune(p, name, SMALL[name], str(tmp_path))
    stop = False
    got = tune.tune(p, name, SMALL[name], str(tmp_path))
    every = [json.dumps(c, sort_keys=True) for c in expand_grid(SMALL[name])]
    assert sorted(c for part in fitted for c in part) == sorted(every) and len(fitted) > 1
    assert (got.params, got.accuracy_crossval, got.metrics) == (want.params, want.accuracy_crossval, want.metrics)
    before = len(fitted)
    wider = {**SMALL[name], **({"max_depth": [6, 3, 2]} if name == "dt" else {"learning_rate": [0.1, 1.0, 0.5]})}
    tune.tune(p, name, wider, str(tmp_path))
    assert sorted(c for part in fitted[before:] for c in part) == sorted(json.dumps(c, sort_keys=True) for c in expand_grid(wider) if json.dumps(c, sort_keys=True) not in every)


def test_scores_belong_to_their_rows(spark, p, tmp_path):
    other = Prepared(spark.createDataFrame(DATA.assign(a=DATA.a + (DATA.k == 7))), "y", ["k"])
    same = Prepared(spark.createDataFrame(DATA).repartition(7), "y", ["k"])
    prints = [tune.score_log(q, str(tmp_path)).fingerprint for q in (p, same, other)]
    assert prints[0] == prints[1] != prints[2]
    tune.score_log(p, str(tmp_path)).add("dt", [("{}", 0, 0.5), ("{}", 1, None)])
    assert tune.score_log(same, str(tmp_path)).finished("dt") == {("{}", 0): 0.5, ("{}", 1): None}
    assert tune.score_log(other, str(tmp_path)).finished("dt") == {} == tune.score_log(p, str(tmp_path)).finished("rf")
    for q in (other, same):
        q.release()
