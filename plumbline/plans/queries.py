"""The registered queries: every operator of the library on whole test tables."""

from __future__ import annotations

import json
from functools import lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.explain import importance_frame
from plumbline.functions.metrics import (
    confusion_counts, confusion_table, evaluate, fold_accuracy, invalid_predictions, long_form, mean_accuracy, with_quality,
    with_rates,
)
from plumbline.operators.boosting import BoostSpec, fit_boosted
from plumbline.operators.split import shuffled_folds, stratified_folds, stratified_split, with_row_key
from plumbline.plans.families import DEFAULTS, GRIDS, LONG_NAMES, family
from plumbline.plans.prepared import FOLDS, Prepared
from plumbline.plans.select import best_candidate, expand_grid, winner
from plumbline.plans.train import load_fit, metrics_frame, train_one
from plumbline.plans.tune import grid_plan, tune, tune_all
from plumbline.plans.workloads import LINEITEM_FEATURES, embeddings_labelled, events_labelled, lineitem_labelled
from plumbline.session import keep, scratch_path
from plumbline.sources.sinks import (
    RunLog, input_example, read_metrics, read_pointer, signature, write_importances, write_metrics, write_pointer,
)
from plumbline.sources.tables import assemble, class_profile, features, label_profile, labels, read_csv, read_table

KEY = ["row_key"]
RULES = [2000.0, 3000.0, 3000.0, 4000.0]  # price times discount above which a rule says 1
FAMILY_RULES = {"lr": 2500.0, "rf": 3000.0, "adaboost": 3000.0, "dt": 4000.0}
@lru_cache(maxsize=2)
def _prepared(app: str, sf_dir: str) -> Prepared:
    return Prepared(lineitem_labelled(SparkSession.active(), sf_dir), "label", KEY)


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """The lineitem workload, split and cached once per session."""
    return _prepared(spark.sparkContext.applicationId, sf_dir)


def rule(threshold):
    return (F.col("l_extendedprice") * F.col("l_discount") > threshold).cast("double")


def discount_rule():
    return (F.col("l_discount") > 0.05).cast("double")


# ---- tables ----------------------------------------------------------------------------------


def feature_projection(spark, sf_dir):
    return features(lineitem_labelled(spark, sf_dir), "label", KEY)


def label_projection(spark, sf_dir):
    return labels(lineitem_labelled(spark, sf_dir), "label")


def label_validity(spark, sf_dir):
    """What a fit would say to several columns as labels: a good one, one class, other numbers, text, NULLs."""
    t = read_table(spark, f"{sf_dir}/lineitem.parquet")
    rows = t.select(
        (F.col("l_discount") > 0.05).cast("int").alias("discounted"),
        (F.col("l_quantity") > 0).alias("sold"),
        F.col("l_linenumber"),
        F.col("l_returnflag"),
        F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "0").alias("returned"),
        (F.col("l_linenumber") % 2).cast("string").alias("odd"),
    )
    return label_profile(rows, rows.columns)


def assembled_features(spark, sf_dir):
    packed = assemble(features(lineitem_labelled(spark, sf_dir), "label", KEY), LINEITEM_FEATURES)
    values = packed.select(vector_to_array("features").alias("x"))
    return values.select([F.col("x")[i].alias(f"x{i}") for i in range(len(LINEITEM_FEATURES))])


def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table = lineitem_labelled(spark, sf_dir).withColumn("discounted", F.col("l_discount") > 0.05)
    # a tenth of the cells of one column are written as a missing-value token
    gap = F.when(F.col("l_tax") != 0.04, F.col("l_tax").cast("string")).otherwise("NA")
    table.withColumn("l_tax", gap).write.csv(path, header=True)
    return read_csv(spark, path)


def csv_with_schema(spark, sf_dir):
    """The same round trip with the types given, keys of 19 digits and line breaks inside cells."""
    path = scratch_path(spark, "csv")
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    long_key = F.lit(1_000_000_000_000_000_000).cast("bigint") + F.col("l_orderkey")
    note = F.concat(F.lit("line\n"), F.col("l_linenumber").cast("string"))
    gap = F.when(F.col("l_tax") != 0.04, F.col("l_tax").cast("string")).otherwise("n/a")
    t.select(long_key.alias("long_key"), note.alias("note"), gap.alias("l_tax")).write.csv(path, header=True)
    return read_csv(spark, path, "long_key bigint, note string, l_tax double", multi_line=True)


def parquet_folder(spark, sf_dir):
    """A Parquet folder whose name does not say so."""
    path = scratch_path(spark, "table")
    events_labelled(spark, sf_dir).write.parquet(path)
    return read_table(spark, path)


def profile(spark, sf_dir):
    return class_profile(stratified_split(events_labelled(spark, sf_dir), "label", ["event_id"]), "label")


# ---- split and folds -------------------------------------------------------------------------


def split_events(spark, sf_dir):
    return stratified_split(events_labelled(spark, sf_dir), "label", ["event_id"]).select("event_id", "split")


def folds_events(spark, sf_dir):
    return stratified_folds(events_labelled(spark, sf_dir), "label", ["event_id"]).select("event_id", "fold")


def kfold_events(spark, sf_dir):
    return shuffled_folds(events_labelled(spark, sf_dir), ["event_id"]).select("event_id", "fold")


def keyless_split(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    slim = t.select(
        F.col("l_quantity").cast("int").alias("quantity"), "l_linenumber", (F.col("l_discount") > 0.05).cast("int").alias("label")
    )
    parted = stratified_split(keep(with_row_key(slim)), "label", KEY)
    return parted.groupBy("quantity", "l_linenumber", "label", "split").agg(F.count(F.lit(1)).alias("n"))


def repeating_key_split(spark, sf_dir):
    """The key (l_orderkey, l_linenumber) repeats; the rest of the row decides between its rows."""
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    slim = t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_discount") > 0.05).cast("int").alias("label"))
    return stratified_split(slim, "label", ["l_orderkey", "l_linenumber"])


def train_folds(spark, sf_dir):
    return prepared(spark, sf_dir).df.select("row_key", "split", "cv_fold", "grid_fold")


# ---- metrics ---------------------------------------------------------------------------------


def _ruled_test(spark, sf_dir):
    return prepared(spark, sf_dir).test.withColumn("prediction", discount_rule())


def confusion_by_candidate(spark, sf_dir):
    rows = lineitem_labelled(spark, sf_dir)
    options = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(t).alias("t")) for i, t in enumerate(RULES)])
    many = rows.select("l_extendedprice", "l_discount", "label", F.explode(options).alias("c"))
    return confusion_counts(many.withColumn("prediction", rule(F.col("c.t"))).withColumn("ordinal", F.col("c.ordinal")), by=["ordinal"])


def binary_metrics(spark, sf_dir):
    return evaluate(_ruled_test(spark, sf_dir), rates=False)


def rate_metrics(spark, sf_dir):
    return with_rates(confusion_counts(_ruled_test(spark, sf_dir)))


def metrics_long(spark, sf_dir):
    return long_form(evaluate(_ruled_test(spark, sf_dir)))


def two_by_two(spark, sf_dir):
    return confusion_table(confusion_counts(_ruled_test(spark, sf_dir)))


def counted_invalid(spark, sf_dir):
    """Predictions of which some are missing and some are no class, per line number."""
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    said = F.when(F.col("l_quantity") == 1, None).when(F.col("l_quantity") == 2, float("nan")).when(F.col("l_quantity") <= 4, 0.9)
    rows = t.select("l_linenumber", (F.col("l_discount") > 0.05).cast("int").alias("label"), F.coalesce(said, F.when(F.col("l_quantity") > 1, 1.0)).alias("prediction"))
    return invalid_predictions(rows, by=["l_linenumber"])


def cv_mean_accuracy(spark, sf_dir):
    rows = prepared(spark, sf_dir).train.withColumn("prediction", discount_rule())
    return mean_accuracy(fold_accuracy(rows, fold="cv_fold"))


# ---- selection -------------------------------------------------------------------------------


def rule_means(spark, sf_dir):
    rows = prepared(spark, sf_dir).train
    options = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(t).alias("t")) for i, t in enumerate(RULES)])
    many = rows.withColumn("c", F.explode(options)).withColumn("ordinal", F.col("c.ordinal"))
    scores = fold_accuracy(many.withColumn("prediction", rule(F.col("c.t"))), fold="grid_fold", by=["ordinal"])
    return mean_accuracy(scores, ["ordinal"])


def best_rule(spark, sf_dir):
    return best_candidate(rule_means(spark, sf_dir))


def rule_board(spark, sf_dir):
    rows = prepared(spark, sf_dir).test
    options = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(LONG_NAMES[f]).alias("family"), F.lit(t).alias("t"))
            for i, (f, t) in enumerate(FAMILY_RULES.items())
        ]
    )
    many = rows.withColumn("c", F.explode(options)).select("label", rule(F.col("c.t")).alias("prediction"), "c.ordinal", "c.family")
    return with_quality(confusion_counts(many, by=["ordinal", "family"]))


def leaderboard_winner(spark, sf_dir):
    return winner(rule_board(spark, sf_dir)).select("ordinal", "family", "accuracy", "precision", "recall")


def plan_of(name):
    return lambda spark, sf_dir: grid_plan(prepared(spark, sf_dir), name, expand_grid(GRIDS[name]))


# ---- bins and boosting -----------------------------------------------------------------------


def feature_bins(spark, sf_dir):
    bins = prepared(spark, sf_dir).bins
    rows = [(f, i, e) for f, edges in zip(bins.features, bins.edges) for i, e in enumerate(edges)]
    return spark.createDataFrame(rows, "feature string, position int, edge double")


def binned_histogram(spark, sf_dir):
    p = prepared(spark, sf_dir)
    bins = p.binned.select("label", F.posexplode(vector_to_array("bins")).alias("feature", "bin"))
    return bins.groupBy("feature", F.col("bin").cast("int").alias("bin"), "label").agg(F.count(F.lit(1)).alias("n"))


def stump_split(spark, sf_dir):
    p = prepared(spark, sf_dir)
    specs = [BoostSpec(1, without_fold=k) for k in (None, *range(FOLDS))]
    fits, _ = fit_boosted(p.cells("cv_fold"), p.features, specs, p.edges)
    rows = [
        (k - 1, int(t.feature[0]), round(float(t.cut[0]), 9), int(t.vote[1]), int(t.vote[2]), round(f.errors[0], 6))
        for k, f in enumerate(fits)
        for t in f.trees[:1]
    ]
    return spark.createDataFrame(rows, "fit int, feature int, cut double, left_vote int, right_vote int, error double")


def _boosted(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return family("adaboost").fit(p, DEFAULTS["adaboost"])


def samme_rounds(spark, sf_dir):
    fit = _boosted(spark, sf_dir)
    rows = [
        (r, int(t.feature[0]), round(float(t.cut[0]), 9), int(t.vote[1]), int(t.vote[2]), round(e, 6), round(a, 6))
        for r, (t, a, e) in enumerate(zip(fit.trees, fit.alphas, fit.errors), start=1)
    ]
    schema = "round int, feature int, cut double, left_vote int, right_vote int, error double, alpha double"
    return spark.createDataFrame(rows, schema)


def samme_r_rounds(spark, sf_dir):
    """The real-valued algorithm: the log-odds of both leaves of every stump."""
    fit = family("adaboost").fit(prepared(spark, sf_dir), {**DEFAULTS["adaboost"], "algorithm": "SAMME.R"})
    rows = [
        (r, int(t.feature[0]), round(float(t.cut[0]), 9), round(float(t.odds[1]), 6), round(float(t.odds[2]), 6), round(e, 6))
        for r, (t, e) in enumerate(zip(fit.trees, fit.errors), start=1)
    ]
    return spark.createDataFrame(rows, "round int, feature int, cut double, left_odds double, right_odds double, error double")


def _ranked(importances: DataFrame, digits: int) -> DataFrame:
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # one row per feature
    return importances.select("feature", F.round("importance", digits).alias("importance"), place.alias("place"))


def importance_adaboost(spark, sf_dir):
    return _ranked(importance_frame(spark, _boosted(spark, sf_dir).importances()), 6)


def importance_lr(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return _ranked(importance_frame(spark, family("lr").fit(p, {}).importances()), 7)


def importance_of_tree(name, params):
    def run(spark, sf_dir):
        p = prepared(spark, sf_dir)
        return _ranked(importance_frame(spark, family(name).fit(p, params).importances()), 9)

    return run


# ---- training and tuning ---------------------------------------------------------------------


def trained(name, params=None, cross_validate=True):
    def run(spark, sf_dir):
        result = train_one(prepared(spark, sf_dir), name, params, cross_validate=cross_validate)
        frame = metrics_frame(spark, result.metrics)
        return frame.withColumn("accuracy_crossval", F.lit(result.accuracy_crossval)) if cross_validate else frame

    return run


def predicted(name, params):
    def run(spark, sf_dir):
        p = prepared(spark, sf_dir)
        return family(name).fit(p, params).predict(p.test).select("row_key", F.col("prediction").cast("int").alias("prediction"))

    return run


def tuned(name):
    def run(spark, sf_dir):
        result = tune(prepared(spark, sf_dir), name)
        frame = metrics_frame(spark, result.metrics)
        best = json.dumps(result.params, sort_keys=True)
        return frame.withColumn("accuracy_crossval", F.lit(result.accuracy_crossval)).withColumn("params", F.lit(best))

    return run


def all_tuned(spark, sf_dir):
    board, _ = tune_all(prepared(spark, sf_dir))
    return board.drop("run_id")


def wide_lr(spark, sf_dir):
    """64 float features, weak signal."""
    p = Prepared(embeddings_labelled(spark, sf_dir), "label", ["vec_id"])
    result = train_one(p, "lr", {"C": 1.0, "max_iter": 100})
    p.release()
    return metrics_frame(spark, result.metrics).withColumn("accuracy_crossval", F.lit(result.accuracy_crossval))


# ---- sinks -----------------------------------------------------------------------------------


def model_round_trip(spark, sf_dir):
    p = prepared(spark, sf_dir)
    parts = None
    for name, params in DEFAULTS.items():
        fit, path = family(name).fit(p, params), scratch_path(spark, f"model-{name}")
        fit.save(path)
        before = fit.predict(p.test).select(*KEY, F.col("prediction").alias("was"))
        after = load_fit(spark, name, path).predict(p.test).select(*KEY, F.col("prediction").alias("now"))
        part = before.join(after, KEY).agg(
            F.lit(name).alias("family"),
            F.count(F.lit(1)).alias("n_rows"),
            F.coalesce(F.sum((F.col("was") != F.col("now")).cast("bigint")), F.lit(0)).alias("changed"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def metrics_sink(spark, sf_dir):
    path, metrics = scratch_path(spark, "metrics"), evaluate(_ruled_test(spark, sf_dir))
    write_metrics(metrics, path)
    return read_metrics(spark, path, metrics.schema)


def importance_sink(spark, sf_dir):
    path = scratch_path(spark, "importance")
    write_importances(importance_adaboost(spark, sf_dir).drop("place"), path)
    return spark.read.csv(path, header=True, schema="feature string, importance double")


def run_log(spark, sf_dir):
    p, path = prepared(spark, sf_dir), scratch_path(spark, "runs")
    log = RunLog(spark, path)
    for name, threshold in FAMILY_RULES.items():
        metrics = with_quality(confusion_counts(p.test.withColumn("prediction", rule(threshold)))).first().asDict()
        log.record(f"{name}_tuned_run_ci", name, {"threshold": threshold}, metrics)
    joined = log.runs.join(log.values, "run_id")
    return joined.select("run_name", "family", "kind", "name", "value_str", "value_num")


def signature_of_events(spark, sf_dir):
    return signature(events_labelled(spark, sf_dir), "label", ["event_id"])


def first_rows(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return input_example(p.train, p.features, p.key_cols)


def winner_pointer(spark, sf_dir):
    path, best = scratch_path(spark, "pointer"), leaderboard_winner(spark, sf_dir).first()
    write_pointer(spark, best["family"], path)
    return read_pointer(spark, path)


QUERIES = {
    "feature_projection": feature_projection,
    "label_projection": label_projection,
    "label_validity": label_validity,
    "assembled_features": assembled_features,
    "csv_round_trip": csv_round_trip,
    "csv_with_schema": csv_with_schema,
    "parquet_folder": parquet_folder,
    "class_profile": profile,
    "stratified_split": split_events,
    "stratified_folds": folds_events,
    "kfold_shuffled": kfold_events,
    "keyless_split": keyless_split,
    "repeating_key_split": repeating_key_split,
    "train_folds": train_folds,
    "confusion_counts": confusion_by_candidate,
    "binary_metrics": binary_metrics,
    "rate_metrics": rate_metrics,
    "metrics_long": metrics_long,
    "confusion_table": two_by_two,
    "invalid_predictions": counted_invalid,
    "cv_mean_accuracy": cv_mean_accuracy,
    "best_candidate": best_rule,
    "leaderboard_winner": leaderboard_winner,
    "grid_lr": plan_of("lr"),
    "grid_rf": plan_of("rf"),
    "grid_adaboost": plan_of("adaboost"),
    "grid_dt": plan_of("dt"),
    "feature_bins": feature_bins,
    "binned_histogram": binned_histogram,
    "stump_split": stump_split,
    "samme_rounds": samme_rounds,
    "samme_r_rounds": samme_r_rounds,
    "importance_adaboost": importance_adaboost,
    "importance_lr": importance_lr,
    "importance_dt": importance_of_tree("dt", DEFAULTS["dt"]),
    "importance_rf": importance_of_tree("rf", DEFAULTS["rf"]),
    "train_lr": trained("lr", DEFAULTS["lr"]),
    "train_lr_wide": wide_lr,
    "train_dt": trained("dt", DEFAULTS["dt"]),
    "train_adaboost": trained("adaboost", DEFAULTS["adaboost"]),
    "train_rf": trained("rf", DEFAULTS["rf"]),
    "predict_lr": predicted("lr", DEFAULTS["lr"]),
    "predict_rf": predicted("rf", DEFAULTS["rf"]),
    "predict_dt": predicted("dt", DEFAULTS["dt"]),
    "predict_dt_pruned": predicted("dt", {**DEFAULTS["dt"], "min_samples_split": 500}),
    "predict_adaboost": predicted("adaboost", DEFAULTS["adaboost"]),
    "predict_samme_r": predicted("adaboost", {**DEFAULTS["adaboost"], "algorithm": "SAMME.R"}),
    "train_samme_r": trained("adaboost", {**DEFAULTS["adaboost"], "algorithm": "SAMME.R"}),
    "tune_lr": tuned("lr"),
    "tune_rf": tuned("rf"),
    "tune_adaboost": tuned("adaboost"),
    "tune_dt": tuned("dt"),
    "tune_all": all_tuned,
    "model_round_trip": model_round_trip,
    "metrics_sink": metrics_sink,
    "importance_sink": importance_sink,
    "run_log": run_log,
    "signature": signature_of_events,
    "input_example": first_rows,
    "winner_pointer": winner_pointer,
}
