"""The families as Spark ML stages: pipelines, cross-validation, saving."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from plumbline.plans.families import family
from plumbline.plans.stages import BoostedClassifier, ClassifierModel, ForestClassifier, LogisticClassifier, Rows, TreeClassifier

RNG = np.random.default_rng(3)
N = 900
DATA = pd.DataFrame({"k": np.arange(N), "a": RNG.random(N), "b": RNG.integers(0, 6, N)})
DATA["y"] = ((DATA.a * 5 + DATA.b > 5) ^ (RNG.random(N) < 0.1)).astype(int)
NAMES = ["a", "b"]
STAGES = {
    "lr": (LogisticClassifier, {"C": 0.5}),
    "dt": (TreeClassifier, {"max_depth": 4, "criterion": "entropy"}),
    "rf": (ForestClassifier, {"n_estimators": 4, "max_depth": 5, "keyCols": ["k"]}),
    "adaboost": (BoostedClassifier, {"n_estimators": 4, "algorithm": "SAMME.R"}),
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(DATA).repartition(4).cache()


def answers(df, column="prediction"):
    return {r["k"]: r[column] for r in df.select("k", column).collect()}


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_is_the_family(table, name):
    kind, params = STAGES[name]
    model = kind(inputCols=NAMES, labelCol="y", **params).fit(table)
    rows = Rows(table.select("k", *NAMES, "y"), NAMES, "y", ["k"], kind(inputCols=NAMES).getSeed())
    own = family(name).fit(rows, {k: v for k, v in params.items() if k != "keyCols"})
    rows.release()
    assert answers(model.transform(table)) == answers(own.predict(table))
    assert model.importances == pytest.approx(own.importances())
    shown = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy").evaluate(model.transform(table))
    assert shown > 0.75


@pytest.mark.parametrize("name", list(STAGES))
def test_saved_pipelines_score_alike(spark, table, tmp_path, name):
    kind, params = STAGES[name]
    doubled = SQLTransformer(statement="SELECT *, a * 2 AS a2 FROM __THIS__")
    estimator = Pipeline(stages=[doubled, kind(inputCols=["a2", "b"], labelCol="y", predictionCol="said", **params)])
    estimator.write().save(f"{tmp_path}/estimator")
    again = Pipeline.load(f"{tmp_path}/estimator")
    model = again.fit(table)
    model.write().save(f"{tmp_path}/model")
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert answers(loaded.transform(table), "said") == answers(estimator.fit(table).transform(table), "said")
    assert isinstance(loaded.stages[1], ClassifierModel) and loaded.stages[1].family == name
    assert answers(loaded.stages[1].copy().transform(doubled.transform(table)), "said") == answers(model.transform(table), "said")


def test_fresh_session_loads_a_pipeline(table, tmp_path):
    model = Pipeline(stages=[TreeClassifier(inputCols=NAMES, labelCol="y", max_depth=3)]).fit(table)
    model.write().save(f"{tmp_path}/model")
    table.select("k", *NAMES).write.parquet(f"{tmp_path}/rows")
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pyspark.ml import PipelineModel
rows = PipelineModel.load("{tmp_path}/model").transform(spark.read.parquet("{tmp_path}/rows"))
print("SUM", rows.selectExpr("sum(k * prediction)").first()[0])
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(Path(__file__).parent.parent)}, capture_output=True, text=True, timeout=200)
    want = sum(k * p for k, p in answers(model.transform(table)).items())
    assert f"SUM {want}" in run.stdout, run.stderr[-2000:]


def test_cross_validation_with_given_folds(table):
    """Each fold's score is that of a fit on the other folds."""
    folds = table.withColumn("fold", (F.col("k") % 3).cast("int"))
    tree = TreeClassifier(inputCols=NAMES, labelCol="y", min_samples_leaf=3)
    grid = ParamGridBuilder().addGrid(tree.max_depth, [1, 5]).build()
    judge = MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
    found = CrossValidator(estimator=tree, estimatorParamMaps=grid, evaluator=judge, numFolds=3, foldCol="fold").fit(folds)
    for params, mean in zip(grid, found.avgMetrics):
        alone = [judge.evaluate(tree.fit(folds.where(F.col("fold") != k), params).transform(folds.where(F.col("fold") == k))) for k in range(3)]
        assert mean == pytest.approx(np.mean(alone))
    assert found.bestModel.importances


def test_unusable_tables_are_refused(spark, table):
    with pytest.raises(ValueError):
        TreeClassifier(inputCols=NAMES, labelCol="y").fit(table.withColumn("y", F.col("y") + 1))
    with pytest.raises(ValueError, match="prediction"):
        TreeClassifier(inputCols=NAMES, labelCol="y", predictionCol="said", max_depth=1).fit(table).transform(table.withColumn("prediction", F.lit(1)))
    with pytest.raises(TypeError):
        TreeClassifier(inputCols=NAMES, C=1.0)
