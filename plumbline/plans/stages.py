"""The four families as Spark ML stages, for pipelines, cross-validation and Spark's own evaluators.

An estimator reads named numeric columns (``inputCols``) and a 0/1 ``labelCol``; its model adds
``predictionCol``. Both are written and read like any other stage, alone or inside a pipeline.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.plans.families import PARAM_TYPES, family
from plumbline.plans.prepared import Prepared
from plumbline.plans.train import load_fit
from plumbline.session import SEED, keep, spread
from plumbline.sources.tables import check_labels, feature_columns, labelled


class Rows(Prepared):
    """All rows of a table as training rows of one fit: nothing is split off, there are no folds."""

    def __init__(self, df: DataFrame, features: list[str], label: str, key_cols: list[str], seed: int):
        check_labels(df, label)
        self.label, self.key_cols, self.seed = label, key_cols, seed
        self.features = feature_columns(df.select(*features, *key_cols, label), label, key_cols)
        source = spread(labelled(df.select(*features, *key_cols, label), label, key_cols), *key_cols)
        parts = {"split": F.lit("train"), "cv_fold": F.lit(0), "grid_fold": F.lit(0)}
        self.df = keep(source.withColumns(parts))
        self._sizes = []


class _Columns(HasInputCols, HasLabelCol, HasPredictionCol):
    """Columns that an estimator and its model share."""

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")


class _Classifier(Estimator, _Columns, HasSeed, DefaultParamsWritable, MLReadable):
    """An estimator of one family. ``keyCols`` name a row for the draws of a forest's bootstraps; without them
    equal rows are drawn alike."""

    family = ""
    keyCols = Param(Params._dummy(), "keyCols", "columns that name a row", TypeConverters.toListString)

    def __init__(self, **given):
        super().__init__()
        self._setDefault(seed=SEED, keyCols=[])
        self._set(**given)

    def settings(self) -> dict:
        """The family's parameters that are set."""
        return {n: self.getOrDefault(n) for n in PARAM_TYPES[self.family] if self.hasParam(n) and self.isSet(n)}

    def _fit(self, dataset: DataFrame) -> "ClassifierModel":
        features, key = list(self.getInputCols()), list(self.getOrDefault(self.keyCols))
        if not key:  # the values name the row
            key = [f"{f}__key" for f in features]
            dataset = dataset.withColumns({k: F.col(f"`{f}`") for k, f in zip(key, features)})
        rows = Rows(dataset, features, self.getLabelCol(), key, self.getSeed())
        try:
            fit = family(self.family).fit(rows, self.settings())
        finally:
            rows.release()
        return ClassifierModel(self.family, fit)._carry(self)

    @classmethod
    def read(cls):
        return DefaultParamsReader(cls)


def _settable(name: str, kind: str) -> Param:
    to = {"int": TypeConverters.toInt, "double": TypeConverters.toFloat, "string": TypeConverters.toString}[kind]
    return Param(Params._dummy(), name, f"{name} of the family", to)


class LogisticClassifier(_Classifier):
    """Logistic regression with an inverse-strength penalty."""

    family = "lr"
    C, penalty, solver, max_iter = (_settable(n, PARAM_TYPES["lr"][n]) for n in ("C", "penalty", "solver", "max_iter"))

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, predictionCol=None, C=None, penalty=None, solver=None, max_iter=None):
        super().__init__(**self._input_kwargs)


class TreeClassifier(_Classifier):
    """An exact decision tree."""

    family = "dt"
    criterion, max_depth, min_samples_split, min_samples_leaf = (
        _settable(n, PARAM_TYPES["dt"][n]) for n in ("criterion", "max_depth", "min_samples_split", "min_samples_leaf")
    )

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, predictionCol=None, seed=None, criterion=None, max_depth=None, min_samples_split=None, min_samples_leaf=None):
        super().__init__(**self._input_kwargs)


class ForestClassifier(_Classifier):
    """A random forest of exact trees."""

    family = "rf"
    n_estimators, max_depth, min_samples_split, min_samples_leaf, max_features = (
        _settable(n, PARAM_TYPES["rf"][n]) for n in ("n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features")
    )

    @keyword_only
    def __init__(
        self, *, inputCols=None, labelCol=None, predictionCol=None, keyCols=None, seed=None,
        n_estimators=None, max_depth=None, min_samples_split=None, min_samples_leaf=None, max_features=None,
    ):
        super().__init__(**self._input_kwargs)


class BoostedClassifier(_Classifier):
    """AdaBoost over small exact trees."""

    family = "adaboost"
    n_estimators, learning_rate, base_max_depth, algorithm = (
        _settable(n, PARAM_TYPES["adaboost"][n]) for n in ("n_estimators", "learning_rate", "base_max_depth", "algorithm")
    )

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, predictionCol=None, n_estimators=None, learning_rate=None, base_max_depth=None, algorithm=None):
        super().__init__(**self._input_kwargs)


class ClassifierModel(Model, _Columns, MLWritable, MLReadable):
    """A fitted classifier of any family."""

    def __init__(self, name: str = "", fit=None):
        super().__init__()
        self.family, self.fitted = name, fit

    def _carry(self, estimator: _Classifier) -> "ClassifierModel":
        self._resetUid(estimator.uid)
        for p in (estimator.inputCols, estimator.labelCol, estimator.predictionCol):
            if estimator.isDefined(p):
                self._set(**{p.name: estimator.getOrDefault(p)})
        return self

    @property
    def importances(self) -> dict[str, float]:
        return self.fitted.importances()

    def copy(self, extra=None) -> "ClassifierModel":
        out = super().copy(extra)
        out.family, out.fitted = self.family, self.fitted
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name = self.getPredictionCol()
        if "prediction" in dataset.columns and name != "prediction":
            raise ValueError("the table has a column named 'prediction' that the model would overwrite")
        return self.fitted.predict(dataset).withColumnRenamed("prediction", name)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, model: ClassifierModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"family": self.model.family})
        self.model.fitted.save(f"{path}/fit")


class _ModelReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> ClassifierModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(metadata["family"], load_fit(self.sparkSession, metadata["family"], f"{path}/fit"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model

