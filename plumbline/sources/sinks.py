"""Where results go: metrics, importances, models, the run log and the pointer to the winner."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import drop_path

MANIFEST = (
    "run_id string, run_name string, family string, stem string, started_at timestamp, "
    "values array<struct<kind:string,name:string,value_str:string,value_num:double>>"
)
SCORES = "fingerprint string, family string, params string, fold int, accuracy double"


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON object per row; counts stay integers, ratios doubles."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_importances(importances: DataFrame, path: str) -> None:
    """CSV with a header, in the order given; one row per feature."""
    importances.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_pointer(spark: SparkSession, run_id: str, path: str) -> None:
    """A text file that holds nothing but the id of the winning run; it is there whole, old or new."""
    publish_text(spark, [run_id], path)


def read_pointer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "run_id")


def signature(df: DataFrame, label: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """(name, type, role, required): the columns a model reads and the one it writes.

    A column is required when no row of the table misses it.
    """
    fields = [f for f in df.schema.fields if f.name not in key_cols and f.name != label]
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
            F.lit("input").alias("role"), (F.col(f"c{i}") == F.col("n")).alias("required"),
        )
        for i, f in enumerate(fields)
    ]
    rows.append(
        F.struct(
            F.lit("prediction").alias("name"), F.lit("double").alias("type"),
            F.lit("output").alias("role"), F.lit(True).alias("required"),
        )
    )
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def input_example(train: DataFrame, features: Sequence[str], key_cols: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by key."""
    return train.orderBy(*key_cols).limit(n).select(*features)


class RunLog:
    """Runs under one folder: their artifacts in ``runs/<id>``, and a manifest of each in ``manifests``.

    A manifest is written aside and appears by one rename, after everything else, so a run is there whole or
    not at all, however its writer ends. Several writers may share the folder.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def new_run(self) -> str:
        """An id; what is written to its paths stays unseen until the run is published."""
        return uuid.uuid4().hex

    def path(self, run_id: str, artifact: str) -> str:
        return f"{self.root}/runs/{run_id}/{artifact}"

    def record(
        self,
        run_name: str,
        family: str,
        params: Mapping[str, object],
        metrics: Mapping[str, float],
        importances: Mapping[str, float] | None = None,
        run_id: str | None = None,
        stem: str | None = None,
    ) -> str:
        """Publish a run and return its id. Importances are parameters named after their feature; ``stem``
        names the series of runs of which ``latest`` finds the newest."""
        run_id = run_id or self.new_run()
        values = [("param", k, None if v is None else str(v), _number(v)) for k, v in params.items()]
        values += [("metric", k, None, float(v)) for k, v in metrics.items()]
        values += [("importance", f"importance_{k}", None, float(v)) for k, v in (importances or {}).items()]
        manifest = {
            "run_id": run_id, "run_name": run_name, "family": family, "stem": stem, "started_at": datetime.now(timezone.utc).isoformat(),
            "values": [dict(zip(("kind", "name", "value_str", "value_num"), v)) for v in values],
        }
        publish_text(self.spark, [json.dumps(manifest)], f"{self.root}/manifests/{run_id}.json")
        return run_id

    @property
    def published(self) -> DataFrame:
        folder = f"{self.root}/manifests"
        if not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(folder)

    @property
    def runs(self) -> DataFrame:
        return self.published.select("run_id", "run_name", "family", "started_at")

    @property
    def values(self) -> DataFrame:
        return self.published.select("run_id", F.explode("values").alias("v")).select("run_id", "v.*")

    def latest(self, stem: str) -> str | None:
        """The id of the newest published run of a series."""
        row = self.published.where(F.col("stem") == stem).orderBy(F.desc("started_at"), "run_id").first()
        return row["run_id"] if row else None


class ScoreLog:
    """Fold scores of finished fits, so that a search that was stopped goes on where it ended.

    Rows appear by one rename per batch. They belong to a fingerprint of the training rows and the method;
    under any other fingerprint they are not found.
    """

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint

    def add(self, family: str, scores: Sequence[tuple[str, int, float | None]]) -> None:
        """(parameters as JSON, fold, accuracy) of finished fits."""
        lines = [json.dumps({"fingerprint": self.fingerprint, "family": family, "params": p, "fold": k, "accuracy": a}) for p, k, a in scores]
        publish_text(self.spark, lines, f"{self.folder}/{uuid.uuid4().hex}.json")

    def finished(self, family: str) -> dict[tuple[str, int], float | None]:
        """Accuracy by (parameters, fold)."""
        if not path_exists(self.spark, self.folder):
            return {}
        rows = self.spark.read.schema(SCORES).json(self.folder)
        mine = rows.where((F.col("fingerprint") == self.fingerprint) & (F.col("family") == family))
        return {(r["params"], r["fold"]): r["accuracy"] for r in mine.select("params", "fold", "accuracy").distinct().collect()}


def publish_text(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    """A text file that appears, or replaces an older one, by a single rename."""
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/_staging/{uuid.uuid4().hex}"
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(aside)
    part = next(f for f in _files(spark, aside) if f.rsplit("/", 1)[1].startswith("part-"))
    rename_over(spark, part, f"{folder}/{name}")
    drop_path(spark, aside)


def rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in one step also where ``target`` exists."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(fs.Path(target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.Path(source), fs.Path(target), how)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _files(spark: SparkSession, folder: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [s.getPath().toString() for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]


def _number(value: object) -> float | None:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
