"""Feature importances as a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def importance_frame(spark: SparkSession, importances: Mapping[str, float]) -> DataFrame:
    """(feature, importance), largest first by signed value, equal values by name."""
    return sort_importances(spark.createDataFrame(list(importances.items()), "feature string, importance double"))


def sort_importances(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("importance"), "feature")
