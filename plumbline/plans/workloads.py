"""Labelled tables made from the star-schema test tables; the library itself knows none of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_key, four features, label): a rule on price and discount, flipped on about 5% of rows."""
    t = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    key = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)
    rule = F.col("l_extendedprice") * F.col("l_discount") > 3000
    flip = F.substring(F.md5(F.concat(F.lit("noise:"), key)), 1, 2) < "0d"
    return t.select(key.alias("row_key"), *LINEITEM_FEATURES, (rule != flip).cast("int").alias("label"))


def events_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value, label): is the event a purchase."""
    t = spark.read.parquet(f"{sf_dir}/events.parquet")
    return t.select("event_id", "value", (F.col("event_type") == "purchase").cast("int").alias("label"))


def embeddings_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, e0, e1, ..., label): is the class number below 5. All embeddings must be equally long."""
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    widths = [r["n"] for r in t.select(F.size("embedding").alias("n")).distinct().limit(2).collect()]
    if len(widths) != 1:
        raise ValueError(f"embeddings of one length are needed, found {widths}")
    wide = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(widths[0])]
    return t.select("vec_id", *wide, (F.col("label") < 5).cast("int").alias("label"))
