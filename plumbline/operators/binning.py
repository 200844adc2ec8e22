"""Exact quantile bins for tree training.

A bin edge is an order statistic of the training rows, so it depends on the rows alone and not on
how they are laid out. The order statistics come from repeated counting: every pass splits the
value range that holds a wanted position into slices, counts the slices of all features in
one job, and keeps the slice that holds the position together with the least and greatest value
actually seen in it. A slice with one value is an answer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import keep

MAX_BINS = 256  # a feature with no more values keeps every threshold between them
MOST_BINS = 32_767  # bin numbers are 16-bit
SLICES = 1024


@dataclass(frozen=True)
class Bins:
    """Ascending lower edges per feature; the bin of a value is the number of edges it reaches."""

    features: list[str]
    edges: list[list[float]]

    @property
    def counts(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    def columns(self) -> list[str]:
        return [f"__bin_{i}" for i in range(len(self.features))]

    def bucketizer(self) -> Bucketizer:
        return Bucketizer(
            inputCols=list(self.features),
            outputCols=self.columns(),
            splitsArray=[[-math.inf, *e, math.inf] for e in self.edges],
            handleInvalid="error",
        )

    def assembler(self) -> VectorAssembler:
        return VectorAssembler(inputCols=self.columns(), outputCol="bins", handleInvalid="error")

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the vector ``bins`` of bin numbers."""
        packed = self.assembler().transform(self.bucketizer().transform(df)).drop(*self.columns())
        # without the column metadata a tree takes bin numbers as ordered values, not as categories
        return packed.withColumn("bins", F.col("bins").alias("bins", metadata={}))


def exact_bins(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> Bins:
    """Bin edges of every feature: at most ``max_bins`` bins of equal size.

    A feature with no more than ``max_bins`` distinct values gets one bin per value. A missing or
    infinite value is an error.
    """
    names = list(features)
    if not 2 <= max_bins <= MOST_BINS:
        raise ValueError(f"max_bins must be between 2 and {MOST_BINS}")
    low, high, n = _ranges(df, names)
    if n == 0:
        raise ValueError("no rows to take bin edges from")
    moving = [i for i in range(len(names)) if low[i] < high[i]]
    edges = {i: [low[i]] for i in range(len(names)) if i not in moving}
    if moving:
        values = df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in names])).alias("f", "v"))
        sliced = values.where(F.col("f").isin(moving)).select(
            "f", "v", F.lit(0).alias("range"), _slice(F.col("v"), _pick(low), _pick(high), False).alias("slice")
        )
        counted = keep(_counted(sliced))  # at most SLICES rows per feature
        edges |= _small(sliced, counted, max_bins)
        large = [i for i in moving if i not in edges]
        targets = [(i, 0, t) for i in large for t in sorted({n * j // max_bins for j in range(1, max_bins)})]
        found = _order_statistics(sliced, counted, targets)
        counted.unpersist()
        for i in large:
            edges[i] = sorted(found[i] - {low[i]}) or [high[i]]
    return Bins(names, [edges[i] for i in range(len(names))])


def _ranges(df: DataFrame, names: list[str]):
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(names):
        v = F.col(f"`{c}`").cast("double")
        usable = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)
        aggregates += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.count(F.when(usable, 1)).alias(f"ok{i}")]
    row = df.agg(*aggregates).first()
    bad = [c for i, c in enumerate(names) if row[f"ok{i}"] != row["n"]]
    if bad:
        raise ValueError(f"missing or infinite values in features: {', '.join(bad)}")
    return [row[f"lo{i}"] for i in range(len(names))], [row[f"hi{i}"] for i in range(len(names))], row["n"]


def _pick(numbers: list[float]):
    return F.element_at(F.array(*[F.lit(float(x)) for x in numbers]), F.col("f") + 1)


def _slice(v, low, high, by_magnitude: bool):
    """Number of the slice of [low, high] that holds v; low is in the first, high in the last slice.

    Slices are equally wide in the value (halves keep the width finite) or in its magnitude.
    """
    share = (v * 0.5 - low * 0.5) / F.nullif(high * 0.5 - low * 0.5, F.lit(0.0))
    if by_magnitude:
        width = F.nullif(_magnitude(high) - _magnitude(low), F.lit(0.0))
        share = F.coalesce((_magnitude(v) - _magnitude(low)) / width, share)
    return F.coalesce(F.least(F.floor(share * SLICES), F.lit(SLICES - 1)), F.lit(0)).cast("int")


def _magnitude(v):
    """Ascending in v: the binary logarithm with the sign of v, lifted above that of any double."""
    return F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log2(F.abs(v)) + 1100))


def _counted(sliced: DataFrame) -> DataFrame:
    return sliced.groupBy("f", "range", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )


def _small(sliced: DataFrame, counted: DataFrame, max_bins: int) -> dict[int, list[float]]:
    """Edges of the features that have at most ``max_bins`` distinct values."""
    shape = counted.groupBy("f").agg(
        F.count(F.lit(1)).alias("filled"),
        F.max((F.col("lo") < F.col("hi")).cast("int")).alias("mixed"),
        F.sort_array(F.collect_list("lo")).alias("values"),  # at most SLICES numbers
    )
    rows = shape.where(F.col("filled") <= max_bins).collect()
    small = {r["f"]: r["values"][1:] for r in rows if not r["mixed"]}
    unclear = [r["f"] for r in rows if r["mixed"]]
    if unclear:  # few slices, some with several values: an outlier may hold many values in one slice
        rough = sliced.where(F.col("f").isin(unclear)).groupBy("f").agg(F.approx_count_distinct("v", 0.02).alias("about"))
        unclear = [r["f"] for r in rough.collect() if r["about"] <= 2 * max_bins]
    if unclear:  # about as many values as bins, so the values themselves are few
        distinct = sliced.where(F.col("f").isin(unclear)).select("f", "v").distinct()
        sizes = {r["f"]: r["count"] for r in distinct.groupBy("f").count().collect()}
        few = [f for f in unclear if sizes[f] <= max_bins]
        listed = distinct.where(F.col("f").isin(few)).collect() if few else []
        for f in few:
            small[f] = sorted(r["v"] for r in listed if r["f"] == f)[1:]
    return small


def _order_statistics(sliced: DataFrame, counted: DataFrame, targets) -> dict[int, set[float]]:
    """The values at 0-based positions; ``targets`` are (feature, range, position in the range)."""
    spark = sliced.sparkSession
    found: dict[int, set[float]] = {}
    running = Window.partitionBy("f", "range").orderBy("slice")
    by_magnitude = True  # passes take turns, so neither outliers nor many orders of magnitude stall
    while targets:
        goals = spark.createDataFrame(targets, "f int, range int, t bigint")
        inside = (F.col("t") < F.col("upto")) & (F.col("t") >= F.col("upto") - F.col("n"))
        hits = (
            counted.withColumn("upto", F.sum("n").over(running))
            .join(F.broadcast(goals), ["f", "range"])  # under max_bins rows per feature
            .where(inside)
            .select("f", "range", "slice", "lo", "hi", (F.col("t") - F.col("upto") + F.col("n")).alias("t"))
            .collect()
        )
        for r in hits:
            if r["lo"] == r["hi"]:
                found.setdefault(r["f"], set()).add(r["lo"])
        open_hits = [r for r in hits if r["lo"] < r["hi"]]
        ids: dict[tuple, int] = {}
        for r in open_hits:
            ids.setdefault((r["f"], r["range"], r["slice"], r["lo"], r["hi"]), len(ids))
        targets = [(r["f"], ids[r["f"], r["range"], r["slice"], r["lo"], r["hi"]], r["t"]) for r in open_hits]
        if targets:
            narrowed = spark.createDataFrame(
                [(*k, i) for k, i in ids.items()], "f int, range int, slice int, lo double, hi double, next int"
            )
            sliced = sliced.join(F.broadcast(narrowed), ["f", "range", "slice"]).select(
                "f", "v", F.col("next").alias("range"), _slice(F.col("v"), F.col("lo"), F.col("hi"), by_magnitude).alias("slice")
            )
            by_magnitude = not by_magnitude
            counted = _counted(sliced)
    return found


def binned_array(df: DataFrame, bins: Bins) -> DataFrame:
    """Add the bin numbers as the array ``bins``."""
    missing = F.raise_error(F.lit("missing value in a feature")).cast("smallint")
    packed = F.array(*[F.coalesce(F.col(c).cast("smallint"), missing) for c in bins.columns()])
    return bins.bucketizer().transform(df).withColumn("bins", packed).drop(*bins.columns())
