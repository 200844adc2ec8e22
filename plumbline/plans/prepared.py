"""A labelled table made ready for fitting: split, folded and cached once, binned when a tree asks."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.binning import MAX_BINS, Bins, exact_bins
from plumbline.operators.ranking import key_text
from plumbline.operators.split import split_with_folds, with_row_key
from plumbline.operators.trees import HELD_OUT, Grower, cells, values
from plumbline.session import SEED, keep, spread
from plumbline.sources.tables import check_labels, feature_columns, labelled

FOLDS = 5


class Prepared:
    """Everything the fits of one table share."""

    def __init__(
        self,
        df: DataFrame,
        label: str,
        key_cols: Sequence[str] = (),
        seed: int = SEED,
        max_bins: int = MAX_BINS,
    ):
        feature_columns(df, label, key_cols)
        check_labels(df, label)
        keyless = not key_cols
        if keyless:
            df, key_cols = keep(with_row_key(df)), ["row_key"]
        self.label, self.key_cols, self.seed, self.max_bins = label, list(key_cols), seed, max_bins
        self.features = feature_columns(df, label, self.key_cols)
        source = spread(labelled(df, label, self.key_cols), *self.key_cols)
        self.df = keep(split_with_folds(source, label, self.key_cols, seed, FOLDS))
        sizes = self.df.groupBy("split", label, "cv_fold", "grid_fold").count().collect()
        self._sizes = [r.asDict() for r in sizes]  # at most 2 x (1 + 25) rows
        if keyless:
            df.unpersist()

    @property
    def spark(self):
        return self.df.sparkSession

    @property
    def train(self) -> DataFrame:
        return self.df.where(F.col("split") == "train")

    @property
    def test(self) -> DataFrame:
        return self.df.where(F.col("split") == "test")

    def rows(self, fold_col: str | None = None, without: int | None = None) -> int:
        """Training rows, all or without one fold."""
        return sum(
            r["count"]
            for r in self._sizes
            if r["split"] == "train" and (without is None or r[fold_col] != without)
        )

    @cached_property
    def bins(self) -> Bins:
        return exact_bins(self.train, self.features, self.max_bins)

    @property
    def binned(self) -> DataFrame:
        """Training rows with the vector ``bins``: a projection of the kept rows, not kept itself."""
        return self.bins.apply(self.train).select(*self.key_cols, "bins", self.label, "cv_fold", "grid_fold")

    def edges(self) -> list[list[float]]:
        """Values that cut each feature of a large table into slices of like size."""
        return self.bins.edges

    def cells(self, fold_col: str | None = None) -> DataFrame:
        """Training rows as weighted cells; with folds, test rows too, as held out."""
        if fold_col is None:
            return cells(self.train, self.features, self.label, F.lit(0))
        return cells(self.df, self.features, self.label, F.coalesce(F.col(fold_col), F.lit(HELD_OUT)))

    def grower(self, fold_col: str, keyed: bool) -> Grower:
        """The rows trees are grown on: cells, or with ``keyed`` single rows with their key."""
        if not keyed:
            return Grower(self.cells(fold_col).withColumn("key", F.lit("")), len(self.features), self.edges)
        rows = self.df.select(
            values(self.features).alias("x"),
            F.col(self.label).alias("label"),
            F.coalesce(F.col(fold_col), F.lit(HELD_OUT)).alias("fold"),
            F.lit(1).cast("bigint").alias("n"),
            key_text(self.key_cols).alias("key"),
        )
        return Grower(rows, len(self.features), self.edges)

    def fingerprint(self, fold_col: str) -> str:
        """A digest of the training rows and their folds, the same however they are laid out."""
        row = F.md5(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in self._texts(fold_col)]))
        parts = [F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"p{i}") for i in range(4)]
        found = self.train.agg(F.count(F.lit(1)).alias("n"), *parts).first()
        return hashlib.sha256(":".join([*self.features, self.label, *map(str, found)]).encode()).hexdigest()

    def _texts(self, fold_col: str) -> list:
        return [F.col(f"`{c}`").cast("string") for c in (*self.key_cols, *self.features, self.label, fold_col)]

    def release(self) -> None:
        self.df.unpersist()
