"""From a file to a trained or tuned model, everything written under one folder."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from plumbline.plans.families import DEFAULTS
from plumbline.plans.prepared import Prepared
from plumbline.plans.select import winner
from plumbline.plans.train import Trained, train_one
from plumbline.plans.tune import tune_all
from plumbline.sources.tables import read_table

LABEL = "diabetes"  # fixed value: the label column when none is named

log = logging.getLogger("plumbline")


def train_file(
    spark: SparkSession,
    path: str,
    name: str,
    out: str,
    label: str = LABEL,
    key_cols: Sequence[str] = (),
    params: Mapping | None = None,
) -> Trained:
    """Read a labelled table, train one family, judge and record it; without ``params`` with those of the
    plain training run."""
    p = Prepared(read_table(spark, path), label, key_cols)
    try:
        result = train_one(p, name, DEFAULTS.get(name) if params is None else params, out)
    finally:
        p.release()
    log.info("%s: accuracy %.4f, cross-validated %.4f, run %s", name, result.metrics["accuracy"], result.accuracy_crossval, result.run_id)
    return result


def tune_file(
    spark: SparkSession,
    path: str,
    out: str,
    label: str = LABEL,
    key_cols: Sequence[str] = (),
    grids: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Read a labelled table and tune all families; returns the leaderboard.

    The winner is chosen on the test rows, so its test score flatters it: read ``accuracy_crossval``
    beside it.
    """
    p = Prepared(read_table(spark, path), label, key_cols)
    try:
        board, _ = tune_all(p, grids, out)
    finally:
        p.release()
    best = winner(board).first()
    log.info("best: %s, accuracy %.4f, run %s", best["long_name"], best["accuracy"], best["run_id"])
    return board
