"""Hold-out split and folds as columns of one frame."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ranking import boundaries, content_hash, hash_order, with_part
from plumbline.session import SEED, keep
from plumbline.sources.tables import binary_counts, label_group

COPIES_PER_CHUNK = 100_000


def train_sizes(counts: dict[int, int], test_size: float) -> dict[int, int]:
    """Training rows per class: the largest remainders get the rows that rounding leaves over."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    if min(counts.values()) < 2:
        raise ValueError(f"every class needs at least 2 rows to be split, found {counts}")
    if min(n_train, n_test) < len(counts):
        raise ValueError(f"{n_train} training and {n_test} test rows cannot hold {len(counts)} classes")
    sizes = {c: k * n_train // n for c, k in counts.items()}
    left = n_train - sum(sizes.values())
    for c in sorted(counts, key=lambda c: (-(counts[c] * n_train % n), c))[:left]:
        sizes[c] += 1
    return sizes


def stratified_fold_sizes(counts: dict[int, int], k: int) -> dict[int, list[int]]:
    """Rows per class and fold when label-sorted rows are dealt to the folds in turn."""
    if all(c < k for c in counts.values()):
        raise ValueError(f"no class has the {k} rows that {k} folds need: {counts}")
    sizes, offset = {}, 0
    for c in sorted(counts):
        end = offset + counts[c]
        sizes[c] = [(end - 1 - i) // k - (offset - 1 - i) // k for i in range(k)]
        offset = end
    return sizes


def fold_sizes(n: int, k: int) -> list[int]:
    """Rows per fold: the first ``n mod k`` folds hold one row more."""
    if n < k:
        raise ValueError(f"{n} rows cannot fill {k} folds")
    return [n // k + (i < n % k) for i in range(k)]


def stratified_split(
    df: DataFrame,
    label: str,
    key_cols: Sequence[str],
    test_size: float = 0.2,
    seed: int = SEED,
    output: str = "split",
) -> DataFrame:
    """Add ``split`` = train or test, each class cut in the same proportion.

    Rows are ordered by the hash of the key and then of their content, so a key may repeat. Only
    copies of a whole row that lie on both sides of a cut are refused.
    """
    rows = _with_content(df)
    return _split_by(rows, label, key_cols, seed, output, _split_bounds(rows, label, key_cols, test_size, seed)).drop(_CONTENT)


def stratified_folds(
    df: DataFrame, label: str, key_cols: Sequence[str], k: int = 5, seed: int = SEED, output: str = "fold"
) -> DataFrame:
    """Add ``fold`` = 0..k-1 with the class shares of the table in every fold."""
    rows = _with_content(df)
    bounds = _stratified_bounds(rows, label, key_cols, k, seed)
    return with_part(rows, _order("fold", seed, key_cols), label_group(label), bounds, output).drop(_CONTENT)


def shuffled_folds(
    df: DataFrame, key_cols: Sequence[str], k: int = 5, seed: int = SEED, output: str = "fold"
) -> DataFrame:
    """Add ``fold`` = 0..k-1 regardless of the label."""
    rows = _with_content(df)
    bounds = _shuffled_bounds(rows, key_cols, k, seed)
    return with_part(rows, _order("kfold", seed, key_cols), F.lit(0), bounds, output).drop(_CONTENT)


def split_with_folds(df: DataFrame, label: str, key_cols: Sequence[str], seed: int = SEED, k: int = 5) -> DataFrame:
    """Add ``split`` and, on the training rows, both kinds of folds.

    ``cv_fold`` (stratified) serves the cross-validation of one model, ``grid_fold`` (shuffled) the
    grid search; both are NULL on test rows. All boundaries come from a slim copy of keys, label and
    content hash; the table itself is only projected.
    """
    rows = _with_content(df)
    slim = keep(rows.select(*key_cols, label, _CONTENT))
    split_at = _split_bounds(slim, label, key_cols, 0.2, seed)
    train = F.col("split") == "train"
    slim_train = _split_by(slim, label, key_cols, seed, "split", split_at).where(train)
    strata_at = _stratified_bounds(slim_train, label, key_cols, k, seed)
    shuffle_at = _shuffled_bounds(slim_train, key_cols, k, seed)
    slim.unpersist()
    out = _split_by(rows, label, key_cols, seed, "split", split_at)
    out = with_part(out, _order("fold", seed, key_cols), label_group(label), strata_at, "cv_fold", train)
    return with_part(out, _order("kfold", seed, key_cols), F.lit(0), shuffle_at, "grid_fold", train).drop(_CONTENT)


_CONTENT = "__content"


def _with_content(df: DataFrame) -> DataFrame:
    return df.withColumn(_CONTENT, content_hash(df))


def _order(salt: str, seed: int, key_cols: Sequence[str]):
    return hash_order(salt, seed, key_cols, F.col(_CONTENT))


def _split_by(df, label, key_cols, seed, output, bounds):
    out = with_part(df, _order("split", seed, key_cols), label_group(label), bounds, output)
    return out.withColumn(output, F.when(F.col(output) == 0, "train").otherwise("test"))


def _split_bounds(df, label, key_cols, test_size, seed):
    def cuts(counts):
        return {c: [n] for c, n in train_sizes(binary_counts(counts, label), test_size).items()}

    return boundaries(df, _order("split", seed, key_cols), label_group(label), cuts)


def _stratified_bounds(df, label, key_cols, k, seed):
    def cuts(counts):
        return {c: _cuts(s) for c, s in stratified_fold_sizes(binary_counts(counts, label), k).items()}

    return boundaries(df, _order("fold", seed, key_cols), label_group(label), cuts)


def _shuffled_bounds(df, key_cols, k, seed):
    def cuts(counts):
        return {0: _cuts(fold_sizes(counts.get(0, 0), k))}

    return boundaries(df, _order("kfold", seed, key_cols), F.lit(0), cuts)


def with_row_key(df: DataFrame, output: str = "row_key") -> DataFrame:
    """Give every row of a table without a key a key made of its content and a copy number.

    Copies are counted, not listed: the partial count collapses them before the shuffle. A row with
    very many copies is handed out again in chunks that different tasks expand.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    texts = [c.cast("string") for c in cols]
    content = F.md5(F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]))
    copies, chunk = F.col("__copies"), F.col("__chunk")
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
    few = counted.where(copies <= COPIES_PER_CHUNK).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / COPIES_PER_CHUNK))
    many = (
        counted.where(copies > COPIES_PER_CHUNK)
        .withColumn("__chunk", F.explode(chunks))
        .repartition(*cols, chunk)
        .withColumn(
            "__copy",
            F.explode(F.sequence(chunk * COPIES_PER_CHUNK + 1, F.least((chunk + 1) * COPIES_PER_CHUNK, copies))),
        )
        .drop("__chunk")
    )
    key = F.concat(content, F.lit(":"), F.col("__copy").cast("string"))
    return few.unionByName(many).select(*cols, key.alias(output))


def _cuts(sizes: list[int]) -> list[int]:
    total, cuts = 0, []
    for s in sizes[:-1]:
        total += s
        cuts.append(total)
    return cuts
