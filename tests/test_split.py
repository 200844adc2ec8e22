import hashlib
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import ranking, split
from plumbline.session import SEED


def table(spark, n, share=0.3, seed=1):
    rng = random.Random(seed)
    return [(i, int(rng.random() < share)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, y int")


def digest(salt, key):
    return hashlib.md5(f"{salt}:{SEED}:{key}".encode()).hexdigest()


def by_rank(rows, salt, sizes_of):
    """Brute force: sort each class by hash, deal out the given sizes."""
    out = {}
    for c in sorted({y for _, y in rows}):
        keys = sorted((k for k, y in rows if y == c), key=lambda k: digest(salt, k))
        at = 0
        for part, size in enumerate(sizes_of(c)):
            out |= {k: part for k in keys[at : at + size]}
            at += size
    return out


@given(st.integers(2, 400), st.integers(2, 400), st.sampled_from([0.1, 0.2, 0.25, 0.5]))
@settings(max_examples=200, deadline=None)
def test_train_sizes(c0, c1, share):
    n = c0 + c1
    n_test = math.ceil(share * n)
    if min(n_test, n - n_test) < 2:
        return
    sizes = split.train_sizes({0: c0, 1: c1}, share)
    assert sum(sizes.values()) == n - n_test
    for c, k in ((0, c0), (1, c1)):
        assert abs(sizes[c] - k * (n - n_test) / n) < 1


@given(st.integers(0, 60), st.integers(0, 60), st.integers(2, 7))
@settings(max_examples=200, deadline=None)
def test_stratified_fold_sizes_by_dealing(c0, c1, k):
    if max(c0, c1) < k or min(c0, c1) < 1:
        return
    dealt = {0: [0] * k, 1: [0] * k}
    for i, c in enumerate([0] * c0 + [1] * c1):
        dealt[c][i % k] += 1
    assert split.stratified_fold_sizes({0: c0, 1: c1}, k) == dealt


def test_small_classes_are_refused():
    with pytest.raises(ValueError):
        split.train_sizes({0: 10, 1: 1}, 0.2)
    with pytest.raises(ValueError):
        split.train_sizes({0: 2, 1: 2}, 0.2)
    with pytest.raises(ValueError):
        split.stratified_fold_sizes({0: 4, 1: 3}, 5)
    with pytest.raises(ValueError):
        split.fold_sizes(4, 5)


@pytest.mark.parametrize("n", [23, 1003])
def test_split_against_sorting(spark, n):
    rows = table(spark, n)
    counts = {c: sum(y == c for _, y in rows) for c in (0, 1)}
    sizes = split.train_sizes(counts, 0.2)
    want = by_rank(rows, "split", lambda c: [sizes[c], counts[c] - sizes[c]])
    got = {r["k"]: int(r["split"] == "test") for r in split.stratified_split(frame(spark, rows), "y", ["k"]).collect()}
    assert got == want


@pytest.mark.parametrize("edge_rows", [200_000, 1])
def test_folds_against_sorting(spark, monkeypatch, edge_rows):
    monkeypatch.setattr(ranking.boundaries, "__defaults__", (edge_rows,))
    rows = table(spark, 1003)
    counts = {c: sum(y == c for _, y in rows) for c in (0, 1)}
    sizes = split.stratified_fold_sizes(counts, 5)
    got = {r["k"]: r["fold"] for r in split.stratified_folds(frame(spark, rows), "y", ["k"]).collect()}
    assert got == by_rank(rows, "fold", lambda c: sizes[c])
    flat = [(k, 0) for k, _ in rows]
    got = {r["k"]: r["fold"] for r in split.shuffled_folds(frame(spark, rows), ["k"]).collect()}
    assert got == by_rank(flat, "kfold", lambda c: split.fold_sizes(1003, 5))


def test_membership_ignores_layout(spark):
    df = frame(spark, table(spark, 500))
    one = split.split_with_folds(df.repartition(1), "y", ["k"])
    many = split.split_with_folds(df.repartition(13, "y"), "y", ["k"])
    assert sorted(one.collect()) == sorted(many.collect()) or sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_folds_cover_the_training_rows_only(spark):
    out = split.split_with_folds(frame(spark, table(spark, 503)), "y", ["k"]).collect()
    for r in out:
        assert (r["split"] == "train") == (r["cv_fold"] is not None) == (r["grid_fold"] is not None)
    assert {r["cv_fold"] for r in out if r["split"] == "train"} == set(range(5))


def test_placing_rows_needs_no_shuffle(spark):
    df = split.stratified_split(spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y")), "y", ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_repeated_key_on_a_cut_is_refused(spark):
    df = spark.createDataFrame([(7, i % 2) for i in range(100)], "k int, y int")
    with pytest.raises(ValueError, match="copies of one row"):
        split.stratified_split(df, "y", ["k"])


def test_rows_of_one_key_are_told_apart_by_their_content(spark):
    """However often a key repeats, sizes are exact and the layout does not matter."""
    rows = [(i % 3, i, int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, a int, y int")
    one = split.split_with_folds(df.repartition(1), "y", ["k"]).collect()
    many = split.split_with_folds(df.repartition(9), "y", ["k"]).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    assert sum(r["split"] == "test" for r in one) == 80


def test_missing_key_parts_are_told_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a:b", "c"), ("a", "b:c")], "p string, q string")
    assert df.select(ranking.hash_order("x", 1, ["p", "q"])).distinct().count() == 4


def test_hot_key_is_refused_without_ranking_it(spark, monkeypatch):
    monkeypatch.setattr(ranking.boundaries, "__defaults__", (10,))
    df = spark.createDataFrame([(7, i % 2) for i in range(100)], "k int, y int")
    with pytest.raises(ValueError, match="copies of one row"):
        split.stratified_split(df, "y", ["k"])


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_rows_without_a_key(spark, monkeypatch, chunk):
    """A third of all rows are copies of one row."""
    monkeypatch.setattr(split, "COPIES_PER_CHUNK", chunk)
    rows = [(1.5, 1)] * 100 + [(float(i), i % 2) for i in range(200)] + [(None, 0)] * 3
    df = spark.createDataFrame(rows, "a double, y int")
    keyed = split.with_row_key(df)
    got = keyed.collect()
    assert sorted(((r["a"], r["y"]) for r in got), key=str) == sorted(rows, key=str)
    assert len({r["row_key"] for r in got}) == len(rows)
    parted = split.stratified_split(keyed, "y", ["row_key"])
    hot = parted.where("a = 1.5 AND y = 1").groupBy("split").count().collect()
    assert {r["split"] for r in hot} == {"train", "test"}
    assert sum(r["count"] for r in hot) == 100 + sum(a == 1.5 and y == 1 for a, y in rows[100:])
    again = split.stratified_split(split.with_row_key(df.repartition(5)), "y", ["row_key"])
    assert sorted(map(str, parted.collect())) == sorted(map(str, again.collect()))


def test_wrong_labels_are_refused(spark):
    with pytest.raises(ValueError):
        split.stratified_split(spark.createDataFrame([(i, 1) for i in range(50)], "k int, y int"), "y", ["k"])
    with pytest.raises(ValueError):
        split.stratified_split(spark.createDataFrame([(i, i % 3) for i in range(50)], "k int, y int"), "y", ["k"])


def test_a_row_is_hashed_once_for_all_cuts(spark, capsys):
    """One prefix after the other made the filter hash every row once per cut."""
    rows = frame(spark, table(spark, 500)).select(F.col("y").alias("g"), ranking.hash_order("fold", SEED, ["k"]).alias("h"))
    cuts = {(g, i): (f"{5 * i + g:03x}", 1, 1) for g in (0, 1) for i in range(40)}
    inside = ranking._inside(rows, cuts)
    inside.explain()
    filters = [x for x in capsys.readouterr().out.splitlines() if "Filter" in x]
    assert filters and all(x.count("md5(") <= 1 for x in filters)
    wanted = {(g, prefix) for (g, _), (prefix, _, _) in cuts.items()}
    expected = sorted(tuple(r) for r in rows.collect() if (r["g"], r["h"][:3]) in wanted)
    assert expected and sorted(map(tuple, inside.collect())) == expected
