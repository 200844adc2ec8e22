"""The reference SQL of every registered query that SQL can express."""

from __future__ import annotations

import json

from oracles.chains import (
    BIN_COLS, COUNTS, EVENTS, FACTORS, FEATURES, FOLDED, LINEITEM, SIX_FITS, SPLIT, VALUED,
    boosted, boosted_real, boosted_votes, cells, edges, fits, forest, forest_importances, forest_votes, judged, linear_votes, measured, newton, shuffled, sql, stratified, stumps,
    tree, tree_importances, tree_path, tree_votes, unpivot,
)

TRAIN_ONLY = "split = 'train'"
RULE = "CAST(l_extendedprice * l_discount > cut AS INTEGER)"
TEST_RULED = "(SELECT label, CAST(l_discount > 0.05 AS INTEGER) AS prediction, 1 AS n FROM parted WHERE split = 'test')"
CANDIDATES = "candidate AS (SELECT * FROM (VALUES (0, 2000.0), (1, 3000.0), (2, 3000.0), (3, 4000.0)) AS t(ordinal, cut))"
BOARD_ROWS = f"""(SELECT ordinal, family, label, {RULE} AS prediction, 1 AS n
  FROM parted, (VALUES (0, 'logistic_regression', 2500.0), (1, 'random_forest', 3000.0),
                       (2, 'adaptive_boosting', 3000.0), (3, 'decision_tree', 4000.0)) AS t(ordinal, family, cut)
  WHERE split = 'test')"""
BOARD = f"board AS ({measured(BOARD_ROWS, 'ordinal, family')})"
SHORT_BOARD = (
    BOARD.replace("'logistic_regression'", "'lr'").replace("'random_forest'", "'rf'")
    .replace("'adaptive_boosting'", "'adaboost'").replace("'decision_tree'", "'dt'")
)
WINNER = """SELECT ordinal, family, accuracy, "precision", recall FROM board
ORDER BY accuracy DESC, "precision" DESC, recall DESC, ordinal LIMIT 1"""
FOLD_SIZES = """fold_n AS (
  SELECT f.fold, count(*) FILTER (grid_fold <> f.fold) AS n_train
  FROM folded, (SELECT unnest(range(5)) AS fold) f WHERE split = 'train' GROUP BY f.fold)"""
BINNED = ",\n".join([FOLDED, edges()])
ROWS = ",\n".join([FOLDED, VALUED])
PLACED = "CAST(row_number() OVER (ORDER BY raw DESC, feature) AS INTEGER) AS place"
ONE_FIT = [(-1, -1, 1.0)]
ROUNDS = 50  # boosting rounds of the single fits
DEPTH = 10  # of the single trees
TREES = 100  # of the single forest
STEPS = 9  # Newton steps


def grid_sql(axes: dict[str, list], types: dict[str, str], extra: str = "") -> str:
    """All combinations, the names sorted and the last one fastest, for every fold."""
    lists, order = [], []
    for name in sorted(axes):
        values = ", ".join("NULL" if v is None else repr(v) for v in axes[name])
        column = f'CAST(unnest([{values}]) AS {types[name]}) AS "{name}"'
        lists.append(f'(SELECT {column}, unnest(range({len(axes[name])})) AS "at_{name}") "of_{name}"')
        order.append(f'"at_{name}"')
    names = ", ".join(f'"{n}"' for n in sorted(axes))
    grid = f"""grid_list AS (
  SELECT CAST(row_number() OVER (ORDER BY {', '.join(order)}) - 1 AS INTEGER) AS ordinal, {names} FROM {', '.join(lists)})"""
    select = f"SELECT ordinal, {names}, CAST(fold AS INTEGER) AS fold, n_train{extra} FROM grid_list, fold_n"
    return sql(FOLDED, FOLD_SIZES, grid, select=select)


def boosted_importance(place: bool) -> str:
    names = ", ".join(f"('{f}', {i})" for i, f in enumerate(FEATURES))
    select = f"""SELECT feature, round(raw, 6) AS importance{', ' + PLACED if place else ''} FROM (
  SELECT name AS feature, coalesce(sum(alpha), 0) / (SELECT sum(alpha) FROM learner) AS raw
  FROM (VALUES {names}) AS t(name, id) LEFT JOIN learner ON learner.f = id GROUP BY name)"""
    chain = [ROWS, cells("cv_fold"), fits(ONE_FIT), boosted(ROUNDS), f"learner AS ({stumps(ROUNDS)})"]
    return sql(*chain, select=select)


def linear(fit_rows: list[tuple], fold_col: str) -> list[str]:
    return [FOLDED, fits(fit_rows), newton(STEPS).replace("FOLDCOL", fold_col)]


def predict_tree(depth: int, min_split: int) -> str:
    """Predictions per test row: cells are walked once, rows look theirs up."""
    votes = tree_votes(depth, min_split).replace("SELECT fit, label,", f"SELECT {BIN_COLS},").replace(", n FROM", " FROM")
    path = tree_path(depth).replace("SELECT w.fit, w.label, w.n,", f"SELECT w.fit, w.label, w.n, {BIN_COLS},")
    select = f"SELECT row_key, prediction FROM binned JOIN answer USING ({BIN_COLS}) WHERE split = 'test'"
    answer = f"answer AS (SELECT DISTINCT * FROM {votes})"
    return sql(ROWS, cells("cv_fold"), fits(ONE_FIT), tree(depth), path, answer, select=select)


def tuned(chain: list[str], variants: list[tuple[str, str]], params: list[dict]) -> str:
    """``variants`` are (fold votes, test votes) per ordinal; the best by mean fold accuracy is judged."""
    scored = " UNION ALL ".join(f"SELECT {i} AS ordinal, * FROM {votes}" for i, (votes, _) in enumerate(variants))
    tested = " UNION ALL ".join(f"SELECT {i} AS ordinal, label, prediction, n FROM {votes}" for i, (_, votes) in enumerate(variants))
    named = " ".join(f"WHEN {i} THEN '{json.dumps(p, sort_keys=True)}'" for i, p in enumerate(params))
    per_fold = f"""per_fold AS (
  SELECT ordinal, fit, CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS accuracy
  FROM ({scored}) GROUP BY ordinal, fit)"""
    chosen = """chosen AS MATERIALIZED (
  SELECT ordinal, round(avg(accuracy), 12) AS accuracy_crossval FROM per_fold GROUP BY ordinal
  ORDER BY accuracy_crossval DESC, ordinal LIMIT 1)"""
    rows = f"(SELECT label, prediction, n FROM ({tested}) JOIN chosen USING (ordinal))"
    select = f"""SELECT m.*, accuracy_crossval, CASE chosen.ordinal {named} END AS params
FROM chosen, ({measured(rows, rates=True)}) m"""
    return sql(*chain, per_fold, chosen, select=select)


def several(rates: list[float]) -> list[tuple]:
    """Fits for several rates: -1, -2, … on all training rows, 10 i + k without fold k."""
    return [(-1 - i, -1, r) for i, r in enumerate(rates)] + [(10 * i + k, k, r) for i, r in enumerate(rates) for k in range(5)]


def of_rate(votes: str, i: int) -> tuple[str, str]:
    return (
        f"(SELECT * FROM {votes} WHERE fit BETWEEN {10 * i} AND {10 * i + 4})",
        f"(SELECT * FROM {votes} WHERE fit = {-1 - i})",
    )


def tune_lr() -> str:
    strengths = [0.01, 0.1, 1.0, 10.0, 100.0]  # fixed values: the searched grid
    chain = [*linear(several(strengths), "grid_fold"), f"vote AS MATERIALIZED (SELECT * FROM {linear_votes(STEPS, 'grid_fold')})"]
    variants, params = [], []
    for i, c in enumerate(strengths):
        for max_iter in (100, 500, 1000):
            for solver in ("lbfgs", "newton-cg", "sag", "saga"):
                variants.append(of_rate("vote", i))
                params.append({"C": c, "max_iter": max_iter, "penalty": "l2", "solver": solver})
    return tuned(chain, variants, params)


def texts(*columns: str) -> str:
    """Values with their lengths."""
    return " || ".join(f"length(CAST({c} AS VARCHAR)) || ':' || {c}" for c in columns)


def _tables() -> dict[str, str]:
    copy_key = """base AS MATERIALIZED (
  SELECT *, md5(length(CAST(quantity AS VARCHAR)) || ':' || quantity || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber
                || length(CAST(label AS VARCHAR)) || ':' || label)
            || ':' || row_number() OVER (PARTITION BY quantity, l_linenumber, label) AS row_key FROM slim)"""
    slim = """slim AS (
  SELECT CAST(l_quantity AS INTEGER) AS quantity, l_linenumber, CAST(l_discount > 0.05 AS INTEGER) AS label FROM lineitem)"""
    dealt = "SELECT event_id, fold FROM base JOIN dealt_out USING (row_key)"
    return {
        "feature_projection": f"SELECT {', '.join(FEATURES)} FROM lineitem",
        "label_projection": sql(LINEITEM, select="SELECT CAST(label AS DOUBLE) AS label FROM base"),
        "assembled_features": f"SELECT {', '.join(f'{f} AS x{i}' for i, f in enumerate(FEATURES))} FROM lineitem",
        "csv_round_trip": sql(
            LINEITEM,
            select="""SELECT row_key, l_quantity, l_extendedprice, l_discount, CASE WHEN l_tax <> 0.04 THEN l_tax END AS l_tax,
  CAST(label AS BIGINT) AS label, l_discount > 0.05 AS discounted FROM base""",
        ),
        "csv_with_schema": """SELECT 1000000000000000000 + l_orderkey AS long_key, 'line' || chr(10) || l_linenumber AS note,
  CASE WHEN l_tax <> 0.04 THEN l_tax END AS l_tax FROM lineitem""",
        "parquet_folder": sql(EVENTS, select="SELECT event_id, value, label FROM base"),
        "repeating_key_split": sql(
            f"""keyed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_discount > 0.05 AS INTEGER) AS label FROM lineitem),
base AS MATERIALIZED (SELECT *, {texts('l_orderkey', 'l_linenumber')} AS row_key,
  md5({texts('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', 'label')}) AS content FROM keyed)""",
            SPLIT.replace("|| row_key))", "|| row_key) || content)"),
            select="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, split FROM parted",
        ),
        "label_validity": """
            WITH told AS (
              SELECT unnest([
                {'label': 'discounted', 'v': CASE WHEN l_discount > 0.05 THEN '1' ELSE '0' END},
                {'label': 'sold', 'v': CASE WHEN l_quantity > 0 THEN '1' WHEN l_quantity <= 0 THEN '0' END},
                {'label': 'l_linenumber', 'v': CAST(l_linenumber AS VARCHAR)},
                {'label': 'l_returnflag', 'v': l_returnflag},
                {'label': 'returned', 'v': CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '0' END},
                {'label': 'odd', 'v': CAST(l_linenumber % 2 AS VARCHAR)}]) AS t FROM lineitem),
            counted AS (
              SELECT t.label AS label, count(*) FILTER (t.v = '0') AS n_zero, count(*) FILTER (t.v = '1') AS n_one,
                     count(*) FILTER (t.v IS NULL OR t.v NOT IN ('0', '1')) AS n_refused
              FROM told GROUP BY t.label)
            SELECT *, n_zero > 0 AND n_one > 0 AND n_refused = 0 AS usable FROM counted""",
        "class_profile": sql(
            EVENTS, SPLIT, select="SELECT split, label, count(*) AS n_rows, 3 AS n_columns FROM parted GROUP BY split, label"
        ),
        "stratified_split": sql(EVENTS, SPLIT, select="SELECT event_id, split FROM parted"),
        "stratified_folds": sql(EVENTS, stratified("base", "dealt_out"), select=dealt),
        "kfold_shuffled": sql(EVENTS, shuffled("base", "dealt_out"), select=dealt),
        "keyless_split": sql(
            slim, copy_key, SPLIT, select="SELECT quantity, l_linenumber, label, split, count(*) AS n FROM parted GROUP BY ALL"
        ),
        "train_folds": sql(FOLDED, select="SELECT row_key, split, cv_fold, grid_fold FROM folded"),
        "signature": sql(
            EVENTS,
            select="""SELECT 'value' AS name, 'double' AS type, 'input' AS role, count(value) = count(*) AS required FROM base
UNION ALL SELECT 'prediction', 'double', 'output', TRUE""",
        ),
        "input_example": sql(
            LINEITEM, SPLIT, select=f"SELECT {', '.join(FEATURES)} FROM parted WHERE split = 'train' ORDER BY row_key LIMIT 5"
        ),
    }


def _metrics() -> dict[str, str]:
    ruled = f"m AS ({measured(TEST_RULED, rates=True)})"
    return {
        "confusion_counts": sql(
            LINEITEM,
            CANDIDATES,
            select=f"SELECT ordinal, {COUNTS} FROM (SELECT ordinal, label, {RULE} AS prediction, 1 AS n FROM base, candidate) GROUP BY ordinal",
        ),
        "binary_metrics": sql(LINEITEM, SPLIT, select=measured(TEST_RULED)),
        "rate_metrics": sql(
            LINEITEM,
            SPLIT,
            ruled,
            select="SELECT cm_true_negative, cm_false_positive, cm_false_negative, cm_true_positive, tnr, fnr, fpr FROM m",
        ),
        "metrics_long": sql(
            LINEITEM, SPLIT, ruled, select="SELECT metric, value FROM (SELECT COLUMNS(*)::DOUBLE FROM m) UNPIVOT (value FOR metric IN (*))"
        ),
        "metrics_sink": sql(LINEITEM, SPLIT, select=measured(TEST_RULED, rates=True)),
        "invalid_predictions": """SELECT l_linenumber, count(*) AS n_rows, count(*) FILTER (l_quantity <= 2) AS n_missing,
  count(*) FILTER (l_quantity > 2 AND l_quantity <= 4) AS n_other FROM lineitem GROUP BY l_linenumber""",
        "confusion_table": sql(
            LINEITEM,
            SPLIT,
            select=f"""SELECT CASE p WHEN 0 THEN 'Predicted Negative' ELSE 'Predicted Positive' END AS predicted,
  count(*) FILTER (prediction = p AND label = 0) AS actual_negative, count(*) FILTER (prediction = p AND label = 1) AS actual_positive
FROM {TEST_RULED}, (VALUES (0), (1)) AS t(p) GROUP BY p""",
        ),
        "cv_mean_accuracy": sql(
            FOLDED,
            select="""SELECT round(avg(accuracy), 12) AS accuracy_crossval FROM (
  SELECT cv_fold, CAST(count(*) FILTER (CAST(l_discount > 0.05 AS INTEGER) = label) AS DOUBLE) / count(*) AS accuracy
  FROM folded WHERE split = 'train' GROUP BY cv_fold)""",
        ),
        "best_candidate": sql(
            FOLDED,
            CANDIDATES,
            select=f"""SELECT ordinal, round(avg(accuracy), 12) AS accuracy_crossval FROM (
  SELECT ordinal, grid_fold, CAST(count(*) FILTER ({RULE} = label) AS DOUBLE) / count(*) AS accuracy
  FROM folded, candidate WHERE split = 'train' GROUP BY ordinal, grid_fold)
GROUP BY ordinal ORDER BY accuracy_crossval DESC, ordinal LIMIT 1""",
        ),
        "leaderboard_winner": sql(LINEITEM, SPLIT, BOARD, select=WINNER),
        "winner_pointer": sql(LINEITEM, SPLIT, BOARD, f"best AS ({WINNER})", select="SELECT family AS run_id FROM best"),
        "run_log": sql(
            LINEITEM,
            SPLIT,
            SHORT_BOARD,
            select="""SELECT family || '_tuned_run_ci' AS run_name, family, 'metric' AS kind, name, CAST(NULL AS VARCHAR) AS value_str, value_num
FROM (SELECT family, COLUMNS(* EXCLUDE (ordinal, family))::DOUBLE FROM board) UNPIVOT (value_num FOR name IN (* EXCLUDE (family)))
UNION ALL SELECT family || '_tuned_run_ci', family, 'param', 'threshold', text, value
FROM (VALUES ('lr', '2500.0', 2500.0), ('rf', '3000.0', 3000.0), ('adaboost', '3000.0', 3000.0), ('dt', '4000.0', 4000.0)) AS t(family, text, value)""",
        ),
    }


def _grids() -> dict[str, str]:
    # fixed values: the searched grids
    whole = "INTEGER"
    limits = {"max_depth": whole, "min_samples_split": whole, "min_samples_leaf": whole}
    return {
        "grid_lr": grid_sql(
            {
                "C": [0.01, 0.1, 1.0, 10.0, 100.0],
                "penalty": ["l2"],
                "solver": ["lbfgs", "newton-cg", "sag", "saga"],
                "max_iter": [100, 500, 1000],
            },
            {"C": "DOUBLE", "penalty": "VARCHAR", "solver": "VARCHAR", "max_iter": whole},
            ', 1 / ("C" * n_train) AS reg_param',
        ),
        "grid_rf": grid_sql(
            {
                "n_estimators": [100, 200, 300],
                "max_depth": [25, 50],
                "min_samples_split": [2, 5, 10],
                "min_samples_leaf": [1, 2, 4],
                "max_features": ["sqrt"],
            },
            {"n_estimators": whole, "max_features": "VARCHAR", **limits},
        ),
        "grid_adaboost": grid_sql(
            {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 1.0], "base_max_depth": [1, 3, 5]},
            {"n_estimators": whole, "learning_rate": "DOUBLE", "base_max_depth": whole},
        ),
        "grid_dt": grid_sql(
            {
                "criterion": ["gini", "entropy"],
                "max_depth": [None, 10, 20, 30],
                "min_samples_split": [2, 5, 10],
                "min_samples_leaf": [1, 2, 4],
            },
            {"criterion": "VARCHAR", **limits},
        ),
    }


def _models() -> dict[str, str]:
    trees = [ROWS, cells("cv_fold"), fits(SIX_FITS)]
    one = [ROWS, cells("cv_fold"), fits(ONE_FIT)]
    weights = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, w{i + 1} * {c!r} AS raw FROM theta_{STEPS}" for i, (f, c) in enumerate(zip(FEATURES, FACTORS))
    )
    margin = " + ".join(f"w{i} * x{i}" for i in range(len(FEATURES) + 1))
    names = ", ".join(f"('{f}', {i})" for i, f in enumerate(FEATURES))
    edge_rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS position, unnest(e) AS edge FROM edges_{i}"
        for i, f in enumerate(FEATURES)
    )
    cell_answer = f"answer AS (SELECT DISTINCT {BIN_COLS}, CAST(margin > 1e-9 AS INTEGER) AS prediction FROM boost_{ROUNDS} WHERE fold = -1)"
    return {
        "feature_bins": sql(BINNED, select=edge_rows),
        "binned_histogram": sql(
            BINNED,
            select=f"SELECT f AS feature, bin, label, count(*) AS n FROM ({unpivot('binned', 'label', TRAIN_ONLY)}) GROUP BY ALL",
        ),
        "stump_split": sql(
            *trees, boosted(1), select="SELECT fit, f AS feature, round(cut, 9) AS cut, left_vote, right_vote, round(err, 6) AS error FROM stump_1"
        ),
        "samme_rounds": sql(
            *one,
            boosted(ROUNDS),
            select=f"""SELECT round, f AS feature, round(cut, 9) AS cut, left_vote, right_vote, round(err, 6) AS error, round(alpha, 6) AS alpha
FROM ({stumps(ROUNDS)})""",
        ),
        "samme_r_rounds": sql(
            *one,
            boosted_real(ROUNDS),
            select=f"""SELECT round, f AS feature, round(cut, 9) AS cut, round(left_odds, 6) AS left_odds, round(right_odds, 6) AS right_odds,
  round(err, 6) AS error FROM ({stumps(ROUNDS)})""",
        ),
        "predict_samme_r": sql(
            *one,
            boosted_real(ROUNDS),
            cell_answer,
            select=f"SELECT row_key, prediction FROM binned JOIN answer USING ({BIN_COLS}) WHERE split = 'test'",
        ),
        "train_samme_r": sql(*trees, boosted_real(ROUNDS), f"vote AS {boosted_votes(ROUNDS)}", select=judged("vote")),
        "importance_adaboost": boosted_importance(place=True),
        "importance_sink": boosted_importance(place=False),
        "importance_dt": sql(
            *one,
            tree(DEPTH),
            tree_importances(DEPTH),
            select=f"""SELECT feature, round(raw, 9) AS importance, {PLACED} FROM (
  SELECT name AS feature, coalesce(sum(fall), 0) / (SELECT sum(fall) FROM inner_nodes) AS raw
  FROM (VALUES {names}) AS t(name, id) LEFT JOIN inner_nodes ON f = id GROUP BY name)""",
        ),
        "importance_rf": sql(
            ROWS,
            forest(TREES, DEPTH),
            forest_importances(DEPTH),
            select=f"""SELECT feature, round(raw, 9) AS importance, {PLACED} FROM (
  SELECT name AS feature, coalesce(raw, 0) AS raw FROM (VALUES {names}) AS t(name, id) LEFT JOIN per_feature ON f = id)""",
        ),
        "predict_rf": sql(
            ROWS,
            forest(TREES, DEPTH),
            forest_votes(TREES, DEPTH),
            select=f"SELECT row_key, prediction FROM binned JOIN answer USING ({BIN_COLS}) WHERE split = 'test'",
        ),
        "importance_lr": sql(
            *linear(ONE_FIT, "cv_fold"),
            f"coefficient AS ({weights})",
            select=f"SELECT feature, round(raw, 7) AS importance, {PLACED} FROM coefficient",
        ),
        "train_lr": sql(*linear(SIX_FITS, "cv_fold"), f"vote AS ({linear_votes(STEPS, 'cv_fold')})", select=judged("vote")),
        "train_dt": sql(*trees, tree(DEPTH), tree_path(DEPTH), f"vote AS {tree_votes(DEPTH)}", select=judged("vote")),
        "train_adaboost": sql(*trees, boosted(ROUNDS), f"vote AS {boosted_votes(ROUNDS)}", select=judged("vote")),
        "predict_lr": sql(
            *linear(ONE_FIT, "cv_fold"),
            select=f"SELECT row_key, CAST({margin} > 0 AS INTEGER) AS prediction FROM scaled, theta_{STEPS} WHERE split = 'test'",
        ),
        "predict_dt": predict_tree(DEPTH, 2),
        "predict_dt_pruned": predict_tree(DEPTH, 500),
        "predict_adaboost": sql(
            *one,
            boosted(ROUNDS),
            cell_answer,
            select=f"SELECT row_key, prediction FROM binned JOIN answer USING ({BIN_COLS}) WHERE split = 'test'",
        ),
        "tune_lr": tune_lr(),
        "model_round_trip": sql(
            LINEITEM,
            SPLIT,
            select="""SELECT family, count(*) AS n_rows, CAST(0 AS BIGINT) AS changed
FROM parted, (VALUES ('lr'), ('rf'), ('adaboost'), ('dt')) AS t(family) WHERE split = 'test' GROUP BY family""",
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {**_tables(), **_metrics(), **_grids(), **_models()}
