"""Reference SQL for the registered queries, written independently of the library's methods.

Splits and folds are plain ``row_number``; bin edges are order statistics of fully sorted columns;
trees, boosting and logistic regression are unrolled chains of common table expressions.
"""

from __future__ import annotations

import math

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEED = 20250531
F = range(len(FEATURES))
BIN_COLS = ", ".join(f"b{i}" for i in F)


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ---- labelled tables -------------------------------------------------------------------------

LINEITEM = """keyed AS (
  SELECT *, l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':'
            || CAST(round(l_extendedprice * 100) AS BIGINT) AS row_key FROM lineitem),
base AS MATERIALIZED (
  SELECT row_key, l_quantity, l_extendedprice, l_discount, l_tax,
         CAST((l_extendedprice * l_discount > 3000) <> (substr(md5('noise:' || row_key), 1, 2) < '0d') AS INTEGER) AS label
  FROM keyed)"""
EVENTS = """base AS MATERIALIZED (
  SELECT event_id, CAST(event_id AS VARCHAR) AS row_key, value, CAST(event_type = 'purchase' AS INTEGER) AS label FROM events)"""

# ---- split and folds -------------------------------------------------------------------------

SPLIT = f"""class_n AS (SELECT label, count(*) AS c FROM base GROUP BY label),
total AS (SELECT sum(c) AS n, sum(c) - CAST(ceil(CAST(0.2 AS DOUBLE) * sum(c)) AS BIGINT) AS n_train FROM class_n),
share AS (SELECT label, (c * n_train) // n AS whole, (c * n_train) % n AS rest FROM class_n, total),
train_n AS (
  SELECT label, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                              <= (SELECT n_train FROM total) - (SELECT sum(whole) FROM share) THEN 1 ELSE 0 END AS k
  FROM share),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('split:{SEED}:' || row_key)) AS rn FROM base),
parted AS MATERIALIZED (
  SELECT ranked.* EXCLUDE (rn), CASE WHEN rn <= k THEN 'train' ELSE 'test' END AS split FROM ranked JOIN train_n USING (label))"""


def stratified(rows: str, name: str) -> str:
    """Fold sizes by dealing label-sorted rows in turn, membership by rank in the hash order."""
    return f"""{name}_ranked AS (
  SELECT row_key, label, row_number() OVER (PARTITION BY label ORDER BY md5('fold:{SEED}:' || row_key)) AS rn,
         (row_number() OVER (ORDER BY label, row_key) - 1) % 5 AS dealt FROM {rows}),
{name}_upto AS (
  SELECT label, dealt, sum(count(*)) OVER (PARTITION BY label ORDER BY dealt) AS upto FROM {name}_ranked GROUP BY label, dealt),
{name} AS MATERIALIZED (
  SELECT r.row_key, CAST(min(u.dealt) AS INTEGER) AS fold
  FROM {name}_ranked r JOIN {name}_upto u ON u.label = r.label AND r.rn <= u.upto GROUP BY r.row_key)"""


def shuffled(rows: str, name: str) -> str:
    return f"""{name}_ranked AS (
  SELECT row_key, row_number() OVER (ORDER BY md5('kfold:{SEED}:' || row_key)) AS rn, count(*) OVER () AS n FROM {rows}),
{name} AS MATERIALIZED (
  SELECT row_key, CAST(CASE WHEN rn <= (n // 5 + 1) * (n % 5) THEN (rn - 1) // (n // 5 + 1)
                       ELSE n % 5 + (rn - 1 - (n // 5 + 1) * (n % 5)) // (n // 5) END AS INTEGER) AS fold FROM {name}_ranked)"""


FOLDED = ",\n".join(
    [
        LINEITEM,
        SPLIT,
        "train_rows AS (SELECT * FROM parted WHERE split = 'train')",
        stratified("train_rows", "cv"),
        shuffled("train_rows", "grid"),
        """folded AS MATERIALIZED (
  SELECT p.*, cv.fold AS cv_fold, grid.fold AS grid_fold FROM parted p LEFT JOIN cv USING (row_key) LEFT JOIN grid USING (row_key))""",
    ]
)

# ---- metrics ---------------------------------------------------------------------------------

COUNTS = """CAST(coalesce(sum(CASE WHEN label = 0 AND prediction = 0 THEN n END), 0) AS BIGINT) AS cm_true_negative,
  CAST(coalesce(sum(CASE WHEN label = 0 AND prediction = 1 THEN n END), 0) AS BIGINT) AS cm_false_positive,
  CAST(coalesce(sum(CASE WHEN label = 1 AND prediction = 0 THEN n END), 0) AS BIGINT) AS cm_false_negative,
  CAST(coalesce(sum(CASE WHEN label = 1 AND prediction = 1 THEN n END), 0) AS BIGINT) AS cm_true_positive"""
QUALITY = """coalesce(CAST(cm_true_positive + cm_true_negative AS DOUBLE)
    / nullif(cm_true_negative + cm_false_positive + cm_false_negative + cm_true_positive, 0), 0.0) AS accuracy,
  coalesce(CAST(cm_true_positive AS DOUBLE) / nullif(cm_true_positive + cm_false_positive, 0), 0.0) AS "precision",
  coalesce(CAST(cm_true_positive AS DOUBLE) / nullif(cm_true_positive + cm_false_negative, 0), 0.0) AS recall,
  coalesce(CAST(2 * cm_true_positive AS DOUBLE) / nullif(2 * cm_true_positive + cm_false_positive + cm_false_negative, 0), 0.0) AS f1_score"""
RATES = """coalesce(CAST(cm_true_negative AS DOUBLE) / nullif(cm_true_negative + cm_false_positive, 0), 0.0) AS tnr,
  coalesce(CAST(cm_false_negative AS DOUBLE) / nullif(cm_false_negative + cm_true_positive, 0), 0.0) AS fnr,
  coalesce(CAST(cm_false_positive AS DOUBLE) / nullif(cm_false_positive + cm_true_negative, 0), 0.0) AS fpr"""


def measured(rows: str, by: str = "", rates: bool = False) -> str:
    """Metrics of (label, prediction, n) rows."""
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {key}cm_true_negative, cm_false_positive, cm_false_negative, cm_true_positive, {QUALITY}{', ' + RATES if rates else ''}
FROM (SELECT {key}{COUNTS} FROM {rows} {group}) m"""


def judged(scored: str, rates: bool = False) -> str:
    """Test metrics of fit -1 and the mean fold accuracy of fits 0 to 4 from (fit, label, prediction, n)."""
    return f"""SELECT m.*, cv.accuracy_crossval FROM ({measured(f"(SELECT * FROM {scored} WHERE fit = -1)", rates=rates)}) m,
(SELECT round(avg(accuracy), 12) AS accuracy_crossval FROM (
  SELECT fit, CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS accuracy
  FROM {scored} WHERE fit >= 0 GROUP BY fit)) cv"""


# ---- bins ------------------------------------------------------------------------------------


def edges(max_bins: int = 256) -> str:
    positions = ", ".join(str(j) for j in range(1, max_bins))
    per_feature = [
        f"""sorted_{i} AS MATERIALIZED (
  SELECT {f} AS v, row_number() OVER (ORDER BY {f}) - 1 AS place, count(*) OVER () AS n FROM folded WHERE split = 'train'),
edges_{i} AS MATERIALIZED (
  SELECT list(DISTINCT v ORDER BY v) AS e FROM sorted_{i}
  WHERE v > (SELECT min(v) FROM sorted_{i})
    AND ((SELECT count(DISTINCT v) FROM sorted_{i}) <= {max_bins}
         OR place IN (SELECT (n * j) // {max_bins} FROM (SELECT unnest([{positions}]) AS j))))"""
        for i, f in enumerate(FEATURES)
    ]
    bins = ", ".join(
        f"CAST(len(list_filter((SELECT e FROM edges_{i}), lambda x: x <= {f})) AS INTEGER) AS b{i}" for i, f in enumerate(FEATURES)
    )
    return ",\n".join(
        [
            *per_feature,
            f"binned AS MATERIALIZED (SELECT row_key, label, split, cv_fold, grid_fold, {bins} FROM folded)",
        ]
    )


VALUED = f"""binned AS MATERIALIZED (
  SELECT row_key, label, split, cv_fold, grid_fold, {", ".join(f"{f} AS b{i}" for i, f in enumerate(FEATURES))} FROM folded)"""
NEXT = "lead(bin) OVER (PARTITION BY {key}, f ORDER BY bin) AS following"
MIDDLE = "CASE WHEN bin / 2 + following / 2 >= following THEN bin ELSE bin / 2 + following / 2 END AS cut"


def cells(fold_col: str) -> str:
    """Weighted cells; fold -1 marks test rows."""
    return f"""cell AS MATERIALIZED (
  SELECT {BIN_COLS}, label, coalesce({fold_col}, -1) AS fold, count(*) AS n FROM binned GROUP BY ALL)"""


def fits(rows: list[tuple]) -> str:
    """(fit, without, rate): fit -1 trains on all folds, fit k leaves out fold k."""
    values = ", ".join(f"({a}, {b}, CAST({c} AS DOUBLE))" for a, b, c in rows)
    return f"fit_list AS (SELECT * FROM (VALUES {values}) AS t(fit, without, rate))"


SIX_FITS = [(k, k, 1.0) for k in range(-1, 5)]

# ---- boosted stumps --------------------------------------------------------------------------


def unpivot(table: str, keep: str, where: str = "TRUE") -> str:
    return " UNION ALL ".join(f"SELECT {keep}, {i} AS f, b{i} AS bin FROM {table} WHERE {where}" for i in F)


def boosted(rounds: int) -> str:
    """State tables boost_0..boost_R with the summed alphas of missed learners and the margin, and the
    learners stump_1..stump_R."""
    parts = [
        f"""boost_0 AS MATERIALIZED (
  SELECT fit, without, rate, {BIN_COLS}, label, fold, n, CAST(0 AS DOUBLE) AS missed, CAST(0 AS DOUBLE) AS margin
  FROM cell, fit_list WHERE fold <> -1 OR fit < 0)"""
    ]
    for r in range(1, rounds + 1):
        weight = "n * exp(missed) AS w"
        parts.append(
            f"""hist_{r} AS MATERIALIZED (
  SELECT fit, any_value(rate) AS rate, f, bin, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS w0, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS w1
  FROM ({unpivot(f"boost_{r - 1}", f"fit, rate, label, {weight}", "fold <> without AND fold >= 0")}) GROUP BY fit, f, bin),
sides_{r} AS (
  SELECT fit, rate, f, bin, sum(w0) OVER upto AS l0, sum(w1) OVER upto AS l1, sum(w0) OVER behind AS r0, sum(w1) OVER behind AS r1,
         {NEXT.format(key="fit")}
  FROM hist_{r} WINDOW upto AS (PARTITION BY fit, f ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       behind AS (PARTITION BY fit, f ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
scored_{r} AS (
  SELECT *, ((l0 + l1) - (l0 * l0 + l1 * l1) / (l0 + l1)) + ((r0 + r1) - (r0 * r0 + r1 * r1) / (r0 + r1)) AS impure, l0 + l1 + r0 + r1 AS t
  FROM sides_{r} WHERE r0 IS NOT NULL),
best_{r} AS (
  SELECT *, {MIDDLE}, CAST(l1 > l0 AS INTEGER) AS left_vote, CAST(r1 > r0 AS INTEGER) AS right_vote,
         (least(l0, l1) + least(r0, r1)) / t AS err
  FROM scored_{r} QUALIFY row_number() OVER (PARTITION BY fit ORDER BY round(impure / t, 9), f, bin) = 1),
stump_{r} AS MATERIALIZED (SELECT *, rate * ln((1 - err) / err) AS alpha FROM best_{r}),
boost_{r} AS MATERIALIZED (
  SELECT fit, without, rate, {BIN_COLS}, label, fold, n, missed + CASE WHEN vote <> label THEN alpha ELSE 0 END AS missed,
         margin + alpha * (2 * vote - 1) AS margin
  FROM (SELECT b.*, s.alpha, CASE WHEN CASE s.f {' '.join(f'WHEN {i} THEN b{i}' for i in F)} END > s.cut THEN right_vote ELSE left_vote END AS vote
        FROM boost_{r - 1} b JOIN stump_{r} s USING (fit)))"""
        )
    return ",\n".join(parts)


def boosted_real(rounds: int) -> str:
    """The real-valued algorithm: a row's log weight falls by half the log-odds for its class, times the rate;
    the vote is the sum of the log-odds."""
    eps = "2.220446049250313e-16"
    odds = lambda side: f"ln(greatest({side}1 / ({side}0 + {side}1), {eps})) - ln(greatest({side}0 / ({side}0 + {side}1), {eps}))"
    text = boosted(rounds)
    text = text.replace("rate * ln((1 - err) / err) AS alpha", f"{odds('l')} AS left_odds, {odds('r')} AS right_odds")
    text = text.replace("missed + CASE WHEN vote <> label THEN alpha ELSE 0 END AS missed", "missed + (0.5 - label) * rate * odds AS missed")
    text = text.replace("margin + alpha * (2 * vote - 1) AS margin", "margin + odds AS margin").replace("s.alpha, ", "")
    return text.replace("THEN right_vote ELSE left_vote END AS vote", "THEN right_odds ELSE left_odds END AS odds")


def stumps(rounds: int) -> str:
    return " UNION ALL ".join(f"SELECT {r} AS round, * FROM stump_{r}" for r in range(1, rounds + 1))


def boosted_votes(r: int) -> str:
    """Held-out (fit, label, prediction, n) after round r; fits below -1 count as their own test fits."""
    return f"""(SELECT fit, label, CAST(margin > 1e-9 AS INTEGER) AS prediction, n FROM boost_{r}
  WHERE (fit < 0 AND fold = -1) OR (fit >= 0 AND fold = without))"""


# ---- decision tree ---------------------------------------------------------------------------


def tree(depth: int) -> str:
    """Greedy Gini trees for all fits at once; node numbers follow the heap order."""
    parts = [
        f"""at_0 AS MATERIALIZED (
  SELECT fit, without, {BIN_COLS}, label, fold, n, CAST(0 AS BIGINT) AS node, (fold >= 0 AND fold <> without) AS training
  FROM cell, fit_list WHERE fold <> -1 OR fit < 0)"""
    ]
    for level in range(depth + 1):
        parts.append(
            f"""node_{level} AS MATERIALIZED (
  SELECT fit, node, sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS n0, sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS n1
  FROM at_{level} WHERE training GROUP BY fit, node)"""
        )
        if level == depth:
            break
        parts.append(
            f"""tree_hist_{level} AS MATERIALIZED (
  SELECT fit, node, f, bin, CAST(sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS DOUBLE) AS c0, CAST(sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS DOUBLE) AS c1
  FROM ({unpivot(f"at_{level}", "fit, node, label, n", "training AND node IS NOT NULL")}) GROUP BY fit, node, f, bin),
tree_sides_{level} AS (
  SELECT fit, node, f, bin, sum(c0) OVER upto AS l0, sum(c1) OVER upto AS l1, sum(c0) OVER behind AS r0, sum(c1) OVER behind AS r1,
         {NEXT.format(key="fit, node")}
  FROM tree_hist_{level} WINDOW upto AS (PARTITION BY fit, node, f ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       behind AS (PARTITION BY fit, node, f ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
tree_gain_{level} AS (
  SELECT *, ((l0 + l1 - (l0 * l0 + l1 * l1) / (l0 + l1)) + (r0 + r1 - (r0 * r0 + r1 * r1) / (r0 + r1))) / t AS score,
         (t - ((l0 + r0) * (l0 + r0) + (l1 + r1) * (l1 + r1)) / t) / t AS whole
  FROM (SELECT *, l0 + l1 + r0 + r1 AS t FROM tree_sides_{level} WHERE r0 IS NOT NULL)
  WHERE l0 + r0 > 0 AND l1 + r1 > 0),
cut_{level} AS MATERIALIZED (
  SELECT fit, node, f, {MIDDLE}, greatest(0, whole - score) AS gain FROM tree_gain_{level}
  QUALIFY row_number() OVER (PARTITION BY fit, node ORDER BY round(score, 9), f, bin) = 1),
at_{level + 1} AS MATERIALIZED (
  SELECT a.fit, a.without, {BIN_COLS}, a.label, a.fold, a.n, a.training,
         2 * a.node + 1 + CAST(CASE c.f {' '.join(f'WHEN {i} THEN b{i}' for i in F)} END > c.cut AS BIGINT) AS node
  FROM at_{level} a LEFT JOIN cut_{level} c ON c.fit = a.fit AND c.node = a.node)"""
        )
    return ",\n".join(parts)


def tree_path(depth: int) -> str:
    """Held-out cells with the nodes m0..mD they pass, NULL below the last."""
    cut_of = lambda level: (
        f"2 * m{level} + 1 + CAST(CASE c.f {' '.join(f'WHEN {i} THEN b{i}' for i in F)} END > c.cut AS BIGINT) AS m{level + 1}"
    )
    parts = [
        f"""walk_0 AS (
  SELECT fit, {BIN_COLS}, label, n, CAST(0 AS BIGINT) AS m0 FROM at_0 WHERE (fit < 0 AND fold = -1) OR (fit >= 0 AND fold = without))"""
    ]
    for level in range(depth):
        parts.append(
            f"walk_{level + 1} AS (SELECT w.*, {cut_of(level)} FROM walk_{level} w LEFT JOIN cut_{level} c ON c.fit = w.fit AND c.node = m{level})"
        )
    joins = " ".join(f"LEFT JOIN node_{v} k{v} ON k{v}.fit = w.fit AND k{v}.node = w.m{v}" for v in range(depth + 1))
    stats = ", ".join(f"k{v}.n0 AS z{v}, k{v}.n1 AS o{v}" for v in range(depth + 1))
    parts.append(f"walked AS MATERIALIZED (SELECT w.fit, w.label, w.n, {stats} FROM walk_{depth} w {joins})")
    return ",\n".join(parts)


def tree_votes(depth: int, min_split: int = 2) -> str:
    """(fit, label, prediction, n) of the tree cut at a depth and at nodes with too few rows."""
    out = f"CAST(o{depth} > z{depth} AS INTEGER)"
    for v in reversed(range(depth)):
        last = f"z{v + 1} IS NULL OR z{v} + o{v} < {min_split}"
        out = f"CASE WHEN {last} THEN CAST(o{v} > z{v} AS INTEGER) ELSE {out} END"
    return f"(SELECT fit, label, {out} AS prediction, n FROM walked)"


def tree_importances(depth: int) -> str:
    """Impurity decrease of every inner node of fit -1."""
    inner = " UNION ALL ".join(
        f"SELECT c.f, c.gain * (k.n0 + k.n1) AS fall FROM cut_{v} c JOIN node_{v} k ON k.fit = c.fit AND k.node = c.node WHERE c.fit = -1"
        for v in range(depth)
    )
    return f"inner_nodes AS ({inner})"


# ---- random forest ---------------------------------------------------------------------------

# Poisson steps: a 16-bit number reaches as many of them as its row is drawn times
DRAW_STEPS = [int(65536 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(8)]


def _hash16(text: str, at: str) -> str:
    """The 16 bits number ``at`` of the md5 of ``text``."""
    return f"CAST('0x' || substr(md5({text}), 1 + 4 * ({at}), 4) AS INTEGER)"


def forest(trees: int, depth: int, looked_at: int = 2) -> str:
    """Gini trees on Poisson bootstraps of the training rows, all at once; a node is its path of L and R."""
    u = _hash16(f"'{SEED}:boot:' || (tree // 8) || ':' || row_key", "tree % 8")
    times = " + ".join(f"CAST(u >= {t} AS INTEGER)" for t in DRAW_STEPS)
    parts = [
        f"grove AS (SELECT unnest(range({trees})) AS tree)",
        f"""drawn AS (
  SELECT tree, {BIN_COLS}, label, {times} AS w FROM (SELECT tree, {BIN_COLS}, label, {u} AS u FROM binned, grove WHERE split = 'train')),
wood_0 AS MATERIALIZED (
  SELECT tree, {BIN_COLS}, label, CAST(sum(w) AS DOUBLE) AS w, '' AS path FROM drawn WHERE w > 0 GROUP BY tree, {BIN_COLS}, label)""",
    ]
    ones = "SELECT tree, path, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS n0, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS n1"
    for v in range(depth + 1):
        parts.append(f"stem_{v} AS MATERIALIZED ({ones} FROM wood_{v} GROUP BY tree, path)")
        if v == depth:
            break
        u = _hash16(f"'{SEED}:' || tree || ':' || path || ':0'", "f")
        parts.append(
            f"""ring_{v} AS MATERIALIZED (
  SELECT tree, path, f, bin, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS c0, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS c1
  FROM ({unpivot(f"wood_{v}", "tree, path, label, w")}) JOIN (SELECT tree, path FROM stem_{v} WHERE n0 > 0 AND n1 > 0) USING (tree, path)
  GROUP BY tree, path, f, bin),
several_{v} AS (
  SELECT tree, path, f, count(*) > 1 AS several, row_number() OVER (PARTITION BY tree, path ORDER BY {u}, f) AS place
  FROM ring_{v} GROUP BY tree, path, f),
looked_{v} AS (
  SELECT tree, path, f FROM (
    SELECT *, bool_or(several AND place <= {looked_at}) OVER mine AS enough,
           min(CASE WHEN several THEN place END) OVER mine AS next FROM several_{v} WINDOW mine AS (PARTITION BY tree, path))
  WHERE several AND (place <= {looked_at} OR (NOT enough AND place = next))),
bent_{v} AS (
  SELECT tree, path, f, bin, sum(c0) OVER upto AS l0, sum(c1) OVER upto AS l1, sum(c0) OVER behind AS r0, sum(c1) OVER behind AS r1,
         {NEXT.format(key="tree, path")}
  FROM ring_{v} JOIN looked_{v} USING (tree, path, f)
  WINDOW upto AS (PARTITION BY tree, path, f ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         behind AS (PARTITION BY tree, path, f ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
saw_{v} AS MATERIALIZED (
  SELECT tree, path, f, {MIDDLE}, t * greatest(0, whole - score) AS fall FROM (
    SELECT *, ((l0 + l1 - (l0 * l0 + l1 * l1) / (l0 + l1)) + (r0 + r1 - (r0 * r0 + r1 * r1) / (r0 + r1))) / t AS score,
           (t - ((l0 + r0) * (l0 + r0) + (l1 + r1) * (l1 + r1)) / t) / t AS whole
    FROM (SELECT *, l0 + l1 + r0 + r1 AS t FROM bent_{v} WHERE r0 IS NOT NULL))
  QUALIFY row_number() OVER (PARTITION BY tree, path ORDER BY round(score, 9), f, bin) = 1),
wood_{v + 1} AS MATERIALIZED (
  SELECT a.tree, {BIN_COLS}, a.label, a.w, a.path || CASE WHEN {_bin_of('c')} > c.cut THEN 'R' ELSE 'L' END AS path
  FROM wood_{v} a JOIN saw_{v} c ON c.tree = a.tree AND c.path = a.path)"""
        )
    return ",\n".join(parts)


def _bin_of(cut: str) -> str:
    return f"CASE {cut}.f {' '.join(f'WHEN {i} THEN b{i}' for i in F)} END"


def forest_votes(trees: int, depth: int) -> str:
    """(b0.., prediction) per test cell: the share of class 1 where the row stops in each tree, averaged."""
    parts = [f"visit_0 AS (SELECT tree, {BIN_COLS}, '' AS path FROM (SELECT DISTINCT {BIN_COLS} FROM binned WHERE split = 'test'), grove)"]
    stops = []
    for v in range(depth + 1):
        cut = f"LEFT JOIN saw_{v} c ON c.tree = a.tree AND c.path = a.path" if v < depth else ""
        stops.append(
            f"SELECT {BIN_COLS}, a.tree, n1 / (n0 + n1) AS share FROM visit_{v} a JOIN stem_{v} s ON s.tree = a.tree AND s.path = a.path {cut}"
            + (" WHERE c.f IS NULL" if v < depth else "")
        )
        if v < depth:
            parts.append(
                f"""visit_{v + 1} AS MATERIALIZED (
  SELECT a.tree, {BIN_COLS}, a.path || CASE WHEN {_bin_of('c')} > c.cut THEN 'R' ELSE 'L' END AS path
  FROM visit_{v} a JOIN saw_{v} c ON c.tree = a.tree AND c.path = a.path)"""
            )
    parts.append(f"answer AS (SELECT {BIN_COLS}, CAST(sum(share) > {trees} / 2.0 + 1e-9 AS INTEGER) AS prediction FROM ({' UNION ALL '.join(stops)}) GROUP BY {BIN_COLS})")
    return ",\n".join(parts)


def forest_importances(depth: int) -> str:
    """(f, raw): shares of the fall per tree, averaged over the trees."""
    inner = " UNION ALL ".join(f"SELECT tree, f, fall FROM saw_{v}" for v in range(depth))
    return f"""falls AS MATERIALIZED ({inner}),
per_tree AS (SELECT tree, f, sum(fall) / (SELECT sum(fall) FROM falls g WHERE g.tree = falls.tree) AS share FROM falls GROUP BY tree, f),
per_feature AS (SELECT f, sum(share) / (SELECT sum(share) FROM per_tree) AS raw FROM per_tree GROUP BY f)"""


# ---- logistic regression ---------------------------------------------------------------------

FACTORS = [0.02, 0.00001, 10.0, 10.0]  # the chain works on scaled features and scales back


def newton(rounds: int = 9) -> str:
    """Newton steps for all fits of ``fit_list`` (``rate`` holds C), parameters per fit in theta_R."""
    size = len(FEATURES) + 1
    xs = ["1.0", *[f"{f} * {c!r}" for f, c in zip(FEATURES, FACTORS)]]
    scaled = ", ".join(f"CAST({x} AS DOUBLE) AS x{i}" for i, x in enumerate(xs))
    parts = [
        f"scaled AS MATERIALIZED (SELECT row_key, label, split, cv_fold, grid_fold, {scaled} FROM folded)",
        "theta_0 AS MATERIALIZED (SELECT fit, without, rate, "
        + ", ".join(f"CAST(0 AS DOUBLE) AS w{i}" for i in range(size))
        + " FROM fit_list)",
    ]
    penalty = [0.0, *[c * c for c in FACTORS]]
    for r in range(1, rounds + 1):
        z = " + ".join(f"w{i} * x{i}" for i in range(size))
        gradient = ", ".join(f"rate * sum((p - label) * x{i}) + {penalty[i]!r} * any_value(w{i}) AS g{i}" for i in range(size))
        hessian = ", ".join(
            f"rate * sum(p * (1 - p) * x{i} * x{j}){f' + {penalty[i]!r}' if i == j else ''} AS h{i}{j}"
            for i in range(size)
            for j in range(i, size)
        )
        keep = "fit, without, rate, " + ", ".join(f"any_value(w{i}) AS w{i}" for i in range(size))
        parts.append(
            f"""sums_{r} AS MATERIALIZED (
  SELECT {keep}, {gradient}, {hessian}
  FROM (SELECT s.*, t.*, 1 / (1 + exp(-({z}))) AS p FROM scaled s, theta_{r - 1} t
        WHERE s.split = 'train' AND (t.without < 0 OR s.FOLDCOL <> t.without))
  GROUP BY fit, without, rate)"""
        )
        parts.append(f"theta_{r} AS MATERIALIZED ({_solved(f'sums_{r}', size)})")
    return ",\n".join(parts)


def _solved(table: str, size: int) -> str:
    """w - H⁻¹ g by elimination, one nested select per pivot."""
    keep = ["fit", "without", "rate", *[f"w{i}" for i in range(size)]]
    h = {(i, j): f"h{i}{j}" for i in range(size) for j in range(i, size)}
    source = table
    done = []
    for k in range(size):
        columns = [*keep, *done, f"g{k}", *[h[k, j] for j in range(k, size)]]
        for i in range(k + 1, size):
            m = f"({h[k, i]} / {h[k, k]})"
            columns.append(f"g{i} - {m} * g{k} AS g{i}")
            columns += [f"{h[i, j]} - {m} * {h[k, j]} AS {h[i, j]}" for j in range(i, size)]
        done += [f"g{k}", *[h[k, j] for j in range(k, size)]]
        source = f"(SELECT {', '.join(columns)} FROM {source})"
    for k in reversed(range(size)):
        known = "".join(f" - {h[k, j]} * d{j}" for j in range(k + 1, size))
        source = f"(SELECT *, (g{k}{known}) / {h[k, k]} AS d{k} FROM {source})"
    return f"SELECT fit, without, rate, {', '.join(f'w{i} - d{i} AS w{i}' for i in range(size))} FROM {source}"


def linear_votes(r: int, fold_col: str) -> str:
    size = len(FEATURES) + 1
    z = " + ".join(f"w{i} * x{i}" for i in range(size))
    return f"""(SELECT t.fit, s.label, CAST({z} > 0 AS INTEGER) AS prediction, count(*) AS n FROM scaled s, theta_{r} t
  WHERE (t.fit < 0 AND s.split = 'test') OR (t.fit >= 0 AND s.{fold_col} = t.without) GROUP BY ALL)"""
