"""The four model families: how each is fitted, cross-validated and searched.

A grid search fits only what differs. Settings that a larger fit already contains (depth and split
limits of trees, the first trees of a forest, the first rounds of boosting, iteration limits that
were not reached) are read off that fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.boosting import BoostFit, BoostSpec, fit_boosted
from plumbline.operators.growth import GrowSpec
from plumbline.operators.linear import LinearFit, LinearSpec, fit_linear, score_linear
from plumbline.operators.trees import Pruning, TreeFit, forest_spec, tree_spec
from plumbline.plans.prepared import FOLDS, Prepared

# Parameters of the plain training run.
DEFAULTS = {
    "lr": {"C": 1.0, "max_iter": 100},
    "rf": {"n_estimators": 100, "max_depth": 10},
    "adaboost": {"n_estimators": 50, "learning_rate": 1.0},
    "dt": {"max_depth": 10},
}
# The searched grids. ``base_max_depth`` is the depth of the boosted tree.
GRIDS = {
    "lr": {
        "C": [0.01, 0.1, 1.0, 10.0, 100.0],
        "penalty": ["l2"],
        "solver": ["lbfgs", "newton-cg", "sag", "saga"],
        "max_iter": [100, 500, 1000],
    },
    "rf": {
        "n_estimators": [100, 200, 300],
        "max_depth": [25, 50],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt"],
    },
    "adaboost": {
        "n_estimators": [50, 100, 200],
        "learning_rate": [0.01, 0.1, 1.0],
        "base_max_depth": [1, 3, 5],
    },
    "dt": {
        "criterion": ["gini", "entropy"],
        "max_depth": [None, 10, 20, 30],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
}
# The column types of the parameters.
PARAM_TYPES = {
    "lr": {"C": "double", "penalty": "string", "solver": "string", "max_iter": "int"},
    "rf": {
        "n_estimators": "int",
        "max_depth": "int",
        "min_samples_split": "int",
        "min_samples_leaf": "int",
        "max_features": "string",
    },
    "adaboost": {"n_estimators": "int", "learning_rate": "double", "base_max_depth": "int", "algorithm": "string"},
    "dt": {"criterion": "string", "max_depth": "int", "min_samples_split": "int", "min_samples_leaf": "int"},
}
# The long names, in the order that breaks ties.
LONG_NAMES = {
    "lr": "logistic_regression",
    "rf": "random_forest",
    "adaboost": "adaptive_boosting",
    "dt": "decision_tree",
}

# parameters that change how a tree, or a sequence of learners, grows
_GROWTH = ("criterion", "min_samples_leaf", "max_features")
_BOOSTING = ("learning_rate", "base_max_depth", "algorithm")

Score = tuple[int, int, float | None]  # ordinal, fold, accuracy (None where a fit failed)


def cross_validate(p: Prepared, name: str, params: Mapping, fold_col: str = "cv_fold") -> DataFrame:
    """(fold, accuracy) of a family refitted without each fold in turn."""
    return family(name).fit_with_folds(p, params, fold_col)[1]


class Linear:
    name = "lr"

    def units(self, candidates: Sequence[Mapping]) -> list[list[int]]:
        """Candidates that are best scored together: all, as they share every pass."""
        return [list(range(len(candidates)))]

    def fit(self, p: Prepared, params: Mapping) -> LinearFit:
        return fit_linear(p.train, p.features, p.label, F.lit(0), [_linear_spec(params)])[0]

    def fit_with_folds(self, p: Prepared, params: Mapping, fold_col: str) -> tuple[LinearFit, DataFrame]:
        """The fit on all training rows and those without each fold share every pass."""
        specs = [replace(_linear_spec(params), without_fold=k) for k in (None, *range(FOLDS))]
        fits = fit_linear(p.train, p.features, p.label, F.col(fold_col), specs)
        counts = score_linear(p.train, p.features, p.label, F.col(fold_col), specs[1:], fits[1:])
        return fits[0], _fold_frame(p, counts)

    def grid_scores(self, p: Prepared, candidates: Sequence[Mapping], fold_col: str) -> list[Score]:
        """One fit per (C, fold), all in the same passes; it serves every solver, and every larger
        iteration limit once it has converged within a smaller one."""
        settings = [_linear_spec(c) for c in candidates]
        pending = sorted({(s.C, s.max_iter) for s in settings})
        accuracy: dict[tuple[float, int, int], float] = {}
        while pending:
            first = [next(t for t in pending if t[0] == C) for C in sorted({C for C, _ in pending})]
            specs = [LinearSpec(C, limit, k) for C, limit in first for k in range(FOLDS)]
            fold = F.col(fold_col)
            fits = fit_linear(p.train, p.features, p.label, fold, specs)
            counts = score_linear(p.train, p.features, p.label, fold, specs, fits)
            for j, s in enumerate(specs):
                accuracy[s.C, s.max_iter, s.without_fold] = _share_right(counts[counts["fit"] == j])
            served = set(first)
            for C, limit in first:
                if all(f.converged for s, f in zip(specs, fits) if s.C == C):
                    larger = [t for t in pending if t[0] == C]
                    served.update(larger)
                    accuracy |= {(C, t[1], k): accuracy[C, limit, k] for t in larger for k in range(FOLDS)}
            pending = [t for t in pending if t not in served]
        return sorted((i, k, accuracy[s.C, s.max_iter, k]) for i, s in enumerate(settings) for k in range(FOLDS))


class Tree:
    """Decision trees; forests differ in their spec and in growing on single rows."""

    name = "dt"
    keyed = False

    def spec(self, p: Prepared, params: Mapping) -> GrowSpec:
        return tree_spec(seed=p.seed, **params)

    def units(self, candidates: Sequence[Mapping]) -> list[list[int]]:
        """Candidates that are read off the same fits."""
        return _units(candidates, _GROWTH)

    def fit(self, p: Prepared, params: Mapping) -> TreeFit:
        grower = p.grower("cv_fold", self.keyed)
        try:
            return TreeFit(p.features, grower.fits([self.spec(p, params)])[0])
        finally:
            grower.release()

    def fit_with_folds(self, p: Prepared, params: Mapping, fold_col: str) -> tuple[TreeFit, DataFrame]:
        """All fits grow side by side on one table; the folds' are only scored."""
        whole = self.spec(p, params)
        folds = [replace(whole, without_fold=k) for k in range(FOLDS)]
        grower = p.grower(fold_col, self.keyed)
        try:
            fit = TreeFit(p.features, grower.fits([whole])[0])
            counts = grower.scores(folds, [[Pruning()]] * FOLDS, [[whole.n_trees]] * FOLDS)
        finally:
            grower.release()
        return fit, _fold_frame(p, counts)

    def grid_scores(self, p: Prepared, candidates: Sequence[Mapping], fold_col: str) -> list[Score]:
        """One fit per (settings that change the growth, fold), read at every pruning and size."""
        groups = _grouped(candidates, _GROWTH)
        tasks = [(g, k) for g in groups for k in range(FOLDS)]
        specs, prunings, sizes = [], [], []
        for group, k in tasks:
            shared, own = _prunings(group)
            own_sizes = sorted({self.spec(p, c).n_trees for _, c in group})
            largest = {"n_estimators": own_sizes[-1]} if self.keyed else {}
            specs.append(replace(self.spec(p, {**shared, **largest}), without_fold=k))
            prunings.append(list(dict.fromkeys(own)))
            sizes.append(own_sizes)
        grower = p.grower(fold_col, self.keyed)
        try:
            counts = grower.scores(specs, prunings, sizes)
        finally:
            grower.release()
        found = {at: _share_right(part) for at, part in counts.groupby(["fit", "variant", "n_trees"])}
        out = []
        for f, (group, k) in enumerate(tasks):
            for (i, c), pruning in zip(group, _prunings(group)[1]):
                out.append((i, k, found[f, prunings[f].index(pruning), self.spec(p, c).n_trees]))
        return sorted(out)


class Forest(Tree):
    name = "rf"
    keyed = True

    def spec(self, p: Prepared, params: Mapping) -> GrowSpec:
        return forest_spec(len(p.features), seed=p.seed, **params)


class Boosted:
    name = "adaboost"

    def units(self, candidates: Sequence[Mapping]) -> list[list[int]]:
        """Candidates that are read off the same fits."""
        return _units(candidates, _BOOSTING)

    def fit(self, p: Prepared, params: Mapping) -> BoostFit:
        fits, _ = fit_boosted(p.cells(), p.features, [BoostSpec(**params)], p.edges)
        return _started(fits[0])

    def fit_with_folds(self, p: Prepared, params: Mapping, fold_col: str) -> tuple[BoostFit, DataFrame]:
        """The fit on all training rows and those without each fold grow in the same passes."""
        specs = [BoostSpec(**params, without_fold=k) for k in (None, *range(FOLDS))]
        fits, counts = fit_boosted(p.cells(fold_col), p.features, specs, p.edges)
        return _started(fits[0]), _fold_frame(p, counts.assign(fit=counts["fit"] - 1))

    def grid_scores(self, p: Prepared, candidates: Sequence[Mapping], fold_col: str) -> list[Score]:
        """All learning rates, depths and folds are fitted together; the numbers of rounds are read on
        the way. A candidate that cannot start on some fold has no score there."""
        groups = _grouped(candidates, _BOOSTING)
        sizes = sorted({c.get("n_estimators", 50) for c in candidates})
        tasks = [(g, k) for g in groups for k in range(FOLDS)]
        specs = [
            BoostSpec(sizes[-1], g[0][1].get("learning_rate", 1.0), g[0][1].get("base_max_depth", 1), k, g[0][1].get("algorithm", "SAMME"))
            for g, k in tasks
        ]
        _, counts = fit_boosted(p.cells(fold_col), p.features, specs, p.edges, sizes)
        out = []
        for f, (group, k) in enumerate(tasks):
            for i, c in group:
                mine = counts[(counts["fit"] == f) & (counts["n_trees"] == c.get("n_estimators", 50))]
                out.append((i, k, _share_right(mine)))
        return out


FAMILIES = {f.name: f for f in (Linear(), Forest(), Boosted(), Tree())}


def family(name: str):
    """The family of a short name."""
    if name not in FAMILIES:
        raise ValueError(f"model {name!r} is not supported, choose one of {', '.join(FAMILIES)}")
    return FAMILIES[name]


def _linear_spec(params: Mapping) -> LinearSpec:
    settings = dict(params)
    if settings.pop("penalty", "l2") != "l2":
        raise ValueError("the only penalty is 'l2'")
    solver = settings.pop("solver", "lbfgs")
    if solver not in GRIDS["lr"]["solver"]:
        raise ValueError(f"unknown solver {solver!r}")  # all of them reach the same optimum
    return LinearSpec(**settings)


def _started(fit: BoostFit) -> BoostFit:
    if not fit.trees:
        raise ValueError("boosting cannot start: the first learner is no better than a coin")
    return fit


def _fold_frame(p: Prepared, counts) -> DataFrame:
    rows = [(k, _share_right(counts[counts["fit"] == k])) for k in range(FOLDS)]
    return p.spark.createDataFrame(rows, "fold int, accuracy double")


def _share_right(counts) -> float | None:
    if not len(counts):
        return None
    right = counts.loc[counts["label"] == counts["prediction"], "n"].sum()
    return float(right / counts["n"].sum())


def _grouped(candidates: Sequence[Mapping], names: Sequence[str]) -> list[list[tuple[int, Mapping]]]:
    """Candidates, with their ordinals, that agree on the named parameters."""
    groups: dict[tuple, list] = {}
    for i, c in enumerate(candidates):
        groups.setdefault(tuple(c.get(n) for n in names), []).append((i, c))
    return list(groups.values())


def _units(candidates: Sequence[Mapping], names: Sequence[str]) -> list[list[int]]:
    return [[i for i, _ in group] for group in _grouped(candidates, names)]


def _prunings(group) -> tuple[dict, list[Pruning]]:
    """The settings of the fit that contains all candidates of a group, and each one's pruning."""
    first = group[0][1]
    leaf = first.get("min_samples_leaf", 1)
    shared = {k: first[k] for k in ("criterion", "min_samples_leaf", "max_features") if k in first}
    depths = [c.get("max_depth") for _, c in group]
    shared["max_depth"] = None if None in depths else max(depths)
    return shared, [Pruning(c.get("max_depth"), max(c.get("min_samples_split", 2), 2 * leaf)) for _, c in group]
