"""Null models: covariate combinations, fits, selection by AIC.

All candidate models are fitted together. Each partition of the subject table
adds up every model's cross products; a pass over the data yields one Newton
step for all of them. Only sums of covariate size leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genolith.operators.blocks import from_bytes, sum_blocks, to_bytes


def outcome_family(outcome: str) -> Column:
    """Aggregate: gaussian when any value differs from 0 and 1, else binomial."""
    other = F.bool_or((F.col(outcome) != 0) & (F.col(outcome) != 1))
    return F.when(F.coalesce(other, F.lit(False)), "gaussian").otherwise("binomial")


def table_family(assoc: DataFrame) -> str:
    """Case/control results carry a case count."""
    return "cc" if {"n.cases", "n_cases"} & set(assoc.columns) else "quant"


def covariate_combinations(spark: SparkSession, groups: list[str], n_pcs: int | None = None) -> DataFrame:
    """All non-empty subsets, smaller ones first, as (model_index, covariates).

    With ``n_pcs`` every subset is repeated with the first 0..n_pcs components.
    """
    names = F.array(*[F.lit(g) for g in groups])
    bits = F.expr(f"filter(sequence(0, {len(groups) - 1}), i -> getbit(id, i) = 1)")
    masks = spark.range(1, 1 << len(groups)).withColumn("bits", bits)
    subsets = masks.select(
        F.struct(F.size("bits").alias("n"), "bits").alias("_order"),
        F.transform("bits", lambda i: F.element_at(names, i + 1)).alias("covariates"),
    )
    if n_pcs is not None:
        subsets = subsets.withColumn("n_pcs", F.explode(F.sequence(F.lit(0), F.lit(n_pcs))))
        pcs = F.expr("CASE WHEN n_pcs > 0 THEN transform(sequence(1, n_pcs), i -> concat('pc', i)) ELSE array() END")
        subsets = subsets.withColumn("covariates", F.concat("covariates", pcs.cast("array<string>")))
    # The list is as long as the number of subsets, never as the data.
    order = ["n_pcs", "_order"] if n_pcs is not None else ["_order"]
    return subsets.withColumn("model_index", F.row_number().over(W.orderBy(*order))).drop("_order")


@dataclass
class FittedModel:
    """One fixed-effects fit; ``columns`` starts with the intercept."""

    name: str
    columns: list[str]
    family: str
    n: int = 0
    coefficients: np.ndarray | None = None
    dispersion: float = 1.0
    aic: float | None = None
    converged: bool = False
    error: str | None = None
    groups: list[str] = field(default_factory=list)


INTERCEPT = "(intercept)"


def _design(pdf: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return np.column_stack([np.ones(len(pdf)) if c == INTERCEPT else pdf[c].to_numpy(dtype=float) for c in columns])


def _pass(data: DataFrame, outcome: str, models: list[FittedModel], current: dict[int, np.ndarray]) -> DataFrame:
    """Cross products of every model in ``current`` over its complete rows."""
    specs = [(i, models[i].columns, models[i].family, beta) for i, beta in current.items()]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for pdf in batches:
            y_all = pdf[outcome].to_numpy(dtype=float)
            for i, columns, family, beta in specs:
                x = _design(pdf, columns)
                ok = ~np.isnan(y_all) & ~np.isnan(x).any(axis=1)
                x, y = x[ok], y_all[ok]
                if family == "gaussian":
                    w, z, fit = np.ones(len(y)), y, float(y @ y)
                else:
                    eta = x @ beta
                    mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -30, 30)))
                    w = np.maximum(mu * (1 - mu), 1e-12)
                    z = eta + (y - mu) / w
                    fit = float(-2 * np.sum(np.where(y > 0, np.log(np.maximum(mu, 1e-300)), np.log(np.maximum(1 - mu, 1e-300)))))
                part = np.concatenate([[len(y), fit], (x * w[:, None]).T @ z, ((x * w[:, None]).T @ x).ravel()])
                totals[i] = totals.get(i, 0) + part
        for i, part in totals.items():
            yield pd.DataFrame({"model": [i], "block": [to_bytes(part)]})

    needed = sorted({c for m in models for c in m.columns if c != INTERCEPT})
    numeric = data.select(F.col(outcome).cast("double").alias(outcome), *[F.col(f"`{c}`").cast("double").alias(c) for c in needed if c != outcome])
    return sum_blocks(numeric.mapInPandas(sums, "model int, block binary"), ["model"], "block")


FACTOR = "="


def factor_levels(data: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Indicator columns of the text and yes/no columns among ``columns``: ``name=level``.

    Levels are taken in order and the first, the base, has none; their number must be
    small, as each becomes a column.
    """
    kinds = dict(data.dtypes)
    out = {}
    for column in columns:
        if kinds.get(column) == "boolean":
            out[column] = [f"{column}{FACTOR}true"]
        elif kinds.get(column) == "string":
            levels = [r[0] for r in data.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(MOST_LEVELS + 1).collect()]
            if len(levels) > MOST_LEVELS:
                raise ValueError(f"{column} has over {MOST_LEVELS} levels; it cannot be a covariate")
            out[column] = [f"{column}{FACTOR}{level}" for level in levels[1:]]
    return out


def with_factors(data: DataFrame, columns: list[str]) -> DataFrame:
    """``data`` with the indicator columns among ``columns`` that it lacks; a missing value stays missing."""
    new = {}
    for name in columns:
        if FACTOR in name and name not in data.columns:
            column, level = name.split(FACTOR, 1)
            new[name] = (F.col(column).cast("string") == level).cast("double")
    return data.withColumns(new) if new else data


MOST_LEVELS = 100


def fit_models(data: DataFrame, outcome: str, covariate_sets: dict[str, list[str]], family: str | None = None,
               max_iterations: int = 25) -> list[FittedModel]:
    """Fit every covariate set; a singular or diverging fit keeps its reason.

    Text and yes/no covariates become treatment-coded columns.
    """
    if family is None:
        family = data.agg(outcome_family(outcome)).first()[0]
    levels = factor_levels(data, sorted({c for columns in covariate_sets.values() for c in columns}))
    covariate_sets = {name: [x for c in columns for x in levels.get(c, [c])] for name, columns in covariate_sets.items()}
    data = with_factors(data, [c for columns in levels.values() for c in columns])
    models = [FittedModel(name, [INTERCEPT, *columns], family) for name, columns in covariate_sets.items()]
    current = {i: np.zeros(len(m.columns)) for i, m in enumerate(models)}
    deviance = {i: math.inf for i in current}
    for _ in range(max_iterations):
        if not current:
            break
        for row in _pass(data, outcome, models, current).toLocalIterator():
            i, part = row["model"], from_bytes(row["block"])
            model, p = models[i], len(models[i].columns)
            n, fit, xy, xx = int(part[0]), part[1], part[2 : 2 + p], part[2 + p :].reshape(p, p)
            model.n = n
            if n <= p or np.linalg.matrix_rank(xx, hermitian=True) < p:
                model.error = "singular"
                del current[i]
                continue
            beta = np.linalg.solve(xx, xy)
            if family == "gaussian":
                rss = max(fit - beta @ xy, 0.0)
                model.coefficients, model.converged = beta, rss > 0
                model.dispersion = rss / (n - p)
                model.aic = n * (math.log(2 * math.pi) + math.log(rss / n) + 1) + 2 * (p + 1) if rss > 0 else None
                model.error = None if rss > 0 else "perfect fit"
                del current[i]
            else:
                # ``fit`` is the deviance of the coefficients that went in.
                settled = abs(fit - deviance[i]) / (abs(fit) + 0.1) < 1e-8
                if settled:
                    model.converged, model.aic = True, fit + 2 * p
                    del current[i]
                elif np.abs(beta).max() > 30:
                    del current[i]
                else:
                    deviance[i], current[i], model.coefficients = fit, beta, beta
    return models


def models_table(spark: SparkSession, models: list[FittedModel]) -> DataFrame:
    """One row per candidate: name, covariates, n, aic, converged, error."""
    rows = [(m.name, m.columns[1:], m.family, m.n, None if m.aic is None else float(m.aic), bool(m.converged), m.error) for m in models]
    return spark.createDataFrame(
        rows, "model string, covariates array<string>, family string, n int, aic double, converged boolean, error string")


def fit_summary(models: DataFrame) -> DataFrame:
    """How many candidates succeeded, failed to converge or died, by message."""
    status = F.when(F.col("error").isNotNull(), "error").when(F.col("converged"), "succeeded").otherwise("not converged")
    return models.groupBy(status.alias("status"), "error").agg(F.count(F.lit(1)).alias("n"))


def best_model(models: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Smallest AIC among the converged; ties go to the first name."""
    rest = [c for c in models.columns if c not in (by or [])]
    order = ["aic", *[c for c in ("model", *rest) if c != "aic" and c in rest]]
    order = list(dict.fromkeys(order))
    picked = models.where("converged AND aic IS NOT NULL").groupBy(*(by or [])).agg(F.min(F.struct(*order)).alias("m"))
    return picked.select(*(by or []), *[F.col(f"m.{c}").alias(c) for c in rest])


def expand(groups: dict[str, list[str]], names: list[str]) -> list[str]:
    return list(dict.fromkeys(c for n in names for c in groups.get(n, [n])))


#: Subsets after which the swept matrix is built anew, so that rounding does not add up.
SWEEPS_KEPT = 64
LEAST_PIVOT = 1e-11


def _sweep(a: np.ndarray, k: int, back: bool = False) -> None:
    """Sweep row and column k of a symmetric matrix in place, or undo it."""
    d, row = a[k, k], a[k].copy()
    a -= np.outer(row, row) / d
    a[k] = a[:, k] = -row / d if back else row / d
    a[k, k] = -1.0 / d


def _pattern_products(data: DataFrame, outcome: str, always: list[str], grouped: list[list[str]]) -> dict[int, np.ndarray]:
    """Cross products of (1, columns, outcome) by which groups a row has gaps in, a bit each; one pass over the rows."""
    columns = [*always, *[c for g in grouped for c in g]]
    places, at = [], 1 + len(always)
    for g in grouped:
        places.append(list(range(at, at + len(g))))
        at += len(g)
    fixed = len(always)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), pdf.to_numpy(dtype=float)])
            gap = np.isnan(x)
            ok = ~gap[:, -1] & ~gap[:, : 1 + fixed].any(1)
            bits = sum((gap[:, own].any(1).astype(np.int64) << i for i, own in enumerate(places)), np.zeros(len(x), np.int64))
            x = np.where(gap, 0.0, x)
            for pattern in np.unique(bits[ok]).tolist():
                own = x[ok & (bits == pattern)]
                totals[pattern] = totals.get(pattern, 0) + own.T @ own
        for pattern, part in totals.items():
            yield pd.DataFrame({"pattern": [pattern], "block": [to_bytes(part)]})

    numeric = data.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)], F.col(outcome).cast("double").alias("y"))
    size = len(columns) + 2
    rows = sum_blocks(numeric.mapInPandas(sums, "pattern long, block binary"), ["pattern"], "block").toLocalIterator()
    return {row["pattern"]: from_bytes(row["block"], size, size).copy() for row in rows}


def sweep_subsets(data: DataFrame, outcome: str, groups: dict[str, list[str]], always: list[str] | None = None) -> dict[int, FittedModel]:
    """Least-squares fits of every non-empty subset of the groups (by bit mask), each over its own complete rows.

    One pass adds up a cross product per pattern of gaps, of which there are no more than subsets. The subsets that use
    the same patterns are walked in Gray-code order: the next one differs by a group, which is swept in or out.
    """
    names = list(groups)
    levels = factor_levels(data, sorted({*(always or []), *(c for columns in groups.values() for c in columns)}))
    wide = lambda columns: [x for c in columns for x in levels.get(c, [c])]
    fixed = wide(always or [])
    grouped = [[c for c in wide(groups[g]) if c not in fixed] for g in names]
    data = with_factors(data, [*fixed, *(c for g in grouped for c in g)])
    products = _pattern_products(data, outcome, fixed, grouped)
    starts = np.cumsum([1 + len(fixed), *map(len, grouped)])
    y = int(starts[-1])

    by_patterns: dict[tuple[int, ...], list[int]] = {}
    for i in range(1, 1 << len(names)):
        mask = i ^ (i >> 1)
        by_patterns.setdefault(tuple(p for p in products if not p & mask), []).append(mask)
    out: dict[int, FittedModel] = {}
    for patterns, masks in by_patterns.items():
        base = sum((products[p] for p in patterns), np.zeros((y + 1, y + 1)))
        n = int(round(base[0, 0]))
        state, swept, since = None, 0, 0
        for mask in masks:
            chosen = [g for b, g in enumerate(names) if mask >> b & 1]
            columns = list(dict.fromkeys([*(c for b, g in enumerate(grouped) if mask >> b & 1 for c in g), *fixed]))
            model = out[mask] = FittedModel("", [INTERCEPT, *columns], "gaussian", n, groups=chosen)
            p = len(model.columns)
            if n <= p:
                model.error = "singular"
                continue
            if state is None or since >= SWEEPS_KEPT:
                state, swept, since = base.copy(), 0, 0
                if not all(_swept_in(state, base, k) for k in range(1 + len(fixed))):
                    model.error, state = "singular", None
                    continue
            fine = True
            for b in range(len(names)):
                own = range(int(starts[b]), int(starts[b + 1]))
                if swept >> b & 1 and not mask >> b & 1:
                    for k in own:
                        _sweep(state, k, back=True)
            for b in range(len(names)):
                if fine and mask >> b & 1 and not swept >> b & 1:
                    fine = all(_swept_in(state, base, k) for k in range(int(starts[b]), int(starts[b + 1])))
            swept, since = mask, since + 1
            if not fine:
                model.error, state = "singular", None
                continue
            places = {c: int(starts[b]) + i for b, g in enumerate(grouped) for i, c in enumerate(g)} | {c: 1 + i for i, c in enumerate(fixed)} | {INTERCEPT: 0}
            rss = float(state[y, y])
            if rss <= 1e-12 * base[y, y]:
                model.error = "perfect fit"
                continue
            model.coefficients = np.array([state[y, places[c]] for c in model.columns])
            model.dispersion, model.converged = rss / (n - p), True
            model.aic = n * (math.log(2 * math.pi) + math.log(rss / n) + 1) + 2 * (p + 1)
    return out


def _swept_in(state: np.ndarray, base: np.ndarray, k: int) -> bool:
    """Sweep k unless it is, up to rounding, a combination of those swept in before."""
    if not state[k, k] > LEAST_PIVOT * base[k, k]:
        return False
    _sweep(state, k)
    return True


def exhaustive_search(data: DataFrame, outcome: str, groups: dict[str, list[str]], always: list[str] | None = None,
                      family: str | None = None) -> list[FittedModel]:
    """Every non-empty subset of the covariate groups plus the ``always`` columns: one pass for gaussian outcomes, Newton passes for yes/no ones."""
    if family is None:
        family = data.agg(outcome_family(outcome)).first()[0]
    spark, bit = data.sparkSession, {g: 1 << i for i, g in enumerate(groups)}
    subsets = covariate_combinations(spark, list(groups)).select("model_index", "covariates").collect()
    owned = [c for columns in groups.values() for c in columns]
    if family == "gaussian" and len(owned) == len(set(owned)):
        fits = sweep_subsets(data, outcome, groups, always)
        fitted = [fits[sum(bit[g] for g in row["covariates"])] for row in subsets]
        for model, row in zip(fitted, subsets):
            model.name = f"{row['model_index']:04d}"
    else:
        sets = {f"{row['model_index']:04d}": expand(groups, row["covariates"]) + (always or []) for row in subsets}
        fitted = fit_models(data, outcome, sets, family)
    for model, row in zip(fitted, subsets):
        model.groups = list(row["covariates"])
    return fitted


def forward_selection(data: DataFrame, outcome: str, groups: dict[str, list[str]], family: str | None = None) -> FittedModel:
    """Add the group that lowers AIC most until none does."""
    if family is None:
        family = data.agg(outcome_family(outcome)).first()[0]
    current = fit_models(data, outcome, {"": []}, family)[0]
    chosen: list[str] = []
    while True:
        left = [g for g in groups if g not in chosen]
        fits = fit_models(data, outcome, {g: expand(groups, [*chosen, g]) for g in left}, family) if left else []
        usable = [m for m in fits if m.converged and m.aic is not None]
        if not usable:
            break
        best = min(usable, key=lambda m: m.aic)
        if current.aic is not None and best.aic >= current.aic:
            break
        chosen.append(best.name)
        current = best
    current.groups = chosen
    return current
