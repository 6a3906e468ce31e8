"""Saddlepoint tails of score tests for yes/no traits.

The score of a variant is a sum of independent terms g_i (y_i - mu_i), g adjusted for the covariates. Where
the normal tail is not to be trusted, beyond ``cutoff`` standard deviations, its cumulant
function is inverted by the Lugannani-Rice formula on both sides. Only subjects who carry the rarer allele or lack
a call are listed per variant; all others add their second, third and fourth cumulants,
which come from cohort sums less those of the listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erfc, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.functions.special import chi2_1_sf
from genolith.operators.association import ScoreModel, score_sums
from genolith.operators.blocks import from_bytes, sum_blocks, to_bytes
from genolith.session import broadcast_if_small, durable

#: Standardised scores below this keep the normal tail.
CUTOFF = 2.0
STEPS = 100


def bernoulli_cumulants(mu: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Second to fourth cumulants of yes/no outcomes."""
    w = mu * (1 - mu)
    return w, w * (1 - 2 * mu), w * (1 - 6 * w)


def cumulant_function(t: float, g: np.ndarray, mu: np.ndarray, rest: tuple[float, float, float]) -> tuple[float, float, float]:
    """(K, K', K'') at t of the sum of g (y - mu) and a remainder with the given second to fourth cumulants."""
    x = t * g
    # log(1 - mu + mu e^x) without overflow on either side
    k = np.where(x > 0, x + np.log(mu + (1 - mu) * np.exp(-np.abs(x))), np.log1p(mu * np.expm1(np.minimum(x, 0)))) - mu * x
    tilted = mu / (mu + (1 - mu) * np.exp(-np.clip(x, -700, 700)))
    k2, k3, k4 = rest
    return (float(k.sum()) + t * t * (k2 / 2 + t * (k3 / 6 + t * k4 / 24)),
            float((g * (tilted - mu)).sum()) + t * (k2 + t * (k3 / 2 + t * k4 / 6)),
            float((g * g * tilted * (1 - tilted)).sum()) + k2 + t * (k3 + t * k4 / 2))


def saddlepoint(score: float, g: np.ndarray, mu: np.ndarray, rest: tuple[float, float, float]) -> float | None:
    """The t with K'(t) = score, None where the sum cannot come that far. Newton steps kept inside a bracket."""
    low, high = (0.0, 1.0) if score > 0 else (-1.0, 0.0)
    for _ in range(60):
        edge = high if score > 0 else low
        slope = cumulant_function(edge, g, mu, rest)[1]
        if (slope >= score) if score > 0 else (slope <= score):
            break
        if score > 0:
            low, high = high, 2 * high
        else:
            low, high = 2 * low, low
    else:
        return None
    t = (low + high) / 2
    for _ in range(STEPS):
        _, slope, curve = cumulant_function(t, g, mu, rest)
        if slope > score:
            high = t
        else:
            low = t
        step = t - (slope - score) / curve if curve > 0 else low - 1
        new = step if low < step < high else (low + high) / 2
        if abs(new - t) <= 1e-13 * max(1.0, abs(new)):
            return new
        t = new
    return t


def tail(score: float, g: np.ndarray, mu: np.ndarray, rest: tuple[float, float, float]) -> float | None:
    """P(sum >= score) for a positive score, P(sum <= score) for a negative one, by Lugannani and Rice."""
    t = saddlepoint(score, g, mu, rest)
    if t is None:
        return 0.0
    k, _, curve = cumulant_function(t, g, mu, rest)
    inner = 2 * (t * score - k)
    if inner <= 0 or curve <= 0 or t == 0:
        return None
    w = np.sign(t) * sqrt(inner)
    v = t * sqrt(curve)
    if v / w <= 0:
        return None
    z = w + log(v / w) / w
    return 0.5 * erfc(abs(z) / sqrt(2)) if z * score > 0 else None


def two_sided(score: float, variance: float, g: np.ndarray, mu: np.ndarray, rest: tuple[float, float, float]) -> tuple[float, bool]:
    """(p, whether both tails came from the saddlepoint); the normal tail stands in where the formula fails."""
    normal = 0.5 * erfc(abs(score) / sqrt(2 * variance))
    tails = [tail(s, g, mu, rest) for s in (abs(score), -abs(score))]
    return min(1.0, sum(normal if x is None else x for x in tails)), None not in tails


def _power_sums(table: DataFrame, z: list[str]) -> dict[int, np.ndarray]:
    """Cohort sums of r-fold products of the orthonormal covariates times the r-th cumulant, r = 2..4, as tensors of covariate size."""
    p = len(z)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(p**2 + p**3 + p**4)
        for pdf in batches:
            x = pdf[z].to_numpy(dtype=float)
            pairs = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
            second, third, fourth = bernoulli_cumulants(pdf["mu"].to_numpy(dtype=float))
            total += np.concatenate([pairs.T @ second, ((pairs * third[:, None]).T @ x).ravel(), ((pairs * fourth[:, None]).T @ pairs).ravel()])
        yield pd.DataFrame({"one": [0], "block": [to_bytes(total)]})

    flat = from_bytes(sum_blocks(table.select("mu", *z).mapInPandas(sums, "one int, block binary"), ["one"], "block").first()["block"])
    return {2: flat[: p**2].reshape((p,) * 2), 3: flat[p**2: p**2 + p**3].reshape((p,) * 3), 4: flat[p**2 + p**3:].reshape((p,) * 4)}


def _contracted(tensor: np.ndarray, c: np.ndarray) -> float:
    """Sum over the cohort of (z . c)^r times the r-th cumulant."""
    while tensor.ndim:
        tensor = tensor @ c
    return float(tensor)


def saddlepoint_test(entries: DataFrame, model: ScoreModel, cutoff: float = CUTOFF) -> DataFrame:
    """variant_key, n_obs, freq, score, score_var, score_stat, score_pval (normal), spa_pval and spa (whether both tails are the saddlepoint's).

    ``model`` is a logistic score model. ``entries`` has a row per variant and subject, with a null call where there is none; those count at the
    variant's mean. Below the cutoff ``spa_pval`` is the normal p-value. One variant's listed subjects, a few numbers each, are
    together in a task; carriers are those of the rarer allele, so at most half of the cohort besides missing calls.
    """
    if model.family != "binomial":
        raise ValueError("the saddlepoint correction is for yes/no traits")
    p = len(model.z)
    mu = (F.col("outcome") - F.col("resid")).alias("mu")
    table = durable(model.table.select("sample_key", mu, *model.z))
    sums = _power_sums(table, model.z)
    totals = np.array([model.totals[z] for z in model.z])
    scored = durable(score_sums(entries, model))
    plain = scored.select("variant_key", "n_obs", (F.col("mean") / 2).alias("freq"), "score", F.when(F.col("_v") > 1e-9, F.col("_v")).alias("score_var"))
    plain = plain.withColumn("score_stat", F.col("score") / F.sqrt("score_var")).withColumn("score_pval", chi2_1_sf(F.col("score_stat") * F.col("score_stat")))

    far = scored.where((F.col("_v") > 1e-9) & (F.abs(F.col("score")) >= cutoff * F.sqrt("_v")))
    # Counted by the rarer allele: g becomes 2 - g, the score changes its sign and so do the projections, up to those of the constant.
    flip = F.col("mean") > 1
    flipped = [F.when(flip, 2 * float(totals[i]) - F.col("zg")[i]).otherwise(F.col("zg")[i]).alias(f"c_{i}") for i in range(p)]
    wanted = durable(far.select("variant_key", flip.alias("flip"), F.when(flip, 2 - F.col("mean")).otherwise(F.col("mean")).alias("m"), *flipped,
                                F.when(flip, -F.col("score")).otherwise(F.col("score")).alias("s"), F.col("_v").alias("v")))
    dose = F.when(F.col("gt").isNull(), F.col("m")).when(F.col("flip"), 2.0 - F.col("gt")).otherwise(F.col("gt").cast("double"))
    fitted = sum((F.col(f"c_{i}") * F.col(model.z[i]) for i in range(1, p)), F.col("c_0") * F.col(model.z[0]))
    listed = entries.select("variant_key", "sample_key", "gt").join(broadcast_if_small(wanted), "variant_key").withColumn("g", dose).where("g > 0")
    listed = listed.join(broadcast_if_small(table.select("sample_key", "mu", *model.z)), "sample_key").withColumn("fit", fitted).select(
        "variant_key", "s", "v", *[f"c_{i}" for i in range(p)], (F.col("g") - F.col("fit")).alias("g"), "fit", "mu")

    def solve(rows: pa.Table) -> tuple:
        first = {name: rows.column(name)[0].as_py() for name in ["variant_key", "s", "v", *[f"c_{i}" for i in range(p)]]}
        g, fit, m = (rows.column(c).to_numpy() for c in ("g", "fit", "mu"))
        c = np.array([first[f"c_{i}"] for i in range(p)])
        # A subject who is not listed has g = -fit.
        rest = tuple((-1) ** r * (_contracted(sums[r], c) - float((fit**r * k).sum())) for r, k in zip((2, 3, 4), bernoulli_cumulants(m)))
        value, both = two_sided(first["s"], first["v"], g, m, (max(rest[0], 0.0), rest[1], rest[2]))
        return first["variant_key"], value, both

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def packed(found: list[tuple]) -> pa.RecordBatch:
            a, b, c = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.float64()), pa.array(c, pa.bool_())], ["variant_key", "spa", "both"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = held.column("variant_key").to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if len(cuts):
                yield packed([solve(held.slice(a, z - a)) for a, z in zip([0, *cuts[:-1].tolist()], cuts.tolist())])
                held = held.slice(int(cuts[-1]))
        if held is not None:
            yield packed([solve(held)])

    solved = listed.repartition("variant_key").sortWithinPartitions("variant_key").mapInArrow(run, "variant_key long, spa double, both boolean")
    return plain.join(solved, "variant_key", "left").select(
        *plain.columns, F.coalesce("spa", "score_pval").alias("spa_pval"), F.coalesce("both", F.lit(False)).alias("spa"))
