"""Colocalisation of two association signals per probe."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genolith.functions.special import normal_upper_quantile
from genolith.operators.intervals import range_join
from genolith.operators.ranking import exact_quantile
from genolith.operators.sumstats import alleles_match, complete_cases, filter_sumstats
from genolith.session import broadcast_if_small, durable

# Prior probabilities, prior standard deviations and prior
# variances of the averaged Bayes factor.
P1, P2, P12 = 1e-4, 1e-4, 1e-6
SD_QUANT, SD_CC, SD_PVALUE = 0.15, 0.2, 0.44
AVERAGED_VARIANCES = [0.01, 0.1, 0.5]

HYPOTHESES = range(5)


# --- Bayes factors -----------------------------------------------------------


def var_data(f: Column, n: Column) -> Column:
    return F.lit(1.0) / (2 * n * f * (1 - f))


def var_data_cc(f: Column, n: Column, s: Column) -> Column:
    return F.lit(1.0) / (2 * n * f * (1 - f) * s * (1 - s))


def var_from_z(z: Column, n: Column, maf: Column, s: Column | None = None) -> Column:
    information = 2 * maf * (1 - maf) * (n + z * z)
    return F.lit(1.0) / (information if s is None else information * s * (1 - s))


def log_abf(z: Column, v: Column, prior_variance: float) -> Column:
    """Wakefield's log approximate Bayes factor."""
    r = F.lit(prior_variance) / (F.lit(prior_variance) + v)
    return 0.5 * (F.log(1 - r) + r * z * z)


def log_sum(*terms: Column) -> Column:
    """log of a sum of exponentials over a few columns."""
    top = F.greatest(*terms)
    return top + F.log(sum((F.exp(t - top) for t in terms[1:]), F.exp(terms[0] - top)))


def log_diff(x: Column, y: Column) -> Column:
    """log |exp(x) - exp(y)|."""
    top, low = F.greatest(x, y), F.least(x, y)
    return top + F.log(-F.expm1(low - top))


def trait_sd(df: DataFrame, varbeta: Column, maf: Column, n: Column, beta: Column) -> DataFrame:
    """One row: square root of the median of per-variant trait variances."""
    information = 2 * maf * (1 - maf) * n
    variance = (information * varbeta * (n - 1) + information * beta * beta) / (n - 1)
    return exact_quantile(df.select(variance.alias("_v")), "_v", 0.5, out="_m").select(F.sqrt("_m").alias("sd_y"))


# --- matching ----------------------------------------------------------------

POSITION_ID = "^[0-9]{1,2}[:][1-9][0-9]*$"


def bare_chromosome(df: DataFrame) -> DataFrame:
    return df.withColumn("CHR", F.regexp_replace("CHR", "chr", ""))


def best_key(biom: DataFrame, eqtl: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Use the ids or positions that match most markers of the two sets.

    The ids stay unless matching positions finds more; returns both tables
    with the chosen SNPID and the name of the choice.
    """
    def has_other_ids(df: DataFrame) -> bool:
        return not df.where(~F.col("SNPID").rlike(POSITION_ID)).isEmpty()

    place = F.concat_ws(":", "CHR", F.col("POS").cast("string"))
    add_biom, add_eqtl = has_other_ids(biom), has_other_ids(eqtl)
    ids = lambda df, c: df.select(c.alias("k")).distinct()
    common = lambda a, b: a.join(b, "k", "left_semi").count()
    biom_ids, eqtl_ids = ids(biom, F.col("SNPID")), ids(eqtl, F.col("SNPID"))
    counts = {"snpid": common(biom_ids, eqtl_ids), "mixed": 0, "chrpos": 0}
    if add_biom:
        counts["mixed"] = common(ids(biom, place), eqtl_ids)
    elif add_eqtl:
        counts["mixed"] = common(ids(eqtl, place), biom_ids)
    if add_biom and add_eqtl:
        counts["chrpos"] = common(ids(biom, place), ids(eqtl, place))
    choice = max(counts, key=lambda k: counts[k])
    if choice == "chrpos" or (choice == "mixed" and add_biom):
        biom = biom.withColumn("SNPID", place)
    if choice == "chrpos" or (choice == "mixed" and not add_biom):
        eqtl = eqtl.withColumn("SNPID", place)
    return biom, eqtl, choice


def probe_extent(eqtl: DataFrame) -> DataFrame:
    """Chromosome, first and last position and smallest p of a probe."""
    return eqtl.groupBy("ProbeID").agg(
        F.min("CHR").alias("chrom"), F.min("POS").alias("pos_start"), F.max("POS").alias("pos_end"), F.min("PVAL").alias("min_p"))


def locus_variants(biom: DataFrame, extents: DataFrame) -> DataFrame:
    """Variants between the first and the last position of each probe."""
    named = extents.withColumnsRenamed({"chrom": "CHR"})
    return range_join(biom, named, pos="POS", start="pos_start", end="pos_end", contig="CHR")


def remove_duplicates(df: DataFrame, keys: list[str], order: Column, ties: list[str]) -> DataFrame:
    """Of every repeated marker drop the row with the largest ``order``, keep the others."""
    w = W.partitionBy(*keys)
    ranked = df.withColumns({
        "_n": F.count(F.lit(1)).over(w),
        "_rn": F.row_number().over(w.orderBy(order.desc(), *ties)),
    })
    return ranked.where((F.col("_n") == 1) | (F.col("_rn") > 1)).drop("_n", "_rn")


def allele_length() -> Column:
    return F.length("A1") + F.length("A2")


def split_by_region(merged: DataFrame, bed: DataFrame) -> DataFrame:
    """Rows of each LD block; ``bed`` has CHR, start_pos, end_pos, bed_region."""
    return range_join(merged, bed, pos="POS_biom", contig="CHR", start="start_pos", end="end_pos").drop("start_pos", "end_pos")


@dataclass
class ColocOptions:
    p12: float = P12
    use_beta: bool = True
    match_snpid: bool = False
    min_snps: int = 50
    cc: bool = False
    odds_ratios: bool | None = None  # None: effects are odds ratios when a locus has none below 0


def merged_loci(eqtl: DataFrame, biom: DataFrame, options: ColocOptions, bed: DataFrame | None = None) -> DataFrame:
    """Shared variants of every probe with compatible alleles.

    The two sets meet on the marker within a probe's span; both are thinned of
    duplicates per probe first.
    """
    eqtl, biom = bare_chromosome(eqtl), bare_chromosome(biom)
    bed = None if bed is None else bare_chromosome(bed)
    if "MAF" in eqtl.columns or "F" in eqtl.columns:
        eqtl = filter_sumstats(eqtl)
    else:
        biom = filter_sumstats(biom)
    need = ["SNPID", "CHR", "POS", "PVAL", "N", "A1", "A2"] + (["BETA", "SE"] if options.use_beta else [])
    maf = lambda df: [c for c in ("MAF",) if c in df.columns]
    upper = {"A1": F.upper("A1"), "A2": F.upper("A2")}
    # Both sets are read several times below: written once, narrowed and complete.
    eqtl = durable(complete_cases(eqtl.select("ProbeID", *need, *maf(eqtl))).withColumns(upper))
    biom = durable(complete_cases(biom.select(*need, *maf(biom), *(["Ncases"] if options.cc else []))).withColumns(upper))
    if not options.match_snpid:
        biom, eqtl, _ = best_key(biom, eqtl)

    extents = probe_extent(eqtl)
    wanted = eqtl.select("ProbeID", "SNPID").distinct().join(extents, "ProbeID")
    at_locus = biom.join(wanted, "SNPID").where(
        (F.col("CHR") == F.col("chrom")) & F.col("POS").between(F.col("pos_start"), F.col("pos_end")))
    ties = ["A1", "A2", "PVAL"]
    at_locus = remove_duplicates(at_locus, ["ProbeID", "SNPID"], allele_length(), ties)
    probes = remove_duplicates(eqtl, ["ProbeID", "SNPID"], allele_length(), ties)

    names = ["ProbeID", "SNPID", "chrom", "pos_start", "pos_end"]
    left = at_locus.select(*names, *[F.col(c).alias(f"{c}_biom") for c in at_locus.columns if c not in [*names, "min_p"]])
    right = probes.select("ProbeID", "SNPID", *[F.col(c).alias(f"{c}_eqtl") for c in probes.columns if c not in ("ProbeID", "SNPID")])
    merged = left.join(right, ["ProbeID", "SNPID"]).where(
        alleles_match(F.col("A1_biom"), F.col("A2_biom"), F.col("A1_eqtl"), F.col("A2_eqtl")))
    if "MAF_eqtl" not in merged.columns:
        merged = merged.withColumn("MAF_eqtl", F.col("MAF_biom"))
    if "MAF_biom" not in merged.columns:
        merged = merged.withColumn("MAF_biom", F.col("MAF_eqtl"))
    if not options.use_beta:
        merged = merged.where((F.col("PVAL_biom") > 0) & (F.col("PVAL_eqtl") > 0))
    merged = durable(remove_duplicates(merged, ["ProbeID", "SNPID"], F.col("MAF_eqtl"), ["A1_biom", "A2_biom", "A1_eqtl", "A2_eqtl"]))
    enough = merged.groupBy("ProbeID").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > options.min_snps).select("ProbeID")
    merged = merged.join(broadcast_if_small(enough), "ProbeID", "left_semi").withColumn("CHR", F.col("CHR_biom"))
    if bed is not None:
        return split_by_region(merged, bed)
    return merged.withColumn("bed_region", F.lit(None).cast("string"))


LOCUS = ["ProbeID", "bed_region"]


def bayes_factors(merged: DataFrame, options: ColocOptions) -> DataFrame:
    """Log Bayes factors of both signals and their sum per variant."""
    c = F.col
    cases = c("Ncases_biom") / c("N_biom") if options.cc else None
    if options.use_beta:
        beta = c("BETA_biom")
        if options.cc and options.odds_ratios is not False:
            if options.odds_ratios is None:
                lowest = merged.groupBy("ProbeID", F.coalesce("bed_region", F.lit("")).alias("_r")).agg(F.min("BETA_biom").alias("_low"))
                merged = merged.withColumn("_r", F.coalesce("bed_region", F.lit(""))).join(broadcast_if_small(lowest), ["ProbeID", "_r"]).drop("_r")
                beta = F.when(c("_low") >= 0, F.log(F.when(c("BETA_biom") > 0, c("BETA_biom")))).otherwise(c("BETA_biom"))
            else:
                beta = F.log(beta)
        staged = merged.withColumns({"_z1": beta / c("SE_biom"), "_v1": c("SE_biom") * c("SE_biom"), "_z2": c("BETA_eqtl") / c("SE_eqtl")})
        prior = (SD_CC if options.cc else SD_QUANT) ** 2
    else:
        # The variances of the p-value path need no z-score.
        v = var_data(c("MAF_biom"), c("N_biom")) if cases is None else var_data_cc(c("MAF_biom"), c("N_biom"), cases)
        staged = merged.withColumns({"_h1": c("PVAL_biom") / 2, "_h2": c("PVAL_eqtl") / 2, "_v1": v})
        staged = staged.withColumns({"_z1": normal_upper_quantile(c("_h1")), "_z2": normal_upper_quantile(c("_h2"))}).drop("_h1", "_h2")
        prior = SD_PVALUE**2
    # Each step names its results, so no long expression is written out twice.
    staged = staged.withColumn("_z2", F.coalesce(F.nanvl("_z2", F.lit(0.0)), F.lit(0.0)))
    staged = staged.withColumn("_v2", var_from_z(c("_z2"), c("N_eqtl"), c("MAF_eqtl")))
    staged = staged.withColumns({
        "lABF_biom": log_abf(c("_z1"), c("_v1"), prior),
        **{f"_a{i}": log_abf(c("_z2"), c("_v2"), w) for i, w in enumerate(AVERAGED_VARIANCES)},
    })
    staged = staged.withColumn("lABF_eqtl", log_sum(c("_a0"), c("_a1"), c("_a2")) - math.log(3))
    temporary = ["_z1", "_v1", "_z2", "_v2", "_a0", "_a1", "_a2", "_low"]
    return staged.withColumn("lABF_sum", c("lABF_biom") + c("lABF_eqtl")).drop(*temporary)


MEASURES = {"l1": "lABF_biom", "l2": "lABF_eqtl", "l12": "lABF_sum"}


def locus_sums(factors: DataFrame, keys: list[str] = LOCUS) -> DataFrame:
    """Log sums per locus: maxima first, then sums of scaled exponentials.

    Lead variants are the smallest p-value of each signal and the largest
    joint factor; ties go to the first id.
    """
    c = F.col
    places = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_{k}") for k in keys]
    tagged = factors.select("*", *places)
    by = [f"_{k}" for k in keys]
    lead = tagged.groupBy(*by).agg(
        *[F.first(k).alias(k) for k in [*keys, "chrom", "pos_start", "pos_end"]],
        F.count(F.lit(1)).alias("nsnps"),
        F.min(F.struct("PVAL_biom", "SNPID"))["SNPID"].alias("snp_biom"),
        F.min(F.struct("PVAL_eqtl", "SNPID"))["SNPID"].alias("snp_eqtl"),
        F.min("PVAL_biom").alias("min_pval_biom"), F.min("PVAL_eqtl").alias("min_pval_eqtl"),
        F.min(F.struct((-c("lABF_sum")).alias("m"), c("SNPID").alias("s")))["s"].alias("best_causal"),
        *[F.max(col).alias(f"_max_{m}") for m, col in MEASURES.items()],
    )
    lead = broadcast_if_small(durable(lead))
    sums = tagged.select(*by, *MEASURES.values()).join(lead.select(*by, *[f"_max_{m}" for m in MEASURES]), by).groupBy(*by).agg(
        *[F.sum(F.exp(c(col) - c(f"_max_{m}"))).alias(f"_sum_{m}") for m, col in MEASURES.items()])
    joined = lead.join(sums, by)
    return joined.withColumns({m: c(f"_max_{m}") + F.log(f"_sum_{m}") for m in MEASURES}).drop(
        *by, *[f"_max_{m}" for m in MEASURES], *[f"_sum_{m}" for m in MEASURES])


def locus_likelihoods(sums: DataFrame) -> DataFrame:
    """lH0..lH4 scaled by the number of variants."""
    c, n = F.col, F.log(F.col("nsnps").cast("double"))
    return sums.withColumns({
        "lH0_abf": F.lit(0.0), "lH1_abf": c("l1") - n, "lH2_abf": c("l2") - n,
        "lH3_abf": log_diff(c("l1") + c("l2"), c("l12")) - 2 * n, "lH4_abf": c("l12") - n})


def posteriors(terms: list[Column]) -> list[Column]:
    total = log_sum(*terms)
    return [F.exp(t - total) for t in terms]


def coloc_posterior(sums: DataFrame, p1: float = P1, p2: float = P2, p12: float = 1e-5) -> DataFrame:
    """Posterior of the five hypotheses under fixed priors."""
    c = F.col
    terms = [F.lit(0.0), c("l1") + math.log(p1), c("l2") + math.log(p2),
             log_diff(c("l1") + c("l2"), c("l12")) + math.log(p1) + math.log(p2), c("l12") + math.log(p12)]
    return sums.withColumns({f"PP{h}_coloc_priors": p for h, p in zip(HYPOTHESES, posteriors(terms))})


def snp_posterior(factors: DataFrame, sums: DataFrame) -> DataFrame:
    """Probability of each variant to be the shared one (per-variant output)."""
    key = lambda df: df.withColumn("_r", F.coalesce("bed_region", F.lit("")))
    totals = key(sums).select("ProbeID", "_r", "l12")
    return key(factors).join(broadcast_if_small(totals), ["ProbeID", "_r"]).withColumn("SNP_PP_H4", F.exp(F.col("lABF_sum") - F.col("l12"))).drop("_r", "l12")


#: Folders of the per-variant output; a probe's rows are in one of them.
PROBE_PARTS = 64


def write_snp_results(factors: DataFrame, sums: DataFrame, path: str) -> None:
    """Per-variant output, sorted by probe within a bounded number of folders."""
    parted = snp_posterior(factors, sums).withColumn("probe_part", F.pmod(F.xxhash64("ProbeID"), F.lit(PROBE_PARTS)).cast("int"))
    parted.sortWithinPartitions("probe_part", "ProbeID").write.mode("overwrite").partitionBy("probe_part").parquet(path)


# --- genome-wide priors ------------------------------------------------------

LIKELIHOODS = [f"lH{h}_abf" for h in HYPOTHESES]


def _poisson_weights(key: np.ndarray, replicate: int) -> np.ndarray:
    """Poisson(1) counts from a hash, so every pass draws the same ones."""
    mixed = (key.astype(np.uint64) ^ np.uint64((replicate * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    u = (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53
    cumulative = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(cumulative, u).astype(np.float64)


def _mixture_sums(likelihoods: DataFrame, log_weights: dict[int, np.ndarray], bootstrap: bool) -> dict[int, np.ndarray]:
    """Per point: rows, log-likelihood, summed and crossed responsibilities."""
    points = list(log_weights.items())

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for pdf in batches:
            l = pdf[LIKELIHOODS].to_numpy(dtype=float)
            l[:, 0] = 0.0
            key = pdf["_key"].to_numpy()
            for i, lw in points:
                w = _poisson_weights(key, i) if bootstrap else np.ones(len(l))
                x = l + lw
                top = x.max(axis=1, keepdims=True)
                e = np.exp(x - top)
                s = e.sum(axis=1, keepdims=True)
                r = e / s
                value = w @ (top + np.log(s)).ravel()
                part = np.concatenate([[w.sum(), value], w @ r, ((r * w[:, None]).T @ r).ravel()])
                totals[i] = totals.get(i, 0) + part
        for i, part in totals.items():
            yield pd.DataFrame([[i, *part]], columns=["point", *[f"v{k}" for k in range(32)]])

    schema = "point int, " + ", ".join(f"v{k} double" for k in range(32))
    summed = likelihoods.mapInPandas(sums, schema).groupBy("point").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(32)])
    return {row["point"]: np.array(row[1:], dtype=float) for row in summed.collect()}


def _softmax_weights(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log prior weights and their derivative, five free parameters."""
    w = a - a.max()
    pi = np.exp(w) / np.exp(w).sum()
    return np.log(pi), np.eye(5) - pi[None, :]


def _product_weights(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four parameters; two distinct signals weigh the product of the single ones."""
    terms = np.array([a[0], a[1], a[2], a[3], a[1] + a[2]])
    pi = np.exp(terms - terms.max())
    pi /= pi.sum()
    log_s = terms.max() + math.log(np.exp(terms - terms.max()).sum())
    ds = np.array([pi[0], pi[1] + pi[4], pi[2] + pi[4], pi[3]])
    base = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 1, 1, 0], [0, 0, 0, 1]], dtype=float)
    times = np.array([1, 1, 1, 2, 1])
    weights = np.array([a[0], a[1], a[2], a[1] + a[2], a[3]]) - times * log_s
    return weights, base - times[:, None] * ds[None, :]


# Mean and standard deviation of the normal penalty on the priors.
PENALTY_MEAN = np.array([2.0, -2.0, -2.0, -2.0, -2.0])
PENALTY_SD = 3.0


def _maximise(likelihoods: DataFrame, starts: dict[int, np.ndarray], weights, penalised: bool, bootstrap: bool, rounds: int = 500) -> dict[int, np.ndarray]:
    """Scoring steps with step halving; one Spark job per round for all points.

    A point leaves when its value has settled. Raises if some have not after ``rounds``.
    """
    best = {i: a.copy() for i, a in starts.items()}
    state: dict[int, tuple] = {}
    trial = dict(best)
    step = {i: 1.0 for i in best}
    active = set(best)

    for _ in range(rounds):
        if not active:
            break
        wanted = {i: weights(trial[i])[0] for i in active}
        for i, part in _mixture_sums(likelihoods, wanted, bootstrap).items():
            n, value, r, rr = part[0], part[1], part[2:7], part[7:].reshape(5, 5)
            a = trial[i]
            jac = weights(a)[1]
            grad = jac.T @ r
            info = jac.T @ rr @ jac
            if weights is _softmax_weights:
                # Exact curvature where the surface is concave.
                pi = np.exp(wanted[i])
                curvature = n * (np.diag(pi) - np.outer(pi, pi)) - (np.diag(r) - rr)
                if np.linalg.eigvalsh(curvature + np.eye(5) / PENALTY_SD**2).min() > 0:
                    info = curvature
            if penalised:
                value += float(np.sum(-0.5 * ((a - PENALTY_MEAN) / PENALTY_SD) ** 2))
                grad -= (a - PENALTY_MEAN) / PENALTY_SD**2
                info += np.eye(len(a)) / PENALTY_SD**2
            if i in state and value < state[i][0] - 1e-12 * abs(state[i][0]):
                step[i] /= 2
            else:
                gain = value - state[i][0] if i in state else math.inf
                state[i] = (value, a, np.linalg.lstsq(info + 1e-9 * np.eye(len(a)), grad, rcond=None)[0])
                best[i] = a
                step[i] = min(1.0, step[i] * 2)
                if gain < 1e-8 * (abs(value) + 1e-8):
                    active.discard(i)
                    continue
            if step[i] < 1e-6:
                active.discard(i)
                continue
            direction = state[i][2]
            longest = np.abs(direction).max()
            trial[i] = state[i][1] + step[i] * direction * min(1.0, 2.0 / longest if longest > 0 else 1.0)
    if active:
        raise RuntimeError(f"{len(active)} of {len(best)} prior fits have not settled after {rounds} rounds")
    return best


def likelihood_table(loci: DataFrame) -> DataFrame:
    """The five-column table of the fit, written once for its many passes."""
    rows = loci.select(F.xxhash64("ProbeID", F.coalesce("bed_region", F.lit(""))).alias("_key"), *LIKELIHOODS)
    table = durable(rows)
    # A task per 50,000 loci is enough; fewer of them make a round shorter.
    return table.coalesce(max(1, min(table.rdd.getNumPartitions(), table.count() // 50000)))


def fit_priors(likelihoods: DataFrame) -> np.ndarray:
    """Genome-wide prior weights of the five hypotheses (penalised maximum)."""
    a = _maximise(likelihoods, {0: np.array([2.0, -2, -2, -2, -2])}, _softmax_weights, True, False)[0]
    return np.exp(_softmax_weights(a)[0])


def fit_priors_four(likelihoods: DataFrame) -> np.ndarray:
    """The four-parameter form without penalty; four weights as reported."""
    a = _maximise(likelihoods, {0: np.array([2.0, -2, -2, -2])}, _product_weights, False, False)[0]
    terms = np.array([a[0], a[1], a[2], a[3], a[1] + a[2]])
    return np.exp(a - terms.max()) / np.exp(terms - terms.max()).sum()


def bootstrap_priors(likelihoods: DataFrame, replicates: int = 1000) -> DataFrame:
    """2.5% and 97.5% bounds of each weight over Poisson-weighted replicates."""
    start = np.array([2.0, -2, -2, -2, -2])
    fits = _maximise(likelihoods, {i + 1: start for i in range(replicates)}, _softmax_weights, True, True)
    sampled = np.array([np.exp(_softmax_weights(a)[0]) for a in fits.values()])
    mle = fit_priors(likelihoods)
    low, high = np.quantile(sampled, [0.025, 0.975], axis=0)
    rows = [(h, float(low[h]), float(mle[h]), float(high[h])) for h in HYPOTHESES]
    return likelihoods.sparkSession.createDataFrame(rows, "hypothesis int, low double, mle double, hi double")


def locus_posteriors(loci: DataFrame, prior: np.ndarray) -> DataFrame:
    """PP.H0..H4 of each locus under the fitted priors."""
    terms = [F.col(c) + math.log(max(float(p), 1e-300)) for c, p in zip(LIKELIHOODS, prior)]
    return loci.withColumns({f"PP_H{h}_abf": p for h, p in zip(HYPOTHESES, posteriors(terms))})


RESULT = ["ProbeID", "chrom", "pos_start", "pos_end", "nsnps", "snp_biom", "snp_eqtl", "min_pval_biom", "min_pval_eqtl", "best_causal",
          *[f"PP{h}_coloc_priors" for h in HYPOTHESES], *LIKELIHOODS, "bed_region"]


def coloc_loci(eqtl: DataFrame, biom: DataFrame, options: ColocOptions = ColocOptions(), bed: DataFrame | None = None) -> DataFrame:
    """Per-locus result under fixed priors (no genome-wide fit)."""
    factors = durable(bayes_factors(merged_loci(eqtl, biom, options, bed), options))
    sums = locus_likelihoods(locus_sums(factors))
    return coloc_posterior(sums, p12=options.p12).select(*RESULT)


def coloc(eqtl: DataFrame, biom: DataFrame, options: ColocOptions = ColocOptions(), bed: DataFrame | None = None) -> DataFrame:
    """Per-locus result with posteriors under the fitted genome-wide priors."""
    loci = durable(coloc_loci(eqtl, biom, options, bed))
    return locus_posteriors(loci, fit_priors(likelihood_table(loci)))


def coloc_report(results: DataFrame, min_h4: float = 0.2, max_p: float = 1e-5) -> DataFrame:
    return results.where((F.col("PP_H4_abf") > min_h4) & (F.col("min_pval_biom") < max_p))
