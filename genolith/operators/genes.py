"""Gene tests over range-joined variants.

A gene may hold very many variants, so its genotypes are cut to chunks. Each
chunk is residualised on the null model once; burden vectors are sums of
chunks, and the trace of the squared covariance is a sum over chunk pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genolith.functions.special import chi2_1_sf, chi2_4_sf
from genolith.operators.association import ScoreModel, score_sums, score_test
from genolith.operators.blocks import TILE, from_bytes, map_rows, sample_tiles, sum_blocks, to_bytes
from genolith.operators.intervals import range_join
from genolith.operators.ranking import adjust_p
from genolith.session import broadcast_if_small, durable, keep_listed

CHUNK = 256


def gene_variants(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene_id, variant_key) for every variant inside a gene's range."""
    return range_join(variants.select("variant_key", "contig", "pos"), genes.select("gene_id", "contig", "start_pos", "end_pos")).select(
        "gene_id", "variant_key")


def gene_burden(entries: DataFrame, members: DataFrame, subjects: DataFrame) -> DataFrame:
    """Alternate alleles per gene and sample: (gene_id, sample_key, burden).

    Only the calls of variants inside a gene are read further, and the calls are never the broadcast side.
    """
    members = durable(members)
    return (
        keep_listed(entries.where(F.col("gt").isNotNull()), members, "variant_key")
        .join(broadcast_if_small(members), "variant_key")
        .join(broadcast_if_small(subjects.select("sample_key")), "sample_key", "left_semi")
        .groupBy("gene_id", "sample_key")
        .agg(F.sum("gt").alias("burden"))
    )


def gene_counts(burden: DataFrame, members: DataFrame) -> DataFrame:
    """Sites, alternate alleles and carriers per gene."""
    sites = members.groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_site"))
    carried = burden.groupBy("gene_id").agg(F.sum("burden").alias("n_alt"), F.count_if(F.col("burden") > 0).alias("n_sample_alt"))
    return sites.join(carried, "gene_id", "left")


def burden_scores(entries: DataFrame, members: DataFrame, model: ScoreModel) -> DataFrame:
    """Score test of the summed genotype, missing calls at the variant's mean.

    The burden's score is the sum of its variants' scores; its variance comes
    from one weighted sum per gene over the per-sample burdens.
    """
    # Only variants inside a gene are read further.
    members = durable(members)
    entries = keep_listed(entries, members, "variant_key")
    mean = durable(members.join(score_test(entries, model).select("variant_key", "score", "freq"), "variant_key"))
    missing = (
        entries.where(F.col("gt").isNotNull()).join(broadcast_if_small(mean.select("variant_key", "gene_id", "freq")), "variant_key")
        .groupBy("gene_id", "sample_key").agg(F.sum(F.col("gt") - 2 * F.col("freq")).alias("b"))
    )
    w, b = F.col("weight"), F.col("b")
    sums = missing.join(broadcast_if_small(model.table), "sample_key").groupBy("gene_id").agg(
        F.sum(w * b * b).alias("_wbb"), F.sum(w * b).alias("_wb"), *[F.sum(w * b * F.col(z)).alias(f"_{z}") for z in model.z])
    # Subtracting the mean shifts every sample alike; the intercept takes it out again.
    variance = F.col("_wbb")
    for z in model.z:
        variance = variance - F.col(f"_{z}") * F.col(f"_{z}")
    per_gene = mean.groupBy("gene_id").agg(F.sum("score").alias("burden_score"))
    out = per_gene.join(sums, "gene_id").select("gene_id", "burden_score", variance.alias("burden_var"))
    out = out.withColumn("burden_stat", F.when(F.col("burden_var") > 1e-9, F.col("burden_score") / F.sqrt("burden_var")))
    return out.withColumn("burden_pval", chi2_1_sf(F.col("burden_stat") * F.col("burden_stat")))


def upper_gamma(shape: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma function, vectorised.

    Below the shape the series is summed, above it the continued fraction, each
    until its terms no longer change the result.
    """
    shape, x = np.broadcast_arrays(np.asarray(shape, float), np.asarray(x, float))
    log_front = shape * np.log(np.maximum(x, 1e-300)) - x - np.vectorize(math.lgamma, otypes=[float])(shape)
    result = np.full(x.shape, np.nan)
    low = x < shape + 1
    s, y = shape[low], np.maximum(x[low], 0.0)
    term = 1.0 / s
    series, k = term.copy(), 0
    while len(s) and np.any(term > 1e-16 * series):
        k += 1
        term = term * y / (s + k)
        series += term
    result[low] = 1.0 - np.exp(log_front[low]) * series
    high = x >= shape + 1
    s, y = shape[high], x[high]
    b = y + 1.0 - s
    c, d = np.full_like(y, 1e300), 1.0 / np.where(np.abs(b) < 1e-300, 1e-300, b)
    h, delta, k = d.copy(), np.full_like(y, 2.0), 0
    while len(s) and np.any(np.abs(delta - 1) > 1e-14):
        k += 1
        a = -k * (k - s)
        b = b + 2.0
        d = a * d + b
        d = 1.0 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + a / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        delta = d * c
        h = h * delta
    with np.errstate(over="ignore", under="ignore"):
        result[high] = np.exp(log_front[high]) * h
    return np.where(x <= 0, 1.0, np.clip(result, 0.0, 1.0))


@F.pandas_udf(T.DoubleType())
def _mixture_tail(q: pd.Series, trace: pd.Series, trace_sq: pd.Series) -> pd.Series:
    """Chi-square mixture with matched mean and variance."""
    scale = trace_sq / trace
    ok = (trace > 1e-9) & (trace_sq > 1e-18)
    out = np.full(len(q), np.nan)
    out[ok] = upper_gamma((trace[ok] / scale[ok] / 2).to_numpy(), (q[ok] / scale[ok] / 2).to_numpy())
    return pd.Series(out)


def _subject_tiles(model: ScoreModel, tiles: DataFrame) -> DataFrame:
    """(t, weight, z0, ...): arrays of one sample tile; weight 0 marks an empty place."""
    names = ["weight", *model.z]
    placed = model.table.select("sample_key", *names).join(tiles, "sample_key")
    packed = placed.groupBy("t").agg(F.array_sort(F.collect_list(F.struct("ls", *names))).alias("s"))
    return packed.select("t", F.col("s.ls").alias("ls"), *[F.col(f"s.{c}").alias(f"s_{c}") for c in names])


def residual_tiles(entries: DataFrame, members: DataFrame, stats: DataFrame, model: ScoreModel, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """(gene_id, chunk, t, n, h): genotypes with the null model's covariates taken out.

    h holds at most ``chunk`` variants by ``tile`` samples (rows in variant
    order); summed over the tiles, h h' is the covariance of the scores.
    """
    tiles, _ = sample_tiles(model.table, tile)
    sizes = members.groupBy("gene_id").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("n_chunks"))
    placed = members.join(sizes, "gene_id").select(
        "gene_id", "variant_key", F.pmod(F.xxhash64("variant_key"), F.col("n_chunks")).cast("int").alias("chunk"))
    placed = durable(placed.join(stats, "variant_key"))
    lists = placed.groupBy("gene_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("variant_key", "mean", "zg"))).alias("v")).select(
        "gene_id", "chunk", F.col("v.variant_key").alias("keys"), F.col("v.mean").alias("means"), F.flatten("v.zg").alias("zg"))
    calls = (
        entries.where(F.col("gt").isNotNull()).select("variant_key", "sample_key", "gt")
        .join(broadcast_if_small(placed.select("gene_id", "chunk", "variant_key")), "variant_key")
        .join(broadcast_if_small(tiles), "sample_key")
    )
    packed = calls.groupBy("gene_id", "chunk", "t").agg(
        F.collect_list("variant_key").alias("k"), F.collect_list("ls").alias("i"), F.collect_list(F.col("gt").cast("double")).alias("g"))
    joined = packed.join(lists, ["gene_id", "chunk"]).join(_subject_tiles(model, tiles), "t")
    z_names = [f"s_{z}" for z in model.z]

    def residualise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                keys, means, places = np.asarray(row.keys), np.asarray(row.means), np.asarray(row.ls)
                weight, z = np.zeros(tile), np.zeros((tile, len(z_names)))
                weight[places] = row.s_weight
                z[places] = np.column_stack([getattr(row, c) for c in z_names])
                g = np.repeat(means[:, None], tile, axis=1)
                g[np.searchsorted(keys, np.asarray(row.k)), np.asarray(row.i)] = np.asarray(row.g)
                h = (g - np.asarray(row.zg).reshape(len(keys), -1) @ z.T) * np.sqrt(weight)
                out.append((row.gene_id, row.chunk, row.t, len(keys), to_bytes(h)))
            yield pd.DataFrame(out, columns=["gene_id", "chunk", "t", "n", "h"])

    return joined.mapInPandas(residualise, "gene_id string, chunk int, t int, n int, h binary")


def smmat(entries: DataFrame, variants: DataFrame, genes: DataFrame, model: ScoreModel, tile: int = TILE, chunk: int = CHUNK) -> DataFrame:
    """Burden and adjusted variance-component p-values, combined by Fisher's method.

    With V the covariance of the scores U and x = V1, the adjusted scores are
    U - x (1'U) / (1'V1); their sum of squares is compared with the mixture
    given by V - x x' / (1'V1) through its first two moments. Only genes with
    more than one carrier are kept; the combined p-values are adjusted over
    the genes.
    """
    members = durable(gene_variants(variants, genes))
    listed = keep_listed(entries, members, "variant_key")
    stats = durable(score_sums(listed, model))
    h = durable(residual_tiles(listed, members, stats.select("variant_key", "mean", "zg"), model, tile, chunk))
    mat = lambda row: from_bytes(row.h).reshape(row.n, -1)

    # b = H'1 by gene and tile; x = H b by gene and chunk; c = H'x by gene and tile.
    b = durable(sum_blocks(
        map_rows(h, lambda r: (r.gene_id, r.t, to_bytes(mat(r).sum(axis=0))), "gene_id string, t int, b binary"), ["gene_id", "t"], "b"))
    x = durable(sum_blocks(
        map_rows(h.join(b, ["gene_id", "t"]), lambda r: (r.gene_id, r.chunk, to_bytes(mat(r) @ from_bytes(r.b))),
                 "gene_id string, chunk int, x binary"), ["gene_id", "chunk"], "x"))
    c_vec = sum_blocks(
        map_rows(h.join(x, ["gene_id", "chunk"]), lambda r: (r.gene_id, r.t, to_bytes(mat(r).T @ from_bytes(r.x))),
                 "gene_id string, t int, c binary"), ["gene_id", "t"], "c")
    norm = lambda df, col, out: map_rows(
        df, lambda r: (r.gene_id, float(from_bytes(getattr(r, col)) @ from_bytes(getattr(r, col)))), f"gene_id string, {out} double"
    ).groupBy("gene_id").agg(F.sum(out).alias(out))

    # Chunk pairs of a gene: products summed over the tiles, then squared.
    other = h.select("gene_id", "t", F.col("chunk").alias("chunk2"), F.col("n").alias("n2"), F.col("h").alias("h2"))
    pairs = h.join(other, ["gene_id", "t"]).where(F.col("chunk") <= F.col("chunk2"))
    products = sum_blocks(
        map_rows(pairs, lambda r: (r.gene_id, r.chunk, r.chunk2, to_bytes(mat(r) @ from_bytes(r.h2).reshape(r.n2, -1).T)),
                 "gene_id string, chunk int, chunk2 int, v binary"), ["gene_id", "chunk", "chunk2"], "v")
    squares = map_rows(products, lambda r: (r.gene_id, (1.0 if r.chunk == r.chunk2 else 2.0) * float(np.square(from_bytes(r.v)).sum())),
                       "gene_id string, trace_v2 double").groupBy("gene_id").agg(F.sum("trace_v2").alias("trace_v2"))

    per_variant = members.join(stats, "variant_key")
    scores = per_variant.groupBy("gene_id").agg(
        F.sum("score").alias("burden_score"), F.sum(F.col("score") * F.col("score")).alias("_uu"), F.sum("_v").alias("_trace"))
    ux = _score_products(per_variant, x, chunk)
    c = F.col
    joined = (
        scores.join(norm(b, "b", "burden_var"), "gene_id").join(norm(x, "x", "_xx"), "gene_id")
        .join(norm(c_vec, "c", "_xvx"), "gene_id").join(squares, "gene_id").join(ux, "gene_id")
    ).where(c("burden_var") > 1e-9)
    ratio = c("burden_score") / c("burden_var")
    trace = c("_trace") - c("_xx") / c("burden_var")
    # A gene of one variant leaves nothing beside its burden.
    rest = trace > c("_trace") * 1e-8
    stats_rows = joined.select(
        "gene_id", "burden_score", "burden_var",
        F.when(rest, c("_uu") - 2 * ratio * c("_ux") + ratio * ratio * c("_xx")).alias("q"),
        F.when(rest, trace).alias("trace"),
        F.when(rest, c("trace_v2") - 2 * c("_xvx") / c("burden_var") + F.pow(c("_xx") / c("burden_var"), F.lit(2.0))).alias("trace_sq"),
    )
    return _combined(stats_rows, entries, members, genes, model)


def _score_products(per_variant: DataFrame, x: DataFrame, chunk: int) -> DataFrame:
    """u'x per gene: the chunk vectors meet the scores in the same hashed order."""
    sizes = per_variant.groupBy("gene_id").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("n_chunks"))
    placed = per_variant.join(sizes, "gene_id").select(
        "gene_id", F.pmod(F.xxhash64("variant_key"), F.col("n_chunks")).cast("int").alias("chunk"), "variant_key", "score")
    lists = placed.groupBy("gene_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("variant_key", "score"))).alias("v"))
    return map_rows(
        lists.select("gene_id", "chunk", F.col("v.score").alias("u")).join(x, ["gene_id", "chunk"]),
        lambda r: (r.gene_id, float(np.asarray(r.u) @ from_bytes(r.x))), "gene_id string, _ux double",
    ).groupBy("gene_id").agg(F.sum("_ux").alias("_ux"))


def _combined(stats: DataFrame, entries: DataFrame, members: DataFrame, genes: DataFrame, model: ScoreModel) -> DataFrame:
    c = F.col
    tested = stats.withColumn("burden_pval", chi2_1_sf(c("burden_score") * c("burden_score") / c("burden_var")))
    tested = tested.withColumn("theta_pval", F.when(c("q").isNotNull(), _mixture_tail(*[F.coalesce(x, F.lit(1.0)) for x in ("q", "trace", "trace_sq")])))
    log_sum = -2 * (F.log(F.greatest("burden_pval", F.lit(1e-300))) + F.log(F.greatest("theta_pval", F.lit(1e-300))))
    tested = tested.withColumn("smmat_pval", F.when(c("theta_pval").isNotNull(), chi2_4_sf(log_sum)).otherwise(c("burden_pval")))
    counts = gene_counts(gene_burden(entries, members, model.table), members)
    joined = genes.select("gene_id", "contig", "start_pos", "end_pos").join(counts, "gene_id").join(tested, "gene_id")
    kept = durable(joined.where(c("n_sample_alt") > 1))
    return adjust_p(kept, "smmat_pval")
