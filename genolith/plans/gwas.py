"""Genotypes and subjects to an association table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.operators import association, mixed, models, qc
from genolith.operators.genotypes import GenotypeSet
from genolith.session import broadcast_if_small, durable


def _passing_samples(g: GenotypeSet) -> DataFrame:
    """(sample_key), written: the samples that pass quality control."""
    return durable(qc.passing_samples(qc.sample_qc(g.entries)).select("sample_key"))


def quality_controlled(g: GenotypeSet) -> GenotypeSet:
    """Sample QC, then variant QC and the frequency and equilibrium filters.

    All variant-level filters read one aggregate over the entries of the kept
    samples. The two key lists are written out, so the entries are read once
    for each and not again when the lists are used.
    """
    kept = broadcast_if_small(_passing_samples(g))
    entries = g.entries.join(kept, "sample_key", "left_semi")
    stats = qc.variant_qc(entries)
    good = broadcast_if_small(durable(qc.common_in_equilibrium(qc.passing_variants(stats)).select("variant_key")))
    return replace(g, samples=g.samples.join(kept, "sample_key", "left_semi"), entries=entries).keep_variants(good)


def association_scan(g: GenotypeSet, subjects: DataFrame, outcome: str, covariates: list[str],
                     search: dict[str, list[str]] | None = None, kinship: bool = False) -> DataFrame:
    """Score tests of the variants that pass quality control, Bonferroni adjusted.

    With ``search`` the covariates are chosen by AIC among the subsets of the
    given groups, on top of ``covariates``. With ``kinship`` the null model has a random effect by the relationship
    matrix of the variants that pass.
    """
    if kinship:
        clean = quality_controlled(g)
        data = durable(subjects.join(clean.samples.select("sample_key"), "sample_key", "left_semi"))
        return _adjusted(_with_kinship(clean, data, outcome, covariates, search))
    kept = _passing_samples(g)
    samples = g.samples.join(broadcast_if_small(kept), "sample_key", "left_semi")
    data = durable(subjects.join(samples.select("sample_key"), "sample_key", "left_semi"))
    if search:
        fits = models.exhaustive_search(data, outcome, search, covariates)
        usable = [m for m in fits if m.converged and m.aic is not None]
        model = min(usable, key=lambda m: (m.aic, m.name))
    else:
        model = models.fit_models(data, outcome, {"null": covariates})[0]
    return _adjusted(_tested_variants(g, kept, association.score_model(data, outcome, model)))


def _tested_variants(g: GenotypeSet, kept: DataFrame, model: association.ScoreModel) -> DataFrame:
    """Score tests of the variants that pass, as ``quality_controlled`` and ``association.gwas`` give them.

    The null model needs the kept samples only, so one pass over their entries gives both the
    statistics that decide on a variant and the sums of its test.
    """
    cases = ["n_cases", "n_controls"] if model.family == "binomial" else []
    people = kept.where(F.col("sample_key").isNotNull()).join(association.subject_sums(model, bool(cases)), "sample_key", "left")
    entries = g.entries.join(broadcast_if_small(durable(people)), "sample_key")
    stats = qc.variant_qc(entries, more=association.score_aggregates(model) + (association.case_aggregates() if cases else []))
    good = qc.common_in_equilibrium(qc.passing_variants(stats)).where(F.col("variant_key").isNotNull())
    table = association.with_alleles(association.tested(association.scores(good, model, *cases), *cases), g.variants)
    return table.select(*[c for c in table.columns if c not in cases], *cases)


def _adjusted(table: DataFrame) -> DataFrame:
    table = durable(table)
    tested = table.agg(F.count("score_pval")).first()[0]
    return table.withColumn("bonferroni", F.least(F.lit(1.0), F.col("score_pval") * tested))


def _with_kinship(g: GenotypeSet, data: DataFrame, outcome: str, covariates: list[str], search: dict[str, list[str]] | None) -> DataFrame:
    """Association table under the mixed null model; among the subsets of ``search`` the one of least AIC."""
    held: list[mixed.Relationship] = []

    def relationship(keys):
        held.append(mixed.Relationship.of(g.entries, keys, g.variants.count()))
        return held[-1]

    subsets = [row["covariates"] for row in models.covariate_combinations(data.sparkSession, list(search)).orderBy("model_index").collect()] if search else [[]]
    sets = {",".join(s): [*(models.expand(search, s) if search else []), *covariates] for s in subsets}
    usable = [m for m in mixed.fit_mixed_models(data, outcome, sets, relationship) if m.converged and m.aic is not None]
    model = min(usable, key=lambda m: (m.aic, m.name))
    return association.with_alleles(mixed.mixed_score_test(g.entries, model, held[0]), g.variants)
