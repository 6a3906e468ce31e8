"""Fixed-effect meta-analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.functions.special import two_sided_p


def meta_analysis(studies: list[DataFrame], marker: str = "variant_id") -> DataFrame:
    """Inverse-variance weighted effects over the studies.

    The first study with a marker sets its alleles; a study with swapped
    alleles is flipped, one with other alleles is left out. Rows are keyed by
    the unordered allele pair, so one shuffle brings the studies together.
    """
    c = F.col
    parts = [
        s.select(F.lit(i).alias("study"), c(marker).alias("marker"), F.upper("effect_allele").alias("ea"), F.upper("other_allele").alias("oa"),
                 c("est").cast("double").alias("est"), c("est_se").cast("double").alias("se"), c("n_obs").cast("bigint").alias("n"))
        for i, s in enumerate(studies)
    ]
    rows = reduce(DataFrame.unionByName, parts).where(c("est").isNotNull() & (c("se") > 0))
    sign = F.when(c("ea") <= c("oa"), 1.0).otherwise(-1.0)
    w = F.lit(1.0) / (c("se") * c("se"))
    sums = rows.withColumns({"low": F.least("ea", "oa"), "high": F.greatest("ea", "oa"), "sign": sign, "w": w}).groupBy("marker", "low", "high").agg(
        F.min(F.struct("study", "sign")).alias("first"),
        F.sum("w").alias("w"), F.sum(c("w") * c("est") * c("sign")).alias("wb"), F.sum("n").alias("n_total"),
        F.count(F.lit(1)).alias("n_studies"),
        *[F.sum(F.when(c("study") == i, c("est") * c("sign"))).alias(f"d{i}") for i in range(len(studies))],
    )
    kept = sums.groupBy("marker").agg(F.min(F.struct("first", "low", "high", "w", "wb", "n_total", "n_studies", *[f"d{i}" for i in range(len(studies))])).alias("m"))
    flip = c("m.first.sign")
    direction = F.concat(*[
        F.when(c(f"m.d{i}").isNull(), "?").when(c(f"m.d{i}") * flip > 0, "+").when(c(f"m.d{i}") * flip < 0, "-").otherwise("0")
        for i in range(len(studies))
    ])
    out = kept.select(
        "marker",
        F.when(flip > 0, c("m.low")).otherwise(c("m.high")).alias("effect_allele"),
        F.when(flip > 0, c("m.high")).otherwise(c("m.low")).alias("other_allele"),
        c("m.n_studies").alias("n_studies"), c("m.n_total").alias("n_total"),
        (c("m.wb") * flip / c("m.w")).alias("effect"), (F.lit(1.0) / F.sqrt("m.w")).alias("se"), direction.alias("direction"),
    )
    return out.withColumn("z", c("effect") / c("se")).withColumn("p", two_sided_p(c("z")))
