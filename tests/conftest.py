import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from genolith.session import get_spark, use_own_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("local[4]", 4, "8g")
    use_own_folder(session)
    session.sparkContext.setLogLevel("ERROR")
    return session


def random_genotypes(n_variants=60, n_samples=40, missing=0.05, seed=1):
    """Calls of two groups with different frequencies; NaN is a missing call."""
    rng = np.random.default_rng(seed)
    base = rng.uniform(0.1, 0.6, n_variants)
    shift = rng.uniform(-0.25, 0.25, n_variants)
    group = np.arange(n_samples) % 2
    freq = np.clip(base[:, None] + shift[:, None] * group[None, :], 0.02, 0.98)
    g = rng.binomial(2, freq).astype(float)
    g[rng.uniform(size=g.shape) < missing] = np.nan
    return g


def genotype_frames(spark, g, step=1000):
    """(variants, samples, entries) of a variants x samples array."""
    m, n = g.shape
    v, s = np.meshgrid(np.arange(m), np.arange(n), indexing="ij")
    gt = [None if np.isnan(x) else int(x) for x in g.ravel()]
    entries = spark.createDataFrame(
        list(zip(v.ravel().tolist(), s.ravel().tolist(), gt)), "variant_key bigint, sample_key bigint, gt int")
    variants = spark.createDataFrame(
        [(i, f"chr{i % 3 + 1}", 1000 + step * (i // 3), "A", "G") for i in range(m)],
        "variant_key bigint, contig string, pos bigint, ref string, alt string")
    samples = spark.createDataFrame([(i,) for i in range(n)], "sample_key bigint")
    return variants, samples, entries


@pytest.fixture(scope="session")
def genotypes(spark):
    g = random_genotypes()
    frames = genotype_frames(spark, g)
    return (g, *[f.cache() for f in frames])
