"""Sample sizes and confidence bounds as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def z_two_sided(confidence: float) -> float:
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def z_one_sided(confidence: float) -> float:
    return NormalDist().inv_cdf(confidence)


def simultaneous(confidence: float, strata: int) -> float:
    """Bonferroni: each stratum's confidence so that all hold together."""
    return 1 - (1 - confidence) / max(strata, 1)


def sample_size(population: Column, confidence: float, margin: float) -> Column:
    """For a proportion at worst variance, corrected for a finite population."""
    n0 = z_two_sided(confidence) ** 2 * 0.25 / (margin * margin)
    finite = F.lit(n0) / (F.lit(1.0) + F.lit(n0 - 1) / F.greatest(population, F.lit(1)))
    return F.least(population, F.greatest(F.lit(1), F.ceil(finite)))


def wilson_upper(defects: Column, sample: Column, confidence: float) -> Column:
    z = z_one_sided(confidence)
    n = sample.cast("double")
    p = defects / n
    spread = F.lit(z) * F.sqrt(p * (1 - p) / n + F.lit(z * z) / (4 * n * n))
    return F.when(sample == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), (p + F.lit(z * z) / (2 * n) + spread) / (1 + F.lit(z * z) / n)))
