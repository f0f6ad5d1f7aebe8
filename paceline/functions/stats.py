"""Tail probabilities and the two-proportion sample size as Column expressions.

Spark has no ``erfc``. It is summed here from two textbook expansions with all-positive
terms, good to ~1e-13, and only ever evaluated on a handful of result rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# The power analysis uses these rounded normal quantiles.
Z_ALPHA_TWO_SIDED_05 = 1.96
Z_POWER_80 = 0.8416
# 97.5 % normal quantile, for regression and survival intervals.
Z_975 = 1.959963984540054

_SERIES_TERMS = 120
_FRACTION_DEPTH = 120
_SERIES_LIMIT = 2.5


def _erf_series(x: Column) -> Column:
    """erf for small x: 2/sqrt(pi) * exp(-x^2) * sum of 2^n x^(2n+1) / (2n+1)!!."""
    zero = F.struct(x.alias("term"), x.alias("total"))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * F.lit(2.0) * x * x / (F.lit(2.0) * n + 1)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    ns = F.transform(F.sequence(F.lit(1), F.lit(_SERIES_TERMS)), lambda n: n.cast("double"))
    total = F.aggregate(ns, zero, step, lambda acc: acc["total"])
    return F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-x * x) * total


def _erfc_fraction(x: Column) -> Column:
    """erfc for large x: the continued fraction x + (k/2)/(x + …), deepest term first."""
    ks = F.transform(F.sequence(F.lit(_FRACTION_DEPTH), F.lit(1)), lambda k: k.cast("double"))
    tail = F.aggregate(ks, x, lambda acc, k: x + k / (F.lit(2.0) * acc))
    return F.exp(-x * x) / (F.lit(math.sqrt(math.pi)) * tail)


def erfc(x: Column) -> Column:
    """Complementary error function for ``x >= 0``."""
    x = x.cast("double")
    return F.when(x < _SERIES_LIMIT, F.lit(1.0) - _erf_series(x)).otherwise(_erfc_fraction(x))


def normal_two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z.cast("double")) / F.lit(math.sqrt(2.0)))


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole ``dof >= 1``.

    Even dof: exp(-h) * sum h^i / i!  for i < dof/2.
    Odd dof:  erfc(sqrt h) + exp(-h) * sum h^(i+1/2) / Gamma(i+3/2)  for i < (dof-1)/2,
    with h = x/2.
    """
    h = x.cast("double") / F.lit(2.0)
    odd = (dof % 2) == 1
    lead = F.when(odd, F.lit(2.0 / math.sqrt(math.pi)) * F.sqrt(h)).otherwise(F.lit(1.0))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    terms = F.floor(dof / 2).cast("int")

    def step(acc: Column, i: Column) -> Column:
        return F.struct(
            (acc["term"] * h / (i.cast("double") + shift)).alias("term"),
            (acc["total"] + acc["term"]).alias("total"),
        )

    zero = F.struct(lead.alias("term"), F.lit(0.0).alias("total"))
    partial = F.when(terms >= 1, F.aggregate(
        F.sequence(F.lit(1), F.greatest(terms, F.lit(1))), zero, step, lambda acc: acc["total"]
    )).otherwise(F.lit(0.0))
    return F.when(odd, erfc(F.sqrt(h))).otherwise(F.lit(0.0)) + F.exp(-h) * partial


def sample_size(p1: Column, relative_mde: float, z_alpha: float = Z_ALPHA_TWO_SIDED_05,
                z_power: float = Z_POWER_80) -> Column:
    """Sessions per arm to detect a relative lift on baseline ``p1``; NULL if undefined."""
    p1 = p1.cast("double")
    p2 = p1 * F.lit(1.0 + relative_mde)
    mean = (p1 + p2) / F.lit(2.0)
    pooled = F.lit(z_alpha) * F.sqrt(F.lit(2.0) * mean * (F.lit(1.0) - mean))
    split = F.lit(z_power) * F.sqrt(p1 * (F.lit(1.0) - p1) + p2 * (F.lit(1.0) - p2))
    delta = F.abs(p2 - p1)
    wanted = (pooled + split) * (pooled + split) / (delta * delta)
    return F.when((p1 > 0) & (p2 <= 1), F.ceil(wanted).cast("long"))
