"""Normal, chi-square and hypergeometric functions as Column expressions.

Everything stays inside generated JVM code. The coefficients are the published
rational approximations: Cody (1969) for the error function, Wichura (1988,
AS 241) for the normal quantile.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cody's coefficients, numerator then denominator, low order first.
ERF_NUM = [3.20937758913846947e03, 3.77485237685302021e02, 1.13864154151050156e02,
           3.16112374387056560e00, 1.85777706184603153e-1]
ERF_DEN = [2.84423683343917062e03, 1.28261652607737228e03, 2.44024637934444173e02,
           2.36012909523441209e01, 1.0]
ERFC_MID_NUM = [1.23033935479799725e03, 2.05107837782607147e03, 1.71204761263407058e03,
                8.81952221241769090e02, 2.98635138197400131e02, 6.61191906371416295e01,
                8.88314979438837594e00, 5.64188496988670089e-1, 2.15311535474403846e-8]
ERFC_MID_DEN = [1.23033935480374942e03, 3.43936767414372164e03, 4.36261909014324716e03,
                3.29079923573345963e03, 1.62138957456669019e03, 5.37181101862009858e02,
                1.17693950891312499e02, 1.57449261107098347e01, 1.0]
ERFC_TAIL_NUM = [6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1,
                 3.60344899949804439e-1, 3.05326634961232344e-1, 1.63153871373020978e-2]
ERFC_TAIL_DEN = [2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1,
                 1.87295284992346725e00, 2.56852019228982242e00, 1.0]

# Wichura's coefficients, low order first.
PPND_A = [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
          1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
          3.3430575583588128105e4, 2.5090809287301226727e3]
PPND_B = [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
          2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
          5.2264952788528545610e3]
PPND_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
          3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
          2.27238449892691845833e-2, 7.74545014278341407640e-4]
PPND_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
          1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
          1.05075007164441684324e-9]
PPND_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
          2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
          2.71155556874348757815e-5, 2.01033439929228813265e-7]
PPND_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
          7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
          2.04426310338993978564e-15]

SQRT2 = math.sqrt(2.0)
# Median of the chi-square distribution with one degree of freedom.
CHI2_1_MEDIAN = 0.45493642311957283


def polynomial(x: Column, coefficients: list[float]) -> Column:
    result = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        result = result * x + F.lit(c)
    return result


def erfc(x: Column) -> Column:
    """Complementary error function, relative error near 1e-16."""
    a = F.abs(x)
    sq = a * a
    small = F.lit(1.0) - a * polynomial(sq, ERF_NUM) / polynomial(sq, ERF_DEN)
    mid = F.exp(-sq) * polynomial(a, ERFC_MID_NUM) / polynomial(a, ERFC_MID_DEN)
    inv = F.lit(1.0) / sq
    tail = (F.exp(-sq) / a) * (
        F.lit(1.0 / math.sqrt(math.pi)) - inv * polynomial(inv, ERFC_TAIL_NUM) / polynomial(inv, ERFC_TAIL_DEN)
    )
    upper = F.when(a <= 0.46875, small).when(a <= 4.0, mid).otherwise(tail)
    return F.when(x < 0, F.lit(2.0) - upper).otherwise(upper)


def normal_sf(z: Column) -> Column:
    return erfc(z / F.lit(SQRT2)) * 0.5


def normal_cdf(z: Column) -> Column:
    return erfc(-z / F.lit(SQRT2)) * 0.5


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / F.lit(SQRT2))


def chi2_1_sf(x: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return erfc(F.sqrt(x / 2.0))


def chi2_4_sf(x: Column) -> Column:
    """Upper tail with four degrees of freedom (Fisher's method for two p-values)."""
    return F.exp(-x / 2.0) * (F.lit(1.0) + x / 2.0)


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail for a whole number of degrees of freedom held in a column.

    Finite sum of the incomplete gamma function: Poisson terms for even
    degrees, half-integer terms on top of erfc for odd ones.
    """
    h = x / 2.0
    even_terms = F.aggregate(
        F.when(df >= 4, F.sequence(F.lit(1), F.floor(df / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>")),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, i: F.struct((s["term"] * h / i).alias("term"), (s["total"] + s["term"] * h / i).alias("total")),
        lambda s: s["total"],
    )
    first = F.sqrt(h) * F.lit(2.0 / math.sqrt(math.pi))
    odd_terms = F.aggregate(
        F.when(df >= 5, F.sequence(F.lit(1), F.floor((df - 3) / 2).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.struct(first.alias("term"), F.when(df >= 3, first).otherwise(0.0).alias("total")),
        lambda s, i: F.struct(
            (s["term"] * h / (i + F.lit(0.5))).alias("term"),
            (s["total"] + s["term"] * h / (i + F.lit(0.5))).alias("total"),
        ),
        lambda s: s["total"],
    )
    return F.when(df % 2 == 0, F.exp(-h) * even_terms).otherwise(erfc(F.sqrt(h)) + F.exp(-h) * odd_terms)


def normal_quantile(p: Column) -> Column:
    """Inverse normal distribution function; 0 and 1 give infinities, outside NULL."""
    q = p - 0.5
    centre = F.lit(0.180625) - q * q
    middle = q * polynomial(centre, PPND_A) / polynomial(centre, PPND_B)
    tail = F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))
    near = polynomial(tail - 1.6, PPND_C) / polynomial(tail - 1.6, PPND_D)
    far = polynomial(tail - 5.0, PPND_E) / polynomial(tail - 5.0, PPND_F)
    side = F.when(tail <= 5.0, near).otherwise(far)
    inner = F.when(F.abs(q) <= 0.425, middle).when(q < 0, -side).otherwise(side)
    return (
        F.when((p > 0) & (p < 1), inner)
        .when(p == 0, F.lit(float("-inf")))
        .when(p == 1, F.lit(float("inf")))
    )


def normal_upper_quantile(p: Column) -> Column:
    """z with upper tail p; keeps precision for tiny p."""
    return -normal_quantile(p)


def log_gamma(x: Column) -> Column:
    """log of the gamma function for x > 0 (Stirling series after a shift by 8)."""
    shifted = x + 8.0
    product = x
    for i in range(1, 8):
        product = product * (x + float(i))
    inv = F.lit(1.0) / shifted
    series = polynomial(inv * inv, [1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360]) * inv
    stirling = (shifted - 0.5) * F.log(shifted) - shifted + F.lit(0.5 * math.log(2 * math.pi)) + series
    return stirling - F.log(product)


def log_choose(n: Column, k: Column) -> Column:
    return log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)


def hypergeometric_sf(x: Column, universe: Column, marked: Column, drawn: Column) -> Column:
    """P(X >= x): the first term from log-gamma, the others by their ratio."""
    x0 = F.greatest(x, F.lit(0), marked + drawn - universe).cast("long")
    top = F.least(marked, drawn).cast("long")
    first = F.exp(
        log_choose(marked.cast("double"), x0.cast("double"))
        + log_choose((universe - marked).cast("double"), (drawn - x0).cast("double"))
        - log_choose(universe.cast("double"), drawn.cast("double"))
    )
    rest = F.when(top > x0, F.sequence(x0, top - 1)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(
        rest,
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, i: F.struct(
            (s["term"] * (marked - i) * (drawn - i) / ((i + 1) * (universe - marked - drawn + i + 1))).alias("term"),
            (
                s["total"] + s["term"] * (marked - i) * (drawn - i) / ((i + 1) * (universe - marked - drawn + i + 1))
            ).alias("total"),
        ),
        lambda s: s["total"],
    )
    return F.when(x > top, F.lit(0.0)).otherwise(F.least(F.lit(1.0), first * total))
