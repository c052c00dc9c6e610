"""Statistical column helpers: upper normal quantiles and chi-square critical
values for one degree of freedom, as plain column expressions (no UDF).

``z_upper(t)`` is the normal quantile ``Phi^-1(1 - t)`` for a small upper
tail ``t`` (t <= 0.075), by the tail branches of the rational approximation
AS241 (Wichura 1988, "The Percentage Points of the Normal Distribution",
Applied Statistics 37(3)), evaluated from ``r = sqrt(-ln t)``. For one
degree of freedom ``P(chi2 > x) = t  <=>  x = z_upper(t / 2) ** 2``.
The SQL form evaluates the same Horner polynomials in the same order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# AS241 (PPND16) tail coefficients, highest power first.
# Branch r <= 5 (after r - 1.6):
TAIL_NUM = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
            1.27045825245236838258e+0, 3.64784832476320460504e+0, 5.76949722146069140550e+0,
            4.63033784615654529590e+0, 1.42343711074968357734e+0)
TAIL_DEN = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
            1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e+0,
            2.05319162663775882187e+0, 1.0)
# Branch r > 5 (after r - 5):
FAR_NUM = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
           2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e+0,
           5.46378491116411436990e+0, 6.65790464350110377720e+0)
FAR_DEN = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
           7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
           5.99832206555887937690e-1, 1.0)


def _horner(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + F.lit(c)
    return acc


def z_upper(t: Column) -> Column:
    r = F.sqrt(-F.ln(t))
    near, far = r - F.lit(1.6), r - F.lit(5.0)
    return F.when(r <= F.lit(5.0), _horner(TAIL_NUM, near) / _horner(TAIL_DEN, near)) \
            .otherwise(_horner(FAR_NUM, far) / _horner(FAR_DEN, far))


def chi2_critical_1df(alpha: Column) -> Column:
    """x with P(chi2_1 > x) = alpha."""
    z = z_upper(alpha / F.lit(2.0))
    return z * z


def z_upper_py(t: float) -> float:
    """Python value of :func:`z_upper` (tests, literal thresholds)."""
    r = math.sqrt(-math.log(t))

    def h(cs, x):
        acc = cs[0]
        for c in cs[1:]:
            acc = acc * x + c
        return acc

    if r <= 5.0:
        return h(TAIL_NUM, r - 1.6) / h(TAIL_DEN, r - 1.6)
    return h(FAR_NUM, r - 5.0) / h(FAR_DEN, r - 5.0)


# SQL forms ------------------------------------------------------------------
def _lit(x: float) -> str:
    return format(x, ".17e")


def _horner_sql(coefs, x: str) -> str:
    acc = _lit(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {_lit(c)})"
    return acc


def z_upper_sql(t: str) -> str:
    r = f"sqrt(-ln({t}))"
    near, far = f"({r} - {_lit(1.6)})", f"({r} - {_lit(5.0)})"
    return (f"(CASE WHEN {r} <= {_lit(5.0)} THEN {_horner_sql(TAIL_NUM, near)} / {_horner_sql(TAIL_DEN, near)} "
            f"ELSE {_horner_sql(FAR_NUM, far)} / {_horner_sql(FAR_DEN, far)} END)")


def chi2_critical_1df_sql(alpha: str) -> str:
    z = z_upper_sql(f"(({alpha}) / {_lit(2.0)})")
    return f"({z} * {z})"
