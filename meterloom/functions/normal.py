"""The standard normal distribution as Column expressions, by published rational approximations.

Both functions stay within the JVM's generated code. ``polynomial`` and the coefficients are also what the SQL twins of
the queries are written from.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximations of the error function (W. J. Cody, 1969), highest power first.
ERF_NUM = (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3)
ERF_DEN = (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3)
MID_NUM = (
    2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
    8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3,
)
MID_DEN = (
    1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
    3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3,
)
FAR_NUM = (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4)
FAR_DEN = (1.0, 2.56852019228982242e0, 1.87295284992346047e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3)

# Rational approximations of the normal quantile (M. J. Wichura, 1988), highest power first.
CENTRE_NUM = (
    2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
    1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0,
)
CENTRE_DEN = (
    5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
    5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0,
)
TAIL_NUM = (
    7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
    3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0,
)
TAIL_DEN = (
    1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
    6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0,
)
EDGE_NUM = (
    2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
    2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0,
)
EDGE_DEN = (
    2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
    1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0,
)


def polynomial(x, coefficients):
    """Horner's scheme; ``x`` may be a Column, a number or anything else with + and *."""
    total = coefficients[0]
    for c in coefficients[1:]:
        total = total * x + c
    return total


def log_normal_cdf(z: Column) -> Column:
    """Logarithm of the distribution function, accurate far into the lower tail."""
    x = F.abs(z) / math.sqrt(2.0)
    square = x * x
    half_erf = x * polynomial(square, ERF_NUM) / polynomial(square, ERF_DEN) / 2  # up to x = 0.46875
    inverse = 1 / F.greatest(square, F.lit(1.0))
    far = (1 / math.sqrt(math.pi) - inverse * polynomial(inverse, FAR_NUM) / polynomial(inverse, FAR_DEN)) / F.greatest(x, F.lit(1.0))
    scaled = F.when(x <= 4, polynomial(x, MID_NUM) / polynomial(x, MID_DEN)).otherwise(far)  # erfc times exp(x²)
    upper = F.log1p(-F.exp(-square) * scaled / 2)
    lower = F.ln(scaled / 2) - square
    return (
        F.when(x <= 0.46875, F.ln(0.5 + F.signum(z) * half_erf))
        .when(z > 0, upper)
        .otherwise(lower)
    )


def normal_quantile(p: Column) -> Column:
    """The value below which a normal variable falls with probability ``p``; NULL outside (0, 1)."""
    q = p - 0.5
    r = 0.180625 - q * q
    centre = q * polynomial(r, CENTRE_NUM) / polynomial(r, CENTRE_DEN)
    deep = F.sqrt(-F.ln(F.least(p, 1 - p)))
    tail, edge = deep - 1.6, deep - 5.0
    outer = F.when(deep <= 5, polynomial(tail, TAIL_NUM) / polynomial(tail, TAIL_DEN)).otherwise(polynomial(edge, EDGE_NUM) / polynomial(edge, EDGE_DEN))
    inside = (p > 0) & (p < 1)
    return F.when(inside & (F.abs(q) <= 0.425), centre).when(inside, F.signum(q) * outer)
