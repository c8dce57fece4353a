"""Gamma distribution and normal quantile as SQL expression text (no UDF).

Published formulas: Stirling's series for the logarithm of the gamma function,
the power series of the regularised lower incomplete gamma function, the
Wilson-Hilferty cube root for very large shapes, and Wichura's algorithm AS 241
for the normal quantile.
"""

from __future__ import annotations

# --- fixed values ---
# Coefficients of Stirling's series: B_2k / (2k (2k - 1)).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
# Algorithm AS 241 (Wichura 1988), numerators and denominators, lowest power first.
CENTRAL = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
            4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
           (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4,
            3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
MIDDLE = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
           1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
          (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
           1.05075007164441684324e-9))
TAIL = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
         2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
         7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))
# --- end of fixed values ---

#: From this shape on the cube-root approximation is closer than the series is long.
LARGE_SHAPE = 20000.0


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _poly(coefficients, x: str) -> str:
    out = _d(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = f"({out} * {x} + {_d(c)})"
    return out


def ln_gamma_sql(z: str) -> str:
    """ln of the gamma function for z > 0: Stirling's series eight steps further up."""
    up = f"({z} + 8.0D)"
    series = " + ".join(f"{_d(c)} / pow({up}, {2 * i + 1})" for i, c in enumerate(STIRLING))
    steps = " * ".join(f"({z} + {i}.0D)" for i in range(8))
    return f"(({up} - 0.5D) * ln({up}) - {up} + 0.9189385332046727D + {series} - ln({steps}))"


def gamma_cdf_sql(shape: str, x: str) -> str:
    """Regularised lower incomplete gamma function P(shape, x); 0 for x <= 0.

    The series x^n / ((shape + 1) ... (shape + n)) is summed until its terms, which
    fall once n passes x - shape, are far below the rounding of the sum.
    """
    terms = f"CAST(ceil({x} + 12.0D * sqrt({x}) + 60.0D) AS INT)"
    total = (f"aggregate(sequence(1, {terms}), named_struct('t', 1.0D, 's', 1.0D), "
             f"(acc, n) -> named_struct('t', acc.t * {x} / ({shape} + n), 's', acc.s + acc.t * {x} / ({shape} + n)), "
             "acc -> acc.s)")
    return (f"CASE WHEN {x} <= 0.0D THEN 0.0D ELSE least(1.0D, exp({shape} * ln({x}) - {x} - "
            f"{ln_gamma_sql(f'({shape} + 1.0D)')}) * {total}) END")


def normal_quantile_sql(p: str) -> str:
    """z with P(Z <= z) = p, for 0 < p < 1."""
    q = f"({p} - 0.5D)"
    near = f"(0.180625D - {q} * {q})"
    tail = f"sqrt(-ln(least({p}, 1.0D - {p})))"
    mid, far = f"({tail} - 1.6D)", f"({tail} - 5.0D)"
    ratio = lambda pair, x: f"({_poly(pair[0], x)} / {_poly(pair[1], x)})"
    return (f"CASE WHEN abs({q}) <= 0.425D THEN {q} * {ratio(CENTRAL, near)} "
            f"ELSE signum({q}) * CASE WHEN {tail} <= 5.0D THEN {ratio(MIDDLE, mid)} ELSE {ratio(TAIL, far)} END END")
