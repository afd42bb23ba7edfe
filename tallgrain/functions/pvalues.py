"""p-values as column functions over rows that are already one per group."""

from __future__ import annotations

import math

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import distributions as D

# the helpers travel with the function: executors need not have this package installed
cloudpickle.register_pickle_by_value(D)


def _column(fn):
    """A pandas UDF applying ``fn`` to each group's few numbers; missing input gives null."""

    def run(*cols: pd.Series) -> pd.Series:
        out = []
        for values in zip(*cols):
            missing = any(v is None or (isinstance(v, float) and math.isnan(v)) for v in values)
            out.append(None if missing else fn(*values))
        return pd.Series(out, dtype="float64")

    return run


def _double_udf(n_args: int, fn):
    run = _column(fn)
    if n_args == 1:
        def body(a: pd.Series) -> pd.Series:
            return run(a)
    elif n_args == 2:
        def body(a: pd.Series, b: pd.Series) -> pd.Series:
            return run(a, b)
    elif n_args == 3:
        def body(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            return run(a, b, c)
    else:
        def body(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
            return run(a, b, c, d)
    return F.pandas_udf(body, "double")


def t_tail(t: Column, dof: Column, alternative: str = "two-sided") -> Column:
    rule = {
        "greater": lambda t, n: D.t_sf(t, n),
        "less": lambda t, n: D.t_sf(-t, n),
        "two-sided": lambda t, n: min(1.0, 2.0 * D.t_sf(abs(t), n)),
    }
    return _double_udf(2, rule[alternative])(t, dof)


def normal_tail(z: Column) -> Column:
    return _double_udf(1, D.normal_sf)(z)


def chi2_tail(x: Column, dof: Column) -> Column:
    return _double_udf(2, D.chi2_sf)(x, dof)


def f_tail(f: Column, d1: Column, d2: Column) -> Column:
    return _double_udf(3, D.f_sf)(f, d1, d2)


def ks_tail(d: Column, n1: Column, n2: Column) -> Column:
    return _double_udf(3, lambda d, a, b: D.ks_sf(d, int(a), int(b)))(d, n1, n2)


def hypergeom_tail(k: Column, total: Column, marked: Column, drawn: Column) -> Column:
    return _double_udf(4, lambda k, t, m, d: D.hypergeom_sf(int(k), int(t), int(m), int(d)))(
        k, total, marked, drawn
    )


def rank_sum_tail(u: Column, n1: Column, n2: Column, ties: Column) -> Column:
    """Two-sided p of the rank-sum test; ``ties`` is the sum of t^3 - t over tied values.

    Exact if the smaller side has at most 8 values and there are no ties, whatever the larger
    side's size; else normal with tie and continuity correction.
    """

    def p(u, n1, n2, ties):
        n1, n2 = int(n1), int(n2)
        if n1 == 0 or n2 == 0:
            return float("nan")
        u = max(u, n1 * n2 - u)
        if min(n1, n2) <= 8 and ties == 0:
            return min(1.0, 2.0 * D.rank_sum_sf(u, min(n1, n2), max(n1, n2)))
        n = n1 + n2
        var = n1 * n2 / 12.0 * ((n + 1) - ties / (n * (n - 1.0)))
        if var <= 0:
            return 1.0
        return min(1.0, 2.0 * D.normal_sf((u - n1 * n2 / 2.0 - 0.5) / math.sqrt(var)))

    return _double_udf(4, p)(u, n1, n2, ties)


def signed_rank_tail(w: Column, n: Column, ties: Column, zeros: Column) -> Column:
    """One-sided (greater) p: exact up to 50 values without ties or zeros, else normal."""

    def p(w, n, ties, zeros):
        n = int(n)
        if n == 0:
            return float("nan")
        if n <= 50 and ties == 0 and zeros == 0:
            return D.signed_rank_sf(w, n)
        var = n * (n + 1) * (2 * n + 1) / 24.0 - ties / 48.0
        return D.normal_sf((w - n * (n + 1) / 4.0) / math.sqrt(var)) if var > 0 else float("nan")

    return _double_udf(4, p)(w, n, ties, zeros)


def shapiro_stat(*cols: Column) -> Column:
    """W from the eight sums of ``distributions.shapiro_w``."""

    def body(
        n: pd.Series,
        score_sq: pd.Series,
        score_x: pd.Series,
        ss: pd.Series,
        x1: pd.Series,
        x2: pd.Series,
        y2: pd.Series,
        y1: pd.Series,
    ) -> pd.Series:
        rows = zip(n, score_sq, score_x, ss, x1, x2, y2, y1)
        return pd.Series([D.shapiro_w(int(r[0]), *r[1:]) for r in rows], dtype="float64")

    return F.pandas_udf(body, "double")(*cols)


def shapiro_tail(w: Column, n: Column) -> Column:
    return _double_udf(2, lambda w, n: D.shapiro_p(w, int(n)))(w, n)


# fixed values: Wichura's rational approximations of the normal quantile (1988), lowest power first;
# for the middle, the near and the far tail
_QUANTILE = (
    (
        (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
         45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
        (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
         21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
    ),
    (
        (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640),
        (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
         0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9),
    ),
    (
        (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
         0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
         0.000786869131145613259100, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
    ),
)


def _ratio(part: int, x: Column) -> Column:
    sides = []
    for coefs in _QUANTILE[part]:
        out = F.lit(coefs[-1])
        for c in reversed(coefs[:-1]):
            out = out * x + F.lit(c)
        sides.append(out)
    return sides[0] / sides[1]


def normal_quantile(p: Column) -> Column:
    """The normal quantile as a plain expression, for 0 < p < 1."""
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.signum(q) * F.when(r <= 5, _ratio(1, r - 1.6)).otherwise(_ratio(2, r - 5))
    return F.when(F.abs(q) <= 0.425, q * _ratio(0, 0.180625 - q * q)).otherwise(tail)


def normal_score(place: Column, total: Column) -> Column:
    """Expected place of the ``place``-th of ``total`` sorted values on the normal scale."""
    return normal_quantile((place - 0.375) / (total + 0.25))


def decide(p, alpha: float = 0.05) -> Column:
    """Decision text at a level."""
    p = F.col(p) if isinstance(p, str) else p
    return (
        F.when(p < alpha, "reject")
        .when(p.isNotNull() & ~F.isnan(p), "do not reject")
        .otherwise("not computable")
    )
