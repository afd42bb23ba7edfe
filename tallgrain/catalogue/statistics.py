"""Hypothesis tests, correlations and effect sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..stats import corr as R
from ..stats import moments as M
from ..stats import ranktests as T
from . import query
from .summaries import rounded


def measured(t):
    """Events with a second measure out of their JSON properties."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select("event_id", "event_type", "user_id", "value", k.alias("k"))


# Upper tails for the SQL side, by plain integration of the density over u in (0, 1), x = |z| + u / (1 - u)
TAIL = "(select sum({density} / pow(1 - u, 2)) / 20000 from (select (i + 0.5) / 20000 as u from range(20000) r(i)))"


def normal_tail_sql(z):
    x = f"(abs({z}) + u / (1 - u))"
    return TAIL.format(density=f"exp(-{x} * {x} / 2) / sqrt(2 * pi())")


def t_tail_sql(t, nu):
    x = f"(abs({t}) + u / (1 - u))"
    return TAIL.format(
        density=f"exp(lgamma(({nu} + 1) / 2.0) - lgamma({nu} / 2.0) - ln({nu} * pi()) / 2"
        f" - ({nu} + 1) / 2.0 * ln(1 + {x} * {x} / {nu}))"
    )


def f_tail_sql(f, a, b):
    x = f"(abs({f}) + u / (1 - u))"
    return TAIL.format(
        density=f"exp(lgamma(({a} + {b}) / 2.0) - lgamma({a} / 2.0) - lgamma({b} / 2.0)"
        f" + {a} / 2.0 * ln({a} / ({b})::double) + ({a} / 2.0 - 1) * ln({x})"
        f" - ({a} + {b}) / 2.0 * ln(1 + {a} * {x} / {b}))"
    )


def greater_sql(tail, z):
    return f"round(case when {z} >= 0 then {tail} else 1 - {tail} end, 6)"


E = "(select *, cast(json_extract_string(props, '$.k') as int) as k from events)"


# Inverse normal for the SQL side: a published rational approximation (relative error 1e-9)
# fixed values: its coefficients, highest power first
MIDDLE = (
    (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239),
    (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0),
)
OUTER = (
    (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783),
    (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0),
)
# fixed values: weights of the largest and next value in the normality test, highest power first
A_LAST = (-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, 0.0)
A_NEXT = (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0)


def poly_sql(coefs, x):
    """A polynomial, highest power first, by Horner's rule."""
    out = f"({coefs[0]!r}::double)"
    for c in coefs[1:]:
        out = f"({out} * {x} + ({c!r}::double))"
    return out


MID, LOW, HIGH = "(p - 0.5)", "sqrt(-2 * ln(p))", "sqrt(-2 * ln(1 - p))"
SCORE = f"""case when p < 0.02425 then {poly_sql(OUTER[0], LOW)} / {poly_sql(OUTER[1], LOW)}
   when p > 0.97575 then -{poly_sql(OUTER[0], HIGH)} / {poly_sql(OUTER[1], HIGH)}
   else {poly_sql(MIDDLE[0], f"pow({MID}, 2)")} * {MID} / {poly_sql(MIDDLE[1], f"pow({MID}, 2)")} end"""


# fixed values: mean and log deviation of ln(1 - w) in the logarithm of n, highest power first
W_MEAN = (0.0038915, -0.083751, -0.31082, -1.5861)
W_LOG_SD = (0.0030302, -0.082676, -0.4803)

SHAPIRO = f"""with r as (select event_type, value as x, row_number() over (partition by event_type order by value) as i,
                      count(*) over (partition by event_type) as n,
                      value - avg(value) over (partition by event_type) as d from events),
        m as (select *, {SCORE} as m from (select *, (i - 0.375) / (n + 0.25) as p from r)),
        s as (select event_type, n, 1 / sqrt(n) as q, sum(m * m) as sq, sum(m * x) filter (i > 2 and i < n - 1) as inner_sum,
                     sum(d * d) as ss, max(x) filter (i = 1) as x1, max(x) filter (i = 2) as x2,
                     max(x) filter (i = n - 1) as y2, max(x) filter (i = n) as y1,
                     max(m) filter (i = n) as m1, max(m) filter (i = n - 1) as m2 from m group by event_type, n),
        a as (select *, {poly_sql(A_LAST, "q")} + m1 / sqrt(sq) as a1, {poly_sql(A_NEXT, "q")} + m2 / sqrt(sq) as a2 from s),
        w as (select event_type, n, pow(a1 * (y1 - x1) + a2 * (y2 - x2) + inner_sum
                 / sqrt((sq - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)), 2) / ss as w from a)"""


@query("shapiro", f"{SHAPIRO} select event_type, n, round(w, 6) as w from w")
def _(t):
    return rounded(T.shapiro(t.events, "value", ["event_type"], p_value=False), ["w"])


@query(
    "shapiro_p",
    f"""{SHAPIRO}, z as (select event_type, n, w, (ln(1 - w) - {poly_sql(W_MEAN, "ln(n)")}) / exp({poly_sql(W_LOG_SD, "ln(n)")}) as z from w)
        select event_type, n, round(w, 6) as w, {greater_sql(normal_tail_sql("z"), "z")} as p_value from z""",
)
def _(t):
    return rounded(T.shapiro(t.events, "value", ["event_type"]), ["w", "p_value"])


@query(
    "skewness",
    """select event_type, round(avg(pow(value - m, 3)) / pow(avg(pow(value - m, 2)), 1.5), 6) as value
       from events join (select event_type, avg(value) as m from events group by 1) using (event_type) group by 1""",
)
def _(t):
    return rounded(M.skewness(t.events, ["value"], ["event_type"]), ["value"])


@query(
    "ttest_paired",
    f"""select event_type, n, round(m, 6) as mean_diff, round(s, 6) as sd_diff, round(m / s, 6) as cohen_d,
               round(m / s * sqrt(n), 6) as t
        from (select event_type, count(*) as n, avg(value - k) as m, stddev_samp(value - k) as s from {E} group by 1)""",
)
def _(t):
    found = M.ttest_rel(measured(t), "value", "k", ["event_type"], p_value=False)
    return rounded(found, ["mean_diff", "sd_diff", "cohen_d", "t"])


@query(
    "ttest_paired_p",
    f"""select event_type, {greater_sql(t_tail_sql("t", "nu"), "t")} as greater,
               round(2 * {t_tail_sql("t", "nu")}, 6) as two_sided
        from (select event_type, avg(value - k) / stddev_samp(value - k) * sqrt(count(*)) as t, count(*) - 1 as nu
              from {E} group by 1)""",
)
def _(t):
    m = measured(t)
    greater = M.ttest_rel(m, "value", "k", ["event_type"])
    both = M.ttest_rel(m, "value", "k", ["event_type"], alternative="two-sided")
    return greater.select("event_type", F.round("p_value", 6).alias("greater")).join(
        both.select("event_type", F.round("p_value", 6).alias("two_sided")), ["event_type"]
    )


WILCOXON = """with d as (select event_type, {x} as x, n_all from (select *, count(*) over (partition by event_type) as n_all
     from {e})), r as (select event_type, x, n_all, rank() over w + (count(*) over (partition by event_type, abs(x)) - 1) / 2.0 as r
     from d where x is not null and x <> 0 window w as (partition by event_type order by abs(x)))
   select event_type, n_all as n_rows, n_all - count(*) as not_used, sum(r) filter (x > 0)::double as w,
          round((sum(r) filter (x > 0) - n_all * (n_all + 1) / 4.0) / sqrt(n_all * (n_all + 1.0) * (2 * n_all + 1) / 24.0)
                / sqrt(n_all), 9) as effect_r from r group by event_type, n_all"""


@query("wilcoxon", WILCOXON.format(x="value - k", e=E))
def _(t):
    m = measured(t).withColumn("diff", F.col("value") - F.col("k"))
    found = T.wilcoxon(m, "diff", ["event_type"], p_value=False)
    return found.select(
        "event_type",
        "n_rows",
        (F.col("n_rows") - F.col("n_used")).alias("not_used"),
        "w",
        F.round("effect_r", 9).alias("effect_r"),
    )


@query(
    "wilcoxon_log",
    WILCOXON.format(x="case when value - k > 0 then ln(value - k) end", e=E),
)
def _(t):
    m = measured(t).withColumn("diff", F.col("value") - F.col("k"))
    found = T.wilcoxon(m, "diff", ["event_type"], transform="log", p_value=False)
    return found.select(
        "event_type",
        "n_rows",
        (F.col("n_dropped") + F.col("n_zero")).alias("not_used"),
        "w",
        F.round("effect_r", 9).alias("effect_r"),
    )


@query(
    "wilcoxon_p",
    f"""with d as (select event_type, value - k as x from {E} where value <> k),
        v as (select event_type, abs(x) as a, count(*)::double as t, count(*) filter (x > 0) as pos from d group by 1, 2),
        r as (select *, sum(t) over (partition by event_type order by a) - t + (t + 1) / 2 as r from v),
        w as (select event_type, sum(t) as n, sum(pos * r) as w, sum(t * t * t - t) as ties from r group by 1),
        z as (select event_type, (w - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48) as z from w)
        select event_type, {greater_sql(normal_tail_sql("z"), "z")} as p_value from z""",
)
def _(t):
    m = measured(t).withColumn("diff", F.col("value") - F.col("k"))
    return rounded(T.wilcoxon(m, "diff", ["event_type"]), ["p_value"]).select("event_type", "p_value")


BUCKET = "user_id % 3"


def bucketed(t):
    return t.events.select(
        "event_type", "value", "user_id", (F.col("user_id") % 3).cast("int").alias("bucket")
    )


@query(
    "mannwhitney",
    f"""with r as (select {BUCKET} as bucket, event_type, rank() over (partition by {BUCKET} order by value)
           + (count(*) over (partition by {BUCKET}, value) - 1) / 2.0 as r from events
         where event_type in ('view', 'purchase'))
        select bucket::int as bucket, count(*) filter (event_type = 'view') as n_a,
               count(*) filter (event_type = 'purchase') as n_b,
               (sum(r) filter (event_type = 'view')
               - count(*) filter (event_type = 'view') * (count(*) filter (event_type = 'view') + 1) / 2.0)::double as u
        from r group by 1""",
)
def _(t):
    found = T.mannwhitney(bucketed(t), "value", "event_type", "view", "purchase", ["bucket"], p_value=False)
    return found.select("bucket", "n_a", "n_b", F.col("u").cast("double").alias("u"))


@query(
    "mannwhitney_p",
    f"""with v as (select ({BUCKET})::int as bucket, value, count(*)::double as t, count(*) filter (event_type = 'view') as a,
                       count(*) filter (event_type = 'purchase') as b from events
               where event_type in ('view', 'purchase') group by 1, 2),
        r as (select *, sum(b) over (partition by bucket order by value) - b as below from v),
        s as (select bucket, sum(a)::double as na, sum(b)::double as nb, sum(a * (below + b / 2.0)) as u,
                     sum(t * t * t - t) as ties from r group by 1),
        z as (select bucket, (greatest(u, na * nb - u) - na * nb / 2 - 0.5)
                / sqrt(na * nb / 12 * ((na + nb + 1) - ties / ((na + nb) * (na + nb - 1)))) as z from s)
        select bucket, round(2 * {normal_tail_sql("z")}, 6) as p_value from z""",
)
def _(t):
    found = T.mannwhitney(bucketed(t), "value", "event_type", "view", "purchase", ["bucket"])
    return rounded(found, ["p_value"]).select("bucket", "p_value")


@query(
    "kruskal",
    """with r as (select event_type, value, rank() over (order by value)
          + (count(*) over (partition by value) - 1) / 2.0 as r from events),
       g as (select count(*) as n, sum(r) as s from r group by event_type),
       c as (select sum(t * t * t - t)::double as ties from (select count(*)::double as t from events group by value)),
       h as (select sum(n)::bigint as n, count(*) as k,
               (12.0 / (sum(n) * (sum(n) + 1.0)) * sum(s * s / n) - 3 * (sum(n) + 1)) as raw from g),
       f as (select n, k, raw / (1 - ties / (n::double * n * n - n)) as h from h, c)
       select n, k as n_groups, round(h, 6) as h, round(exp(-h / 2) * (1 + h / 2), 8) as p_value from f""",
)
def _(t):
    """With five groups the chi-square tail has a closed form, so p is compared as well."""
    found = T.kruskal(t.events, "value", "event_type")
    return found.withColumns({"h": F.round("h", 6), "p_value": F.round("p_value", 8)})


@query(
    "kolmogorov_smirnov",
    """with v as (select value, count(*) filter (event_type = 'view') as a,
                       count(*) filter (event_type = 'click') as b from events
               where event_type in ('view', 'click') group by 1),
       c as (select sum(a) over w as ca, sum(b) over w as cb, sum(a) over () as na, sum(b) over () as nb from v
             window w as (order by value))
       select max(na)::bigint as n_a, max(nb)::bigint as n_b, round(max(abs(ca / na - cb / nb)), 9) as d from c""",
)
def _(t):
    found = T.ks_2samp(t.events, "value", "event_type", "view", "click", p_value=False)
    return rounded(found, ["d"], 9)


@query(
    "kolmogorov_smirnov_p",
    f"""with long as (select event_type, 1 as first, value as v from {E} union all select event_type, 0, k from {E}),
        v as (select event_type, v, sum(first) as a, sum(1 - first) as b from long where v is not null group by 1, 2),
        c as (select event_type, sum(a) over w as ca, sum(b) over w as cb, sum(a) over g as na, sum(b) over g as nb from v
              window w as (partition by event_type order by v), g as (partition by event_type)),
        d as (select event_type, max(na)::bigint as n_a, max(nb)::bigint as n_b, max(abs(ca / na - cb / nb)) as d from c group by 1),
        s as (select *, n_a as n, round(d * n_a) as c from d)
        select event_type, n_a, n_b, round(d, 9) as d, round(least(1, (select sum(case when i * c <= n
                 then 2 * pow(-1, i - 1) * exp(2 * lgamma(n + 1.0) - lgamma(n + i * c + 1.0) - lgamma(greatest(n - i * c, 0) + 1.0))
                 else 0 end) from range(1, 10001) r(i))), 6) as p_value from s""",
)
def _(t):
    """Both columns have as many values, so the SQL side can count lattice paths by reflection."""
    found = T.ks_columns(measured(t), "value", "k", ["event_type"])
    return found.withColumns({"d": F.round("d", 9), "p_value": F.round("p_value", 6)})


MOOD = """with m as (select median(value) as median from events where event_type in ('purchase', 'error')),
   c as (select count(*) filter (event_type = 'purchase' and value > median) as above_a,
                count(*) filter (event_type = 'error' and value > median) as above_b,
                count(*) filter (event_type = 'purchase' and value < median) as below_a,
                count(*) filter (event_type = 'error' and value < median) as below_b, any_value(median) as median
         from events, m)"""


@query(
    "median_table_fisher",
    f"""{MOOD}, x as (select *, above_a + above_b as mk, above_a + below_a as dr,
                     above_a + above_b + below_a + below_b as tot from c),
        p as (select sum(exp(lgamma(mk + 1.0) - lgamma(i + 1.0) - lgamma(mk - i + 1.0)
                   + lgamma(tot - mk + 1.0) - lgamma(dr - i + 1.0) - lgamma(tot - mk - dr + i + 1.0)
                   - lgamma(tot + 1.0) + lgamma(dr + 1.0) + lgamma(tot - dr + 1.0))) as p
              from x, lateral (select unnest(range(above_a, least(mk, dr) + 1)) as i))
        select round(median, 6) as median, above_a, above_b, below_a, below_b,
               round(above_a * below_b / (below_a * above_b), 9) as odds_ratio, round(p, 6) as p_value from x, p""",
)
def _(t):
    table = T.median_table(t.events, "value", "event_type", "purchase", "error")
    found = T.fisher_exact(table)
    return found.withColumns(
        {"median": F.round("median", 6), "odds_ratio": F.round("odds_ratio", 9), "p_value": F.round("p_value", 6)}
    )


@query(
    "mood_chi2",
    f"""{MOOD} select above_a, above_b, below_a, below_b, round(tot * pow(greatest(abs(above_a * below_b - above_b * below_a)
              - tot / 2, 0), 2) / ((above_a + above_b) * (below_a + below_b) * (above_a + below_a)
              * (above_b + below_b)::double), 9) as chi2
        from (select *, above_a + above_b + below_a + below_b as tot from c)""",
)
def _(t):
    table = T.median_table(t.events, "value", "event_type", "purchase", "error")
    return rounded(T.mood_p(table), ["chi2"], 9).drop("median", "p_value")


@query(
    "levene",
    """with z as (select event_type, abs(value - m) as z from events join
                   (select event_type, median(value) as m from events group by 1) using (event_type)),
       g as (select count(*) as n, avg(z) as m, var_pop(z) as v from z group by event_type),
       a as (select sum(n * m) / sum(n) as grand, sum(n)::bigint as n, count(*) as k, sum(n * v) as within from g)
       select n, k as n_groups, round((n - k) / (k - 1) * (select sum(g.n * pow(g.m - a.grand, 2)) from g, a) / within, 6) as w
       from a""",
)
def _(t):
    return rounded(M.levene(t.events, "value", "event_type", p_value=False), ["w"])


@query(
    "levene_p",
    f"""with l as (select event_type, 'value' as c, value as v from {E} union all select event_type, 'k', k from {E}),
        z as (select event_type, c, abs(v - m) as z from l join
                (select event_type, c, median(v) as m from l group by 1, 2) using (event_type, c)),
        g as (select event_type, c, count(*) as n, avg(z) as m, var_pop(z) as v from z group by 1, 2),
        a as (select event_type, sum(n * m) / sum(n) as grand, sum(n) as n, sum(n * v) as within from g group by 1),
        w as (select event_type, a.n::bigint as n, (a.n - 2) * sum(g.n * pow(g.m - grand, 2)) / any_value(within) as w
              from g join a using (event_type) group by event_type, a.n)
        select event_type, n, round(w, 6) as w, round({f_tail_sql("w", "1", "(n - 2)")}, 6) as p_value from w""",
)
def _(t):
    found = M.levene_columns(measured(t), ["value", "k"], ["event_type"])
    return rounded(found, ["w", "p_value"]).drop("n_groups")


TTEST = """with s as (select (user_id % 3)::int as bucket, avg(value) filter (event_type = 'view') as ma,
      avg(value) filter (event_type = 'purchase') as mb, var_samp(value) filter (event_type = 'view') as va,
      var_samp(value) filter (event_type = 'purchase') as vb, count(*) filter (event_type = 'view') as na,
      count(*) filter (event_type = 'purchase') as nb from events group by 1),
   p as (select *, sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) as sp from s)
   select bucket, na as n_a, nb as n_b, round((ma - mb) / sp, 9) as cohen_d,
     round((ma - mb) / (sp * sqrt(1 / na + 1 / nb)), 9) as t,
     case when abs((ma - mb) / sp) < 0.2 then 'negligible' when abs((ma - mb) / sp) < 0.5 then 'small'
          when abs((ma - mb) / sp) < 0.8 then 'medium' else 'large' end as effect from p"""


@query("ttest_independent", TTEST)
def _(t):
    found = M.ttest_ind(bucketed(t), "value", "event_type", "view", "purchase", ["bucket"], p_value=False)
    return rounded(found, ["cohen_d", "t"], 9).select("bucket", "n_a", "n_b", "cohen_d", "t", "effect")


@query(
    "ttest_independent_p",
    f"""select bucket, n_a, n_b, round(2 * {t_tail_sql("t", "(n_a + n_b - 2)")}, 6) as p_value from ({TTEST})""",
)
def _(t):
    found = M.ttest_ind(bucketed(t), "value", "event_type", "view", "purchase", ["bucket"])
    return rounded(found, ["p_value"]).select("bucket", "n_a", "n_b", "p_value")


@query(
    "pearson",
    f"select event_type, count(*) as n, round(corr(value, k), 9) as r from {E} group by 1",
)
def _(t):
    return rounded(M.pearson(measured(t), "value", "k", ["event_type"], p_value=False), ["r"], 9)


SPEARMAN = """select {by}, count(*) as n, round(corr(rx, ry), 9) as r from (
    select {by}, rank() over (partition by {by} order by x) + (count(*) over (partition by {by}, x) - 1) / 2.0 as rx,
           rank() over (partition by {by} order by y) + (count(*) over (partition by {by}, y) - 1) / 2.0 as ry
    from {source}) group by all"""


@query("spearman", SPEARMAN.format(by="event_type", source=f"(select *, value as x, k as y from {E})"))
def _(t):
    return rounded(T.spearman(measured(t), "value", "k", ["event_type"], p_value=False), ["r"], 9)


MATRIX = f"""with long as (select event_type, variable, measure, x, y from (
          select event_type, 'two_valued' as variable, 'value' as measure, (user_id % 2)::double as x, value as y from {E}
          union all select event_type, 'two_valued', 'k', user_id % 2, k from {E}
          union all select event_type, 'ordered', 'value', user_id % 4, value from {E}
          union all select event_type, 'ordered', 'k', user_id % 4, k from {E}))
        select event_type, variable, measure, 'Spearman' as method, n, r from
          ({SPEARMAN.format(by="event_type, variable, measure", source="long")})
        where not (variable = 'two_valued' and event_type = 'view' and measure = 'value')
        union all select event_type, variable, measure, 'Pearson', count(*), round(corr(x, y), 9) from long
        where variable = 'two_valued' and event_type = 'view' and measure = 'value' group by all"""


@query("correlation_matrix", MATRIX)
def _(t):
    return rounded(matrix(t, p_value=False), ["r"], 9)


def matrix(t, **how):
    m = measured(t).withColumns({"two_valued": F.col("user_id") % 2, "ordered": F.col("user_id") % 4})
    return R.corr_matrix(
        m,
        "event_type",
        ["two_valued", "ordered"],
        ["value", "k"],
        dichotomous=["two_valued"],
        normal=[("view", "value")],
        **how,
    )


@query(
    "correlation_summary",
    f"""select event_type, variable, measure, method, n, r, p as p_value,
          case when p < 0.05 then 'significant (p < 0.05)' else 'not significant (p >= 0.05)' end as interpretation
        from (select *, round(2 * {t_tail_sql("(r * sqrt((n - 2) / (1 - r * r)))", "(n - 2)")}, 6) as p from ({MATRIX}))""",
)
def _(t):
    return rounded(rounded(R.corr_summary(matrix(t)), ["r"], 9), ["p_value"])


@query(
    "linear_fit",
    f"""select event_type, count(*) as n, round(regr_slope(value, k), 9) as slope,
               round(regr_intercept(value, k), 6) as intercept, round(regr_r2(value, k), 9) as r2 from {E} group by 1""",
)
def _(t):
    found = M.linear_fit(measured(t), "k", "value", ["event_type"])
    return found.select(
        "event_type",
        "n",
        F.round("slope", 9).alias("slope"),
        F.round("intercept", 6).alias("intercept"),
        F.round("r2", 9).alias("r2"),
    )


@query(
    "decision",
    """select bucket, case when abs(t) > 1.96 then 'reject' else 'do not reject' end as decision from
       (select bucket, t from (""" + TTEST + """))""",
)
def _(t):
    from ..functions.pvalues import decide

    found = M.ttest_ind(bucketed(t), "value", "event_type", "view", "purchase", ["bucket"])
    return found.select("bucket", decide("p_value").alias("decision"))
