"""Tests against hand-computed, published or brute-force values."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallgrain.functions import distributions as D
from tallgrain.functions.pvalues import decide
from tallgrain.stats import corr, moments as M, ranktests as T, shared as S


@pytest.mark.parametrize(
    "got, want",
    [
        (D.normal_sf(1.959963984540054), 0.025),
        (D.t_sf(2.2281388519649385, 10), 0.025),
        (D.t_sf(-2.2281388519649385, 10), 0.975),
        (D.t_sf(1.0, 1), 0.25),
        (D.chi2_sf(3.841458820694124, 1), 0.05),
        (D.chi2_sf(9.487729036781154, 4), 0.05),
        (D.f_sf(4.9646027437307145, 1, 10), 0.05),
        (D.f_sf(3.325834529923155, 5, 10), 0.05),
        (D.hypergeom_sf(3, 8, 4, 4), 17 / 70),
        (D.hypergeom_sf(8, 16, 10, 9), 280 / 11440),
        (D.hypergeom_sf(1, 16, 10, 9), 1.0),
        (D.signed_rank_sf(15, 5), 1 / 32),
        (D.signed_rank_sf(0, 5), 1.0),
        (D.rank_sum_sf(9, 3, 3), 1 / 20),
        (D.rank_sum_sf(0, 3, 4), 1.0),
        (D.ks_sf(1.0, 3, 3), 2 / 20),
        (D.ks_sf(0.8, 5, 5), 20 / 252),
        (D.ks_sf(1.0, 2, 3), 2 / 10),
    ],
)
def test_published_tails(got, want):
    assert got == pytest.approx(want, rel=1e-9)


def test_large_samples_meet_the_limits():
    assert D.t_sf(1.7, 9e6) == pytest.approx(D.normal_sf(1.7), rel=1e-6)
    assert D.f_sf(2.0, 3, 9e6) == pytest.approx(D.chi2_sf(6.0, 3), rel=1e-5)
    assert D.hypergeom_sf(500_500, 2_000_000, 1_000_000, 1_000_000) == pytest.approx(
        D.normal_sf((500_500 - 500_000 - 0.5) / 353.5535), rel=1e-3
    )


@settings(max_examples=60, deadline=None)
@given(st.floats(-30, 30), st.integers(1, 300))
def test_t_tails_are_symmetric(t, dof):
    assert D.t_sf(t, dof) + D.t_sf(-t, dof) == pytest.approx(1.0, abs=1e-12)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 7), st.integers(1, 9))
def test_rank_sum_counts_all_arrangements(n1, n2):
    total = sum(D.rank_sum_sf(u, n1, n2) - D.rank_sum_sf(u + 1, n1, n2) for u in range(n1 * n2 + 1))
    assert total == pytest.approx(1.0)
    assert D.rank_sum_sf(n1 * n2, n1, n2) == pytest.approx(1 / math.comb(n1 + n2, n1))


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


def test_shapiro_published(spark):
    """Weights of eleven men from the paper that introduced the test: W = 0.79."""
    men = [148.0, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    row = T.shapiro(frame(spark, g=["m"] * 11, x=men), "x", ["g"]).first()
    assert row["n"] == 11
    assert row["w"] == pytest.approx(0.7888, abs=2e-4)
    assert row["p_value"] == pytest.approx(0.0067, abs=2e-4)


def test_shapiro_long_ties_are_cut(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(0, 2, 900))
    whole = T.shapiro(frame(spark, x=x), "x").first()
    monkeypatch.setattr(T, "PLACES_PER_LINE", 10)
    cut = T.shapiro(frame(spark, x=x), "x").first()
    assert cut["w"] == pytest.approx(whole["w"], rel=1e-12)


def test_paired_t(spark):
    pre, post = [10.0, 12, 9, 11, 8], [13.0, 14, 10, 15, 8]
    row = M.ttest_rel(frame(spark, pre=pre, post=post), "post", "pre").first()
    diff = np.array(post) - np.array(pre)
    assert row["cohen_d"] == pytest.approx(diff.mean() / diff.std(ddof=1))
    assert row["t"] == pytest.approx(diff.mean() / diff.std(ddof=1) * math.sqrt(5))
    assert row["p_value"] == pytest.approx(D.t_sf(row["t"], 4))


def test_independent_t_and_effect(spark):
    df = frame(spark, g=list("aaabbbb"), v=[5.0, 6, 7, 1, 2, 2, 3])
    row = M.ttest_ind(df, "v", "g", "a", "b").first()
    pooled = math.sqrt((2 * 1.0 + 3 * np.var([1, 2, 2, 3], ddof=1)) / 5)
    assert row["cohen_d"] == pytest.approx((6 - 2) / pooled)
    assert row["effect"] == "large" and row["p_value"] < 0.01


def test_wilcoxon_exact_zeros_and_log(spark):
    row = T.wilcoxon(frame(spark, d=[1.0, 2, 3, 4, 5]), "d").first()
    assert (row["w"], row["p_value"]) == (15.0, pytest.approx(1 / 32))
    row = T.wilcoxon(frame(spark, d=[0.0, 1, -2, 3, 4]), "d").first()
    assert (row["n_rows"], row["n_zero"], row["n_used"], row["w"]) == (5, 1, 4, 8.0)
    row = T.wilcoxon(frame(spark, d=[-1.0, 0, 1, math.e, math.e**2]), "d", transform="log").first()
    assert (row["n_dropped"], row["n_zero"], row["n_used"], row["w"]) == (2, 1, 2, 3.0)


def test_mannwhitney_exact(spark):
    row = T.mannwhitney(frame(spark, g=list("aaabbb"), v=[4.0, 5, 6, 1, 2, 3]), "v", "g", "a", "b").first()
    assert row["u"] == 9 and row["p_value"] == pytest.approx(0.1)


def test_mannwhitney_exact_against_a_hot_group(spark):
    """Up to 8 untied values stay exact however many stand on the other side."""
    v = F.col("id").cast("double")
    big = spark.range(200_000).select(F.lit("b").alias("g"), v.alias("v"))
    df = big.unionByName(spark.range(200_000, 200_001).select(F.lit("a").alias("g"), v.alias("v")))
    row = T.mannwhitney(df, "v", "g", "a", "b").first()
    assert row["u"] == 200_000 and row["p_value"] == pytest.approx(2 / 200_001, rel=1e-12)
    # all 8 on top: one arrangement of C(n + 8, 8) on each side
    df = big.unionByName(spark.range(200_000, 200_008).select(F.lit("a").alias("g"), v.alias("v")))
    assert T.mannwhitney(df, "v", "g", "b", "a").first()["p_value"] == pytest.approx(2 / math.comb(200_008, 8), rel=1e-12)


@pytest.mark.parametrize("n1, n2", [(1, 9), (3, 5), (5, 3), (4, 60), (7, 70), (8, 300)])
def test_rank_sum_counts_against_plain_counting(n1, n2):
    # whole numbers: ways[a][u] choices of a of the first b + a values, by whether the last is taken
    ways = [[1] + [0] * (n1 * n2)] + [[0] * (n1 * n2 + 1) for _ in range(n1)]
    for place in range(1, n1 + n2 + 1):
        for a in range(min(n1, place), 0, -1):
            gain = place - a  # values of the other side below the taken one
            if gain <= n2:
                for u in range(n1 * n2, gain - 1, -1):
                    ways[a][u] += ways[a - 1][u - gain]
    counts, total = ways[n1], math.comb(n1 + n2, n1)
    assert sum(counts) == total
    for u in {0, 1, n1 * n2 // 3, n1 * n2 // 2, n1 * n2 // 2 + 1, n1 * n2 - 5, n1 * n2}:
        assert D.rank_sum_sf(u, n1, n2) == sum(counts[u:]) / total


def test_kruskal_published(spark):
    """Mucociliary efficiency, Hollander and Wolfe: H = 0.77, p = 0.68."""
    x = [2.9, 3.0, 2.5, 2.6, 3.2]
    y = [3.8, 2.7, 4.0, 2.4]
    z = [2.8, 3.4, 3.7, 2.2, 2.0]
    df = frame(spark, g=["x"] * 5 + ["y"] * 4 + ["z"] * 5, v=x + y + z)
    row = T.kruskal(df, "v", "g").first()
    assert row["h"] == pytest.approx(0.77143, abs=1e-5)
    assert row["p_value"] == pytest.approx(0.68, abs=1e-3)


def test_ks_by_group_and_columns(spark):
    df = frame(spark, g=list("aaaaabbbbb"), v=[1.0, 2, 3, 4, 9, 5, 6, 7, 8, 10])
    row = T.ks_2samp(df, "v", "g", "a", "b").first()
    assert row["d"] == pytest.approx(0.8) and row["p_value"] == pytest.approx(20 / 252)
    two = frame(spark, a=[1, 2, 3, 4, 9], b=[5, 6, 7, 8, 10])
    assert T.ks_columns(two, "a", "b").first()["d"] == pytest.approx(0.8)


def test_median_table_and_fisher(spark):
    df = frame(spark, g=list("aaaaabbbbb"), v=[6.0, 7, 8, 9, 5, 1, 2, 3, 4, 5])
    row = T.fisher_exact(T.median_table(df, "v", "g", "a", "b")).first()
    cells = (row["above_a"], row["above_b"], row["below_a"], row["below_b"])
    assert row["median"] == 5 and cells == (4, 0, 0, 4)
    assert row["odds_ratio"] == math.inf and row["p_value"] == pytest.approx(1 / 70)


def test_levene_brute_force(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(list("abc"), 300), "v": rng.normal(0, 1, 300)})
    z = (pdf["v"] - pdf.groupby("g")["v"].transform("median")).abs()
    grand, parts = z.mean(), [p for _, p in z.groupby(pdf["g"])]
    between = sum(len(p) * (p.mean() - grand) ** 2 for p in parts) / 2
    within = sum(((p - p.mean()) ** 2).sum() for p in parts) / 297
    row = M.levene(spark.createDataFrame(pdf), "v", "g").first()
    assert row["w"] == pytest.approx(between / within)
    assert row["p_value"] == pytest.approx(D.f_sf(between / within, 2, 297))


@pytest.mark.parametrize("shuffle", [1, 4, 64])
def test_spearman_with_a_hot_value(spark, partitions, shuffle):
    partitions(shuffle)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, 2000)
    pdf = pd.DataFrame({"g": rng.choice(list("ab"), 2000), "x": x, "y": rng.normal(x, 3).round(1)})
    got = {r["g"]: r for r in T.spearman(spark.createDataFrame(pdf), "x", "y", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g]["n"] == len(part)
        assert got[g]["r"] == pytest.approx(part["x"].rank().corr(part["y"].rank()))


def test_single_row_and_constant_groups(spark):
    df = frame(spark, g=["a", "b", "b"], x=[1.0, 2, 2], y=[1.0, 2, 3])
    found = {r["g"]: r for r in corr.corr_summary(T.spearman(df, "x", "y", ["g"])).collect()}
    assert found["a"]["r"] is None and found["a"]["interpretation"] == "not computable"
    assert found["b"]["r"] is None


def test_corr_matrix_methods(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(
        {
            "g": rng.choice(list("ab"), 400),
            "yes": rng.integers(0, 2, 400),
            "grade": rng.integers(0, 4, 400),
            "m": rng.normal(0, 1, 400),
        }
    )
    m = corr.corr_matrix(
        spark.createDataFrame(pdf), "g", ["yes", "grade"], ["m"], ["yes"], [("a", "m")]
    )
    found = {(r["g"], r["variable"]): (r["method"], r["r"], r["p_value"]) for r in m.collect()}
    a = pdf[pdf["g"] == "a"]
    assert found["a", "yes"][:2] == ("Pearson", pytest.approx(a["yes"].corr(a["m"])))
    assert found["a", "grade"][:2] == ("Spearman", pytest.approx(a["grade"].rank().corr(a["m"].rank())))
    assert found["b", "yes"][0] == "Spearman" and all(0 <= v[2] <= 1 for v in found.values())


def test_decide(spark):
    df = spark.createDataFrame([(0.01,), (0.2,), (None,), (float("nan"),)], "p double")
    got = [r[0] for r in df.select(decide("p")).collect()]
    assert got == ["reject", "do not reject", "not computable", "not computable"]


def test_skewness_is_biased(spark):
    x = np.array([1.0, 2, 2, 3, 9])
    got = M.skewness(frame(spark, x=x), ["x"]).first()["x"]
    assert got == pytest.approx(((x - x.mean()) ** 3).mean() / x.std() ** 3)


def test_perfect_correlation(spark):
    row = M.pearson(frame(spark, x=[1.0, 2, 3, 4], y=[2.0, 4, 6, 8]), "x", "y").first()
    assert row["r"] == pytest.approx(1.0) and row["p_value"] == pytest.approx(0.0, abs=1e-9)


def test_linear_fit(spark):
    row = M.linear_fit(frame(spark, x=[1.0, 2, 3], y=[3.0, 5, 7]), "x", "y").first()
    assert (row["slope"], row["intercept"]) == (pytest.approx(2), pytest.approx(1))


def test_degenerate_groups_give_nothing_instead_of_failing(spark):
    """One side missing, a single row, all values equal."""
    df = spark.createDataFrame(
        [("one", "a", 1.0), ("flat", "a", 2.0), ("flat", "b", 2.0), ("side", "a", 1.0), ("side", "a", 3.0)],
        "k string, g string, v double",
    )
    for found, stat in (
        (T.ks_2samp(df, "v", "g", "a", "b", ["k"]), "d"),
        (T.kruskal(df, "v", "g", ["k"]), "h"),
        (M.ttest_ind(df, "v", "g", "a", "b", ["k"]), "t"),
        (M.levene(df, "v", "g", ["k"]), "w"),
        (T.spearman(df.withColumn("w", df["v"]), "v", "w", ["k"]), "r"),
    ):
        got = {r["k"]: r for r in found.collect()}
        assert set(got) == {"one", "flat", "side"}
        assert got["one"][stat] is None and got["one"]["p_value"] is None
    sides = {r["k"]: r for r in T.mannwhitney(df, "v", "g", "a", "b", ["k"]).collect()}
    assert sides["flat"]["u"] == 0.5 and sides["flat"]["p_value"] == 1.0
    table = T.fisher_exact(T.median_table(df, "v", "g", "a", "b", ["k"])).collect()
    assert len(table) == 3
    assert T.wilcoxon(df.filter("k = 'one'"), "v", ["k"]).first()["p_value"] == 0.5
    assert len(T.shapiro(df, "v", ["k"]).collect()) == 3


def test_rank_sum_tail_is_never_negative():
    from tallgrain.functions.distributions import rank_sum_sf

    top = 8 * 12_500
    assert rank_sum_sf(top, 8, 12_500) == pytest.approx(1 / math.comb(12_508, 8), rel=1e-9)
    assert rank_sum_sf(0, 8, 12_500) == 1.0


def test_normal_quantile_expression(spark):
    from statistics import NormalDist

    from tallgrain.functions.pvalues import normal_quantile

    ps = [1e-300, 1e-14, 1e-9, 0.001, 0.02, 0.074, 0.076, 0.3, 0.5, 0.7, 0.924, 0.926, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = {r.p: r.z for r in df.select("p", normal_quantile(F.col("p")).alias("z")).collect()}
    assert got == {p: pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-15) for p in ps}


def test_shapiro_with_long_ties_needs_no_python_per_row(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("v"))
    found = T.shapiro(df, "v", p_value=False)
    assert 0 < found.first()["w"] < 1


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(12)
    n = 600
    pdf = pd.DataFrame(
        {
            "g": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
            "dom": rng.choice(["x", "y"], n),
            "v": np.round(rng.normal(0, 1, n), 1),
            "w": np.round(rng.exponential(1, n), 1),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(5)


def same(one, two, keys, columns):
    a = {tuple(r[k] for k in keys): [r[c] for c in columns] for r in one.collect()}
    b = {tuple(r[k] for k in keys): [r[c] for c in columns] for r in two.collect()}
    assert a.keys() == b.keys() and a
    for k in a:
        assert a[k] == [pytest.approx(x, abs=1e-9) for x in b[k]], k


def test_shared_ties_agree_with_single_tests(scores):
    _, df = scores
    ties = S.shared_ties(df, {"v": F.col("v"), "w": F.col("w")}, "g", ["dom"])
    moments = df.groupBy("dom", "g").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("var"))
    moments = moments.withColumn("measure", F.lit("v"))
    pairs = S.median_tests(ties.pairs(["v"])).where("a = 'a' and b = 'c'")
    whitney = T.mannwhitney(df, "v", "g", "a", "c", ["dom"])
    same(pairs, whitney, ["dom"], ["n_a", "n_b", "u", "ties"])
    same(pairs, T.ks_2samp(df, "v", "g", "a", "c", ["dom"]), ["dom"], ["d"])
    table = T.median_table(df, "v", "g", "a", "c", ["dom"])
    same(pairs, T.fisher_exact(table), ["dom"], ["median", "above_a", "above_b", "below_a", "below_b", "odds_ratio"])
    levene = S.levene_pairs(ties, ["v"]).where("a = 'b' and b = 'c'")
    same(levene, M.levene(df.where("g <> 'a'"), "v", "g", ["dom"]), ["dom"], ["n", "w", "p_value"])
    student = S.ttest_pairs(ties, moments).where("a = 'a' and b = 'b'")
    same(student, M.ttest_ind(df, "v", "g", "a", "b", ["dom"]), ["dom"], ["t", "cohen_d", "p_value"])
    same(S.kruskal_all(ties, "w"), T.kruskal(df, "w", "g", ["dom"]), ["dom"], ["n", "n_groups", "h", "p_value"])
    same(S.shapiro_all(ties, moments, "v"), T.shapiro(df, "v", ["dom", "g"]), ["dom", "g"], ["n", "w", "p_value"])
    same(S.spearman_own(df, ties, "v", "w"), T.spearman(df, "v", "w", ["dom", "g"], p_value=False), ["dom", "g"], ["n", "r"])
    assert ties.pairs(["v", "w"]).count() == 2 * 2 * 3


def test_shared_ties_of_no_rows_and_many_groups(spark, monkeypatch):
    empty = spark.createDataFrame([], "g string, v double")
    ties = S.shared_ties(empty, {"v": F.col("v")}, "g")
    assert ties.names == [] and ties.lines.count() == 0
    monkeypatch.setattr(S, "MOST_GROUPS", 2)
    with pytest.raises(ValueError, match="more than 2 groups"):
        S.group_names(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "g string"), "g")


def test_signed_rank_counts_what_it_drops(spark):
    df = frame(spark, x=[0.0, 0.0, -1.0, 2.0, 2.0, 3.0, np.nan, -0.5])
    row = T.wilcoxon(df, "x", p_value=False).first()
    assert (row["n_rows"], row["n_zero"], row["n_used"], row["n_dropped"]) == (7, 2, 5, 0)
    assert row["w"] == 3.5 + 3.5 + 5
    logs = T.wilcoxon(df, "x", transform="log", p_value=False).first()
    assert (logs["n_dropped"], logs["n_zero"], logs["n_used"], logs["w"]) == (4, 0, 3, 6.0)


def test_corr_matrix_with_missing_values(scores):
    pdf, df = scores
    holes = df.withColumn("h", F.when(F.col("v") < 1, F.col("v") * 2 + F.col("w")))
    m = corr.corr_matrix(holes, "dom", ["v", "h"], ["w"], p_value=False)
    found = {(r["dom"], r["variable"]): (r["n"], r["r"]) for r in m.collect()}
    for d, part in pdf.groupby("dom"):
        assert found[d, "v"] == (len(part), pytest.approx(part["v"].rank().corr(part["w"].rank())))
        some = part[part["v"] < 1]
        h = some["v"] * 2 + some["w"]
        assert found[d, "h"] == (len(some), pytest.approx(h.rank().corr(some["w"].rank())))


def test_corr_matrix_shuffles_alike_for_few_and_many_columns(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), *[F.rand(i).alias(f"c{i}") for i in range(8)])

    def exchanges(variables, measures):
        plan = corr.corr_matrix(df, "g", variables, measures, p_value=False)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    # one pair and sixteen; frequent values may add a branch, pairs add nothing
    assert exchanges(["c0", "c1", "c2", "c3"], ["c4", "c5", "c6", "c7"]) <= max(14, exchanges(["c0"], ["c1"]))
