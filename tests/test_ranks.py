"""Ranks and quantiles against pandas and numpy, whatever the partitioning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallgrain.operators import ranks as R


def skewed(n=3000, seed=1):
    """One group with two thirds of the rows, one value with a third of them, gaps and NaN."""
    rng = np.random.default_rng(seed)
    g = rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1])
    v = np.round(rng.exponential(10, n), 1)
    v[rng.random(n) < 0.35] = 7.0
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    pdf.loc[::101, "v"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def data(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).repartition(7)
    return pdf, df.withColumn("v", F.when(F.col("id") % 202 != 0, F.col("v")))


@pytest.mark.parametrize("shuffle", [1, 4, 64])
@pytest.mark.parametrize("method", ["avg", "min", "max", "dense"])
def test_group_rank(spark, data, partitions, shuffle, method):
    pdf, df = data
    partitions(shuffle)
    got = R.group_rank(df, "v", ["g"], method).toPandas().set_index("id")["rank"].sort_index()
    want = pdf.groupby("g")["v"].rank("average" if method == "avg" else method)
    assert len(got) == len(want) and got.isna().sum() == pdf["v"].isna().sum() > 0
    assert np.allclose(got.to_numpy(float), want.to_numpy(float), equal_nan=True)


def test_frequent_value_takes_the_broadcast(spark, data, partitions):
    _, df = data
    partitions(64)
    grid = R.value_grid(R.present(df, ["v"]), ["v"], ["g"])
    assert grid.frequent["v"] and 7.0 in grid.frequent["v"]
    plan = R.group_rank(df, "v", ["g"])._jdf.queryExecution().toString()
    assert "LeftAnti" in plan


def test_rank_sum_is_that_of_all_places(spark, data):
    _, df = data
    n = df.filter(F.col("v").isNotNull() & ~F.isnan("v")).count()
    total = R.global_rank(df, "v").agg(F.sum("rank")).first()[0]
    assert total == n * (n + 1) / 2


def test_tie_table_with_split_and_weights(spark):
    df = spark.createDataFrame(
        [("x", 1.0, "p"), ("x", 1.0, "q"), ("x", 2.0, "p"), ("x", 3.0, "q"), ("x", 3.0, "q")],
        "g string, v double, s string",
    )
    lines = R.tie_table(df, "v", ["g"], split=["s"]).orderBy("v", "s").collect()
    assert [(r["v"], r["s"], r["n"], r["tie"], r["before"], r["rank"]) for r in lines] == [
        (1.0, "p", 1, 2, 0, 1.5),
        (1.0, "q", 1, 2, 0, 1.5),
        (2.0, "p", 1, 1, 2, 3.0),
        (3.0, "q", 2, 2, 3, 4.5),
    ]
    w = R.tie_table(df, "v", weights={"q": F.count_if(F.col("s") == "q")}).orderBy("v").collect()
    assert [(r["q"], r["q_before"], r["q_total"]) for r in w] == [(1, 0, 3), (0, 1, 3), (2, 1, 3)]


@pytest.mark.parametrize("shuffle", [1, 4, 64])
def test_exact_quantiles(spark, data, partitions, shuffle):
    pdf, df = data
    partitions(shuffle)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = R.exact_quantiles(df, ["v", "id"], probs, ["g"]).collect()
    found = {(r["g"], r["column"], r["prob"]): r["quantile"] for r in got}
    assert len(found) == 3 * 2 * len(probs)
    for g, part in pdf.groupby("g"):
        for p in probs:
            assert np.isclose(found[g, "v", p], np.quantile(part["v"].dropna(), p))
            assert np.isclose(found[g, "id", p], np.quantile(part["id"], p))


def test_quantiles_with_many_groups_use_no_broadcast_of_groups(spark, monkeypatch):
    monkeypatch.setattr(R, "SMALL_GROUPS", 10)
    pdf = pd.DataFrame({"g": np.arange(600) % 50, "v": np.random.default_rng(3).random(600)})
    got = R.quantiles_wide(spark.createDataFrame(pdf), "v", {"m": 0.5}, ["g"]).toPandas()
    want = pdf.groupby("g")["v"].median()
    assert np.allclose(got.set_index("g")["m"].sort_index(), want)


def test_one_value_and_no_rows(spark):
    one = spark.createDataFrame([(5.0,)], "v double")
    assert R.quantiles_wide(one, "v", {"m": 0.5}).collect()[0]["m"] == 5.0
    none = spark.createDataFrame([], "v double")
    assert R.exact_quantiles(none, ["v"], [0.5]).collect() == []
    assert R.group_rank(none, "v").collect() == []


def test_dates_and_timestamps_have_places(spark):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-02 00:00:00', date'2024-05-01'),"
        " (2, timestamp_ntz'2024-01-01 00:00:00', date'2024-06-01') t(id, ts, d)"
    )
    assert [r["id"] for r in R.row_slice(df, "ts", 0, 1).collect()] == [2]
    assert [r["id"] for r in R.row_slice(df, "d", 0, 1).collect()] == [1]


def test_no_range_holds_a_whole_group(spark, data, partitions):
    """The largest (group, range) has a small share of the counted values."""
    _, df = data
    partitions(16)
    some = R.present(df, ["v", "g"])
    grid = R.value_grid(some, ["v"], ["g"], ranges=16)
    counted = some.groupBy("g", "v").count()
    sizes = R.with_range(counted, "v", grid.edges["v"]).groupBy("g", "_range").count()
    shares = sizes.agg(F.max("count") / F.sum("count")).first()[0]
    assert shares < 0.25


def test_ranges_that_are_too_full_are_cut_again(spark):
    n = 20_000
    df = spark.range(0, n, 1, 9).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0))  # a third of the rows is one value
        .when(F.col("id") % 3 == 1, 5.0 + F.col("id") / 1e12)  # a third lies next to it
        .otherwise(F.exp(F.col("id") / 1000.0))
        .alias("v")
    )
    grid = R.value_grid(df, ["v"], ranges=2, limit=300)
    ranged = R.with_range(df, "v", grid.edges["v"])
    sizes = ranged.groupBy("_range").agg(F.count("v").alias("n"), F.countDistinct("v").alias("d"))
    assert sizes.where("n > 300 and d > 1").count() == 0
    got = R.tie_table(df, "v", grid=grid).agg(F.sum(F.col("n") * F.col("rank")), F.max("total")).first()
    assert got == (n * (n + 1) / 2, n)


def test_sketches_meet_in_slots(spark):
    df = spark.range(0, 5000, 1, 200).select((F.col("id") % 977).cast("double").alias("v"), (F.col("id") % 7).alias("g"))
    grid = R.value_grid(df, ["v"], ["g"], ranges=16)
    assert grid.rows == 5000 and 6 <= grid.groups <= 8 and len(grid.edges["v"]) == 15
    sizes = [r["count"] for r in R.with_range(df, "v", grid.edges["v"]).groupBy("_range").count().collect()]
    assert max(sizes) < 3 * 5000 / 16
    assert R.value_grid(df.limit(0), ["v"], ["g"]).rows == 0


def test_order_values_and_slices(spark, data):
    pdf, df = data
    ordered = np.sort(pdf["v"].dropna().to_numpy())
    places = [0, 1, 17, 1500, len(ordered) - 1, len(ordered), -1]
    total, got = R.order_values(df, "v", places)
    assert total == len(ordered) and got == {p: ordered[p] for p in places[:5]}
    keyed = spark.range(0, 1000, 1, 5).select((F.col("id") * 3 + 2**60).alias("k"), F.col("id").alias("x"))
    keyed = keyed.unionByName(spark.sql("select cast(null as bigint) k, 1L x")).repartition(6)
    for start, stop in [(0, 5), (10, 20), (995, None), (0, None), (990, 2000), (1000, 1001), (5, 5)]:
        rows = R.row_slice(keyed, "k", start, stop, [1])
        assert sorted(r.x for r in rows.collect()) == list(range(1000))[start:stop]
    plan = R.row_slice(keyed, "k", 10, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_slices_share_the_position_of_equal_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,)], "k int")
    assert sorted(r.k for r in R.row_slice(df, "k", 1, 4).collect()) == [2, 2, 2]
    assert sorted(r.k for r in R.row_slice(df, "k", 0, 1).collect()) == [1, 1]
    assert sorted(r.k for r in R.row_slice(df, "k", 3).collect()) == [3]
