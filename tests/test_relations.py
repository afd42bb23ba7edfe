"""Joins under skew, constraints, reshaping, summaries, samples."""

import pytest
from pyspark.sql import functions as F

from tallgrain.checks import constraints as Q
from tallgrain.operators import describe, joins, reshape
from tallgrain.sources import synth

from .conftest import rows


@pytest.fixture(scope="module")
def skew(spark):
    """A third of the facts share one key; some keys are null or unknown."""
    facts = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 40)
        .cast("int")
        .alias("k"),
    )
    dims = spark.range(30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    return facts, dims


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("shuffle", [1, 4, 64])
def test_spread_join_is_a_join(skew, partitions, how, shuffle):
    partitions(shuffle)
    facts, dims = skew
    assert rows(joins.spread_join(facts, dims, ["k"], how)) == rows(facts.join(dims, ["k"], how))


def test_hot_keys_are_few(skew):
    facts, _ = skew
    assert [r[0] for r in joins.hot_keys(facts, ["k"], 0.2).collect()] == [7]


def test_orphans_and_cascade(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "p int")
    assert rows(joins.orphans(child, parent, "k", "p")) == [(1, 2)]
    assert rows(joins.cascade_delete(child, parent, "k", "p")) == [(1,), (1,), (None,)]
    assert tuple(Q.check_fk(child, parent, "k", "p").first()) == (1, 2)


def test_aligned_ratio(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")
    b = spark.createDataFrame([("x", 4), ("z", 5)], "k string, n int")
    assert rows(joins.aligned_ratio(a, b, ["k"], "n")) == [("x", 0.25), ("y", None), ("z", None)]


def test_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b")], "a int, b string")
    assert tuple(Q.check_pk(df, ["a", "b"]).first()) == (4, 1, 1, 2)


def test_null_passes_checks_but_not_not_null(spark):
    df = spark.createDataFrame([(None, None), (5, "abc"), (200, "x")], "n int, s string")
    found = Q.validate(
        df, [Q.not_null("n"), Q.in_range("n", 18, 100), Q.member("s", ["x"]), Q.max_length("s", 2)]
    )
    assert [r["n_broken"] for r in found.collect()] == [1, 2, 1, 1]


def test_validate_is_one_scan(spark):
    df = spark.range(10)
    plan = Q.validate(df, [Q.not_null("id"), Q.in_range("id", 0, 5)])._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Range (") == 1


def test_melt_unstack(spark):
    wide = spark.createDataFrame([("g", 1.0, 2.0)], "g string, pre double, post double")
    long = reshape.melt(wide, ["g"], ["pre", "post"])
    assert rows(long) == [("g", "post", 2.0), ("g", "pre", 1.0)]
    assert rows(reshape.unstack(long, ["g"], "variable", ["pre", "post"], "value")) == rows(wide)


def test_box_stats(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    row = describe.box_stats(df, "v").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1, 5, 1)


def test_collapse_by_key(spark):
    df = spark.createDataFrame(
        [("k", 1.0, 0, "late", 9), ("k", 3.0, 1, "early", 2)], "k string, n double, f int, s string, o int"
    )
    got = describe.collapse_by_key(df, "k", ["n"], ["f"], [], ["s"], ["o"])
    assert rows(got) == [("k", 2.0, 1, "early")]


def test_sample_is_fixed_by_seed_not_by_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    a = synth.sample_with_ids(df, 20, "id", seed=1)
    b = synth.sample_with_ids(df.repartition(13), 20, "id", seed=1)
    assert rows(a) == rows(b) and a.count() == 20
    assert sorted(r["id"] for r in a.collect())[:2] == ["CL001", "CL002"]
    assert rows(a) != rows(synth.sample_with_ids(df, 20, "id", seed=2))


def test_all_rows_get_running_ids_and_the_sample_is_their_beginning(spark):
    df = spark.range(300).select("id", (F.col("id") * 3).alias("v"))
    every = synth.with_ids(df, "id", seed=4)
    assert sorted(r["v"] for r in every.collect()) == [3 * i for i in range(300)]
    assert sorted(int(r["id"][2:]) for r in every.collect()) == list(range(1, 301))
    assert set(rows(synth.sample_with_ids(df, 120, "id", seed=4))) < set(rows(every))


def test_generator_shape(spark):
    clients = synth.synth_clients(spark, 100, seed=3)
    products = synth.synth_products(clients, 30, seed=3)
    per_client = [r["count"] for r in products.groupBy("cliente_id").count().collect()]
    assert clients.count() == 100 and len(per_client) == 30 and set(per_client) <= {2, 3}
    report = Q.validate(
        clients,
        [
            Q.not_null("nombre"),
            Q.in_range("edad", 18, 100),
            Q.member("genero", ["Masculino", "Femenino", "Otro"]),
            Q.in_range("ingresos_anuales", 0),
            Q.in_range("score_credicio", 300, 850),
            Q.max_length("cliente_id", 20),
        ],
    )
    assert all(r["passed"] for r in report.collect())
    assert tuple(Q.check_pk(products, ["producto_id"]).first())[1:] == (0, 0, 0)
    assert tuple(Q.check_fk(products, clients, "cliente_id", "cliente_id").first()) == (0, 0)
    assert products.join(clients, ["cliente_id"]).count() == products.count()
