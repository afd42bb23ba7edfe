"""Scaling, regression, AUC and clustering."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallgrain.learn import auc, kmeans, logreg
from tallgrain.learn.scaler import ColumnScaler
from tallgrain.learn.scoring import ScoringModel, train
from tallgrain.learn.split import split
from tallgrain.plans import absence

from .conftest import rows


def binary(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3)) * [1, 5, 0.2] + [0, 3, 1]
    p = 1 / (1 + np.exp(-(0.5 + x @ [1.0, -0.3, 2.0])))
    return pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=np.arange(n), y=(rng.random(n) < p).astype(int))


def test_scaler(spark):
    pdf = pd.DataFrame({"k": ["x", "y", "z"], "a": [1.0, 2, 3], "b": [5, 5, 5], "c": [9, 8, 7]})
    df = spark.createDataFrame(pdf)
    scaled = ColumnScaler(["a", "b"]).fit(df).transform(df).toPandas()
    assert list(scaled.columns) == ["k", "a", "b", "c"]
    assert np.allclose(scaled["a"], [-1.5**0.5, 0, 1.5**0.5]) and np.allclose(scaled["b"], 0)
    assert ColumnScaler("*").fit(df).stats.keys() == {"a", "b", "c"}
    with pytest.warns(UserWarning, match="more than once"):
        ColumnScaler(["a", "a"])
    again = ColumnScaler.from_table(ColumnScaler(["a"]).fit(df).to_table(spark))
    assert again.stats == {"a": (2.0, pytest.approx((2 / 3) ** 0.5))}


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000)
    a, b = split(df, 0.8, 20, "id")
    assert a.count() + b.count() == 2000 and a.join(b, "id").count() == 0
    assert 0.76 < a.count() / 2000 < 0.84
    again, _ = split(df.repartition(11), 0.8, 20, "id")
    assert rows(again) == rows(a)


def test_logistic_gradient_is_zero(spark):
    """The solution of: sum of losses + |w|^2 / (2 C), with a free intercept."""
    pdf = binary()
    model = logreg.fit_logreg(spark.createDataFrame(pdf), ["a", "b", "c"], "y", c=0.5)
    x, y, w = pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy(), np.array(model.coefs[0])
    p = 1 / (1 + np.exp(-(model.intercepts[0] + x @ w)))
    assert np.allclose(x.T @ (p - y) + w / 0.5, 0, atol=1e-2)
    assert abs((p - y).sum()) < 1e-2


def test_binary_predictions_and_table(spark):
    pdf = binary()
    df = spark.createDataFrame(pdf)
    model = logreg.fit_logreg(df, ["a", "b", "c"], "y")
    out = model.transform(df).toPandas()
    p = np.array(out["probability"].tolist())
    assert np.allclose(p.sum(axis=1), 1) and ((p[:, 1] > 0.5) == (out["prediction"] == 1)).all()
    got = logreg.accuracy(model.transform(df), "prediction", "y").first()
    assert got["accuracy"] == pytest.approx((out["prediction"] == out["y"]).mean())
    table = logreg.coef_table(spark, model).collect()
    assert len(table) == 4 and [r["odds_ratio"] for r in table] == sorted(
        (r["odds_ratio"] for r in table), reverse=True
    )
    assert {r["feature_name"] for r in table if r["position"] == 0} == {"Intercept"}


def test_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(binary())
    model = train(df, ["a", "b", "c"], "y", ["a", "b"])
    model.save(spark, f"{tmp_path}/m")
    back = ScoringModel.load(spark, f"{tmp_path}/m")
    assert back.model == model.model and back.scaler.stats == model.scaler.stats
    scaled = model.model.transform(model.scaler.transform(df)).select("id", F.col("probability")[1].alias("p"))
    both = back.score(df).join(scaled, "id").toPandas()
    assert np.allclose(both["Probability"], both["p"])
    assert ((both["Probability"] > 0.5) == (both["Prediction"] == 1)).all()


def test_multinomial(spark, tmp_path):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    pdf = pd.DataFrame({"u": rng.normal(y, 0.4), "v": rng.normal(-2 * (y == 1), 0.4), "y": y * 10})
    df = spark.createDataFrame(pdf)
    model = logreg.fit_logreg(df, ["u", "v"], "y")
    assert model.classes == [0.0, 10.0, 20.0]
    assert logreg.accuracy(model.transform(df), "prediction", "y").first()["accuracy"] > 0.9
    best = {r["class"]: r["feature"] for r in logreg.top_feature_per_class(spark, model).collect()}
    assert best[10.0] == "v" and best[20.0] == "u"
    model.save(spark, f"{tmp_path}/m")
    assert logreg.LogisticModel.load(spark, f"{tmp_path}/m") == model


def brute_auc(score, label):
    pos, neg = score[label == 1], score[label != 1]
    gap = pos[:, None] - neg[None, :]
    return ((gap > 0) + 0.5 * (gap == 0)).mean()


def test_auc(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 2, 400)
    score = np.round(rng.normal(label, 1), 1)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    got = auc.auc(df, "s", "y").first()["auc"]
    assert got == pytest.approx(brute_auc(score, label))
    assert auc.auc(df.withColumn("s", -F.col("s")), "s", "y").first()["auc"] == pytest.approx(1 - got)


def test_auc_one_vs_one(spark):
    rng = np.random.default_rng(6)
    y = rng.choice([3, 5, 8], 300)
    s = rng.random((300, 3)).round(2)
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(y, s)], "y int, s array<double>")
    classes, parts = [3, 5, 8], []
    for i, a in enumerate(classes):
        for j, b in enumerate(classes):
            if i != j:
                some = np.isin(y, [a, b])
                parts.append(brute_auc(s[some, i], (y[some] == a).astype(int)))
    assert auc.auc_ovo(df, "s", "y", classes).first()["auc"] == pytest.approx(np.mean(parts))
    assert auc.auc_pairs(df, "s", "y", classes).count() == 6


def test_kmeans(spark):
    rng = np.random.default_rng(2)
    centres = np.array([[0, 0], [50, 1], [100, 0]])
    which = rng.integers(0, 3, 300)
    pts = centres[which] + rng.normal(0, 1, (300, 2)) * [2, 0.05]
    pdf = pd.DataFrame(pts, columns=["x", "z"]).assign(id=np.arange(300))
    out = kmeans.kmeans(spark.createDataFrame(pdf), ["x", "z"], 3, seed=1).toPandas().sort_values("id")
    assert list(out.columns) == ["x", "z", "id", "cluster_pred"]
    assert (out["cluster_pred"].to_numpy() == which).all()


def test_elbow(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (200, 2)), columns=["x", "z"]))
    cost = {r["k"]: r["wcss"] for r in kmeans.elbow(df, ["x", "z"], range(1, 5), seed=1).collect()}
    assert cost[1] == pytest.approx(400) and cost[1] > cost[2] > cost[4]


def test_absence_batch_without_some_codes(spark):
    raw = spark.createDataFrame(
        [(3, 0, "07/07/2015", 2), (4, 20, "01/01/2016", None)],
        "ID int, `Reason for Absence` int, Date string, Education int",
    ).withColumns({c: F.lit(1) for c in absence.FEATURES[6:] if c != "Education"})
    got = absence.absence_features(raw, ["ID"]).orderBy("ID").collect()
    assert [got[0][f"Reason_{i}"] for i in (1, 2, 3, 4)] == [0, 0, 0, 0]
    assert [got[1][f"Reason_{i}"] for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert (got[0]["Month_value"], got[0]["Day of the Week"], got[0]["Education"]) == (7, 1, 1)
    assert got[1]["Education"] is None


def test_all_clusterings_at_once_equal_each_alone(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 1, (400, 2)), columns=["x", "z"]).assign(id=np.arange(400))
    pdf.loc[3, "x"] = np.nan
    df = spark.createDataFrame(pdf).repartition(4)
    every = kmeans.fit_kmeans(df, ["x", "z"], [1, 2, 5], seed=3, key="id", max_iter=8, settled=0.0)
    for k in (1, 2, 5):
        alone = kmeans.fit_kmeans(df.repartition(2), ["x", "z"], [k], seed=3, key="id", max_iter=8, settled=0.0)[k]
        assert np.allclose(alone.centres, every[k].centres) and alone.cost == pytest.approx(every[k].cost)
    both = kmeans.kmeans_many(df, ["x", "z"], [2, 5], seed=3, key="id", max_iter=8, settled=0.0).toPandas()
    assert list(both.columns) == ["x", "z", "id", "cluster_2", "cluster_5"] and len(both) == 399
    z = (both[["x", "z"]] - both[["x", "z"]].mean()) / both[["x", "z"]].std(ddof=0)
    gaps = ((z.to_numpy()[:, None] - every[5].centres[None]) ** 2).sum(axis=2)
    assert (gaps.argmin(axis=1) == both["cluster_5"]).all() and gaps.min(axis=1).sum() == pytest.approx(every[5].cost)


def test_clusterings_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "x double")
    assert kmeans.fit_kmeans(df, ["x"], [4])[4].cost == pytest.approx(0)
    assert kmeans.kmeans(df, ["x"], 2).select("cluster_pred").distinct().count() == 2
    assert kmeans.elbow(df.limit(0), ["x"], [1, 3]).collect()[1]["wcss"] == 0
    with pytest.raises(ValueError):
        kmeans.fit_kmeans(df, ["x"], [0])


def test_newton_reaches_the_optimum(spark):
    pdf = binary(400, 3).assign(twice=lambda d: 2 * d["a"])  # features that depend on each other
    features = ["a", "b", "c", "twice"]
    model = logreg.fit_logreg(spark.createDataFrame(pdf).repartition(3), features, "y", c=2.0)
    x, y, w = pdf[features].to_numpy(), pdf["y"].to_numpy(), np.array(model.coefs[0])
    p = 1 / (1 + np.exp(-(model.intercepts[0] + x @ w)))
    assert np.allclose(x.T @ (p - y) + w / 2.0, 0, atol=1e-6) and abs((p - y).sum()) < 1e-6
    parted = spark.createDataFrame(pd.DataFrame({"a": [-2.0, -1, 1, 2] * 5, "y": [0, 0, 1, 1] * 5}))
    assert 1 < logreg.fit_logreg(parted, ["a"], "y").coefs[0][0] < 5
