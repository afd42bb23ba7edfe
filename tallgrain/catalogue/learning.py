"""Scaling, regression, AUC, clustering and scoring."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..learn import auc as U
from ..learn import kmeans as K
from ..learn import logreg as L
from ..learn.scaler import ColumnScaler
from ..learn.scoring import ScoringModel, prediction_report
from ..learn.split import split
from ..session import shared_dir
from . import query
from .cleaning import HASHED
from .summaries import rounded


@query(
    "scale_columns",
    """select l_orderkey, l_linenumber, l_partkey, round((l_quantity - mq) / sq, 6) as l_quantity,
              round((l_extendedprice - mp) / sp, 6) as l_extendedprice, l_discount
       from lineitem, (select avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(l_extendedprice) mp,
                              stddev_pop(l_extendedprice) sp from lineitem)""",
)
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    scaled = ColumnScaler(["l_quantity", "l_extendedprice"]).fit(lines).transform(lines)
    return rounded(scaled, ["l_quantity", "l_extendedprice"])


@query(
    "scale_all",
    """select round((p_size - ms) / ss, 6) as p_size, round((p_retailprice - mp) / sp, 6) as p_retailprice
       from part, (select avg(p_size) ms, stddev_pop(p_size) ss, avg(p_retailprice) mp,
                          stddev_pop(p_retailprice) sp from part)""",
)
def _(t):
    some = t.part.select("p_size", "p_retailprice")
    return rounded(ColumnScaler("*").fit(some).transform(some), ["p_size", "p_retailprice"])


@query(
    "train_test_split",
    f"""select case when {HASHED.format(seed=20, key='o_orderkey', label='split')} < 3435973836
               then 'train' else 'test' end as part, count(*) as n_rows, sum(o_orderkey)::bigint as key_sum
        from orders group by 1""",
)
def _(t):
    train, test = split(t.orders, 0.8, 20, "o_orderkey")
    both = train.select(F.lit("train").alias("part"), "o_orderkey").unionByName(
        test.select(F.lit("test").alias("part"), "o_orderkey")
    )
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum")
    )


FEATURES = ["size_thousands", "share_blank", "is_en", "source_no"]


def labelled(t):
    """Label and a few measures of whole texts, written once: fitting reads them several times."""
    d = t.documents.select(
        "doc_id",
        (F.col("n_chars") / 1000).alias("size_thousands"),
        ((F.length("text") - F.length(F.translate("text", " ", ""))) / F.length("text")).alias("share_blank"),
        (F.col("lang") == "en").cast("double").alias("is_en"),
        F.regexp_extract("source", "([0-9]+)", 1).try_cast("double").alias("source_no"),
    )
    path = shared_dir(t.spark, "features")
    d.join(t.labels, ["doc_id"]).write.parquet(path)
    return t.spark.read.parquet(path)


def quality_model(t):
    df = labelled(t)
    scaler = ColumnScaler(FEATURES).fit(df)
    return L.fit_logreg(scaler.transform(df), FEATURES, "quality"), scaler.transform(df)


RAW = """raw as (select n_chars / 1000 as f1, (length(text) - length(replace(text, ' ', ''))) / length(text) as f2,
     (lang = 'en')::int::double as f3, try_cast(regexp_extract(source, '([0-9]+)', 1) as double) as f4, quality::double as y
   from documents join labels using (doc_id))"""


def descent_sql(rows: str, size: int, steps: int, bound: float | None = None, momentum: float = 0.95) -> str:
    """Accelerated gradient steps to the optimum of the penalised log loss; ``rows`` defines data (x, y).

    Each x begins with 1; ``walk`` then has the weights in ``w`` at ``step`` = ``steps``.  ``bound``
    is above the largest eigenvalue of the mean of x times itself.
    """
    ahead = f"(any_value(w)[i] + {momentum} * any_value(v)[i])"
    sums = ", ".join(f"sum(off * x[{i + 1}])" for i in range(size))
    pull = f"{momentum} * any_value(v)[i] - 4.0 / ({bound or size} * any_value(n) + 4) * ([{sums}][i] + case when i > 1 then {ahead} else 0 end)"
    zeros = "[" + ", ".join(["0.0::double"] * size) + "]"
    index = f"range(1, {size + 1})"
    return f"""with recursive {rows}, size as (select count(*) as n from data),
        walk as (select 0 as step, {zeros} as w, {zeros} as v union all
          select step + 1, list_transform({index}, lambda i: any_value(w)[i] + {pull}), list_transform({index}, lambda i: {pull})
          from (select step, w, v, n, x, 1 / (1 + exp(-list_inner_product(list_transform({index}, lambda i: w[i] + {momentum} * v[i]), x))) - y as off
                from walk, data, size where step < {steps}) group by step)"""


SCALED_RAW = RAW + """, stats as (select avg(f1) as m1, stddev_pop(f1) as s1, avg(f2) as m2, stddev_pop(f2) as s2,
     avg(f3) as m3, stddev_pop(f3) as s3, avg(f4) as m4, stddev_pop(f4) as s4 from raw),
   data as (select [1.0::double, (f1 - m1) / s1, (f2 - m2) / s2, (f3 - m3) / s3, (f4 - m4) / s4] as x, y
            from raw, stats where f1 + f2 + f3 + f4 is not null)"""


@query(
    "logistic_regression",
    descent_sql(SCALED_RAW, 5, 800)
    + """, terms as (select unnest(range(0, 5)) as position,
           unnest(['Intercept', 'size_thousands', 'share_blank', 'is_en', 'source_no']) as feature_name, unnest(w) as b
         from walk where step = 800)
       select position::int as position, feature_name, round(b, 6) as coefficient, round(exp(b), 6) as odds_ratio from terms""",
)
def _(t):
    model, _ = quality_model(t)
    return rounded(L.coef_table(t.spark, model), ["coefficient", "odds_ratio"], 6)


@query(
    "logistic_optimum",
    """select unnest(['Intercept', 'size_thousands', 'share_blank', 'is_en', 'source_no']) as feature, 0.0::double as gradient,
       count(*) as n_rows, sum(quality)::bigint as n_positive from documents join labels using (doc_id)""",
)
def _(t):
    """At the solution the gradient of summed loss plus half the squared coefficients is zero."""
    model, df = quality_model(t)
    off = model.positive_probability() - F.col("quality")
    n = F.count(F.lit(1))
    parts = [F.struct(F.lit("Intercept").alias("feature"), (F.sum(off) / n).alias("g"))]
    for f, w in zip(model.features, model.coefs[0]):
        parts.append(F.struct(F.lit(f).alias("feature"), ((F.sum(off * F.col(f)) + w) / n).alias("g")))
    read = [n.alias("n_rows"), F.sum("quality").alias("n_positive")]
    found = df.agg(F.array(*parts).alias("p"), *read).select("n_rows", "n_positive", F.inline("p"))
    # adding zero turns a rounded minus zero into zero
    return found.select("feature", (F.round("g", 3) + F.lit(0.0)).alias("gradient"), "n_rows", "n_positive")


@query(
    "predict_probability",
    descent_sql(
        RAW.replace("select n_chars", "select doc_id, n_chars")
        + SCALED_RAW.removeprefix(RAW).replace("as x, y", "as x, y, doc_id"),
        5,
        800,
    )
    + """, found as (select doc_id, y, 1 / (1 + exp(-list_inner_product(w, x))) as p from walk, data where step = 800)
       select doc_id, y::int as quality, round(p, 6) as probability, (p > 0.5)::int::double as prediction from found""",
)
def _(t):
    """Probability of the positive class, and the class, of each row."""
    model, df = quality_model(t)
    scored = model.transform(df).select("doc_id", F.col("quality").cast("int").alias("quality"), F.col("probability")[1].alias("probability"), "prediction")
    return rounded(scored.where("probability is not null"), ["probability"], 6)


@query(
    "probability_calibration",
    """select doc_id, quality, true as agrees, 0.0::double as calibration_gap from documents join labels using (doc_id)""",
)
def _(t):
    """Probability and class of each row agree; with a free intercept the mean probability is the share of ones."""
    model, df = quality_model(t)
    scored = model.transform(df).withColumn("p", F.col("probability")[1])
    gap = scored.agg(F.round(F.avg(F.col("p") - F.col("quality")), 3) + F.lit(0.0)).scalar()
    agrees = F.col("p").between(0, 1) & (F.col("prediction") == (F.col("p") > 0.5).cast("double"))
    return scored.select("doc_id", "quality", agrees.alias("agrees"), gap.alias("calibration_gap"))


@query(
    "accuracy",
    """select round(avg((p = quality)::int), 9) as accuracy, sum((p = quality)::int)::bigint as n_right,
              count(*) as n_rows
       from (select quality, (n_chars > 2000)::int as p from documents join labels using (doc_id))""",
)
def _(t):
    stored = t.documents.join(t.labels, ["doc_id"]).select(
        "quality", (F.col("n_chars") > 2000).cast("int").alias("p")
    )
    return rounded(L.accuracy(stored, "p", "quality"), ["accuracy"], 9)


def vectors(t):
    cols = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)]
    return t.embeddings.select("vec_id", "label", *cols)


@query(
    "multinomial_regression",
    f"""select label::double as class, count(*) filter (h < 3006477107) as n_train, count(*) filter (h >= 3006477107) as n_test,
              0.0::double as gradient
       from (select label, {HASHED.format(seed=42, key='vec_id', label='split')} as h from embeddings) group by 1""",
)
def _(t):
    """Per class the rows of both parts, and the largest gradient at the solution, which is zero."""
    df = vectors(t)
    features = [f"e{i}" for i in range(64)]
    train, test = split(df, 0.7, 42, "vec_id")
    model = L.fit_logreg(train, features, "label")
    scored = model.transform(train)
    lines = []
    for i, (c, weights) in enumerate(zip(model.classes, model.coefs)):
        off = F.col("probability")[i] - (F.col("label") == c).cast("double")
        slopes = [F.abs(F.sum(off * F.col(f)) + w) for f, w in zip(features, weights)]
        largest = F.greatest(F.abs(F.sum(off)), *slopes) / F.count(F.lit(1))
        lines.append(F.struct(F.lit(c).alias("class"), (F.round(largest, 2) + F.lit(0.0)).alias("gradient")))
    gradients = scored.agg(F.array(*lines).alias("g")).select(F.inline("g"))
    in_class = F.col("label").cast("double").alias("class")
    sizes = train.groupBy(in_class).agg(F.count(F.lit(1)).alias("n_train"))
    others = test.groupBy(in_class).agg(F.count(F.lit(1)).alias("n_test"))
    return sizes.join(others, "class").join(gradients, "class")


@query("multinomial_accuracy")
def _(t):
    train, test = split(vectors(t), 0.7, 42, "vec_id")
    model = L.fit_logreg(train, [f"e{i}" for i in range(64)], "label")
    return L.accuracy(model.transform(test), "prediction", "label")


@query("top_feature_per_class")
def _(t):
    model = L.fit_logreg(vectors(t), [f"e{i}" for i in range(64)], "label")
    return L.top_feature_per_class(t.spark, model)


@query(
    "auc_binary",
    """select sum(pos)::bigint as n_pos, sum(neg)::bigint as n_neg,
              round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) as auc
       from (select pos, neg, coalesce(sum(neg) over (order by n_chars rows between unbounded preceding and 1 preceding), 0) as below
             from (select n_chars, count(*) filter (quality = 1) as pos, count(*) filter (quality <> 1) as neg
                   from documents join labels using (doc_id) group by 1))""",
)
def _(t):
    df = t.documents.select("doc_id", "n_chars").join(t.labels, ["doc_id"])
    return rounded(U.auc(df, "n_chars", "quality"), ["auc"], 9)


# The score of class c is the sum of the vector's places c, c + 10, c + 20 and so on.
CLASS_SCORES = ", ".join(" + ".join(f"embedding[{i + 1}]::double" for i in range(c, 64, 10)) for c in range(10))


@query(
    "auc_one_vs_one",
    f"""with v as (select label as y, [{CLASS_SCORES}] as scores from embeddings),
       s as (select y, c, scores[c + 1] as v from v, range(10) r(c)),
       p as (select a.c, b.y as other, avg(case when a.v > b.v then 1.0 when a.v = b.v then 0.5 else 0 end) as auc
             from s a join s b on a.c = b.c and a.y = a.c and b.y <> b.c group by all)
       select round(avg(auc), 9) as auc from p""",
)
def _(t):
    place = [F.col("embedding")[i].cast("double") for i in range(64)]
    scores = F.array(*[reduce(add, place[c::10]) for c in range(10)])
    found = U.auc_ovo(t.embeddings.withColumn("scores", scores), "scores", "label", list(range(10)))
    return rounded(found, ["auc"], 9)


def kmeans_sql(table: str, ids: str, key: str, cols: list[str], ks: list[int], seed: int, steps: int, last: str) -> str:
    """The clustering in SQL: far-apart starts in a seeded sample, then a fixed number of Lloyd's steps.

    ``last`` reads scaled (ids, x) and centres (k, c, m), c numbering them in ascending order.
    """
    stats = ", ".join(f"avg({c}::double) as m{i}, stddev_pop({c}::double) as s{i}" for i, c in enumerate(cols))
    scaled = ", ".join(f"({c}::double - m{i}) / s{i}" for i, c in enumerate(cols))
    means = ", ".join(f"avg(x[{i + 1}])" for i in range(len(cols)))
    return f"""with recursive stats as (select {stats} from {table}),
        scaled as (select {ids}, [{scaled}] as x, {HASHED.format(seed=seed, key=key, label='kmeans')} as u, {key} as key,
                     row_number() over () as id from {table}, stats),
        sample as (select x, row_number() over (order by u, key, x) as i from scaled qualify i <= 512),
        chain as (select 1 as n, [x] as chosen from sample where i = 1 union all
          select n + 1, list_append(any_value(chosen), arg_max(x, list_min(list_transform(chosen, lambda z: list_distance(z, x)))))
          from chain, sample where n < {max(ks)} group by n),
        lloyd as (select 0 as step, k, c, chosen[c] as m from chain, (select unnest({ks}) as k), range(1, {max(ks) + 1}) r(c)
                  where n = {max(ks)} and c <= k union all
          select step + 1, k, c, [{means}] from (
            select step, k, id, any_value(x) as x, arg_min(c, list_distance(m, x)) as c from lloyd, scaled where step < {steps} group by 1, 2, 3)
          group by step, k, c),
        centres as (select k, row_number() over (partition by k order by m) - 1 as c, m from lloyd where step = {steps}),
        near as (select k, id, arg_min(c, list_distance(m, x))::int as c, pow(min(list_distance(m, x)), 2) as gap
                 from scaled, centres group by 1, 2) {last}"""


LINE = "l_orderkey, l_linenumber, l_partkey"


@query(
    "kmeans",
    kmeans_sql(
        "lineitem", LINE, "l_orderkey", ["l_quantity", "l_extendedprice"], [3], 1, 12,
        f"select {LINE}, c as cluster_pred from near join scaled using (id)",
    ),
)
def _(t):
    """Every row with its cluster after twelve steps."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    found = K.kmeans(lines, ["l_quantity", "l_extendedprice"], 3, seed=1, key="l_orderkey", max_iter=12, settled=0.0)
    return found.drop("l_quantity", "l_extendedprice")


@query(
    "kmeans_settled",
    """select unnest([0, 1, 2])::int as cluster_pred, count(*) as n_rows, sum(l_orderkey)::bigint as key_sum, true as settled
       from lineitem""",
)
def _(t):
    """Per cluster: all rows and their key sum (over the clusters), and whether the clustering has settled.

    It has if nearly all rows of the cluster lie nearest to the mean of their own cluster.
    """
    cols = ["l_quantity", "l_extendedprice"]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *cols)
    found = K.kmeans(lines, cols, 3, seed=1, key="l_orderkey")
    scaled = ColumnScaler(cols).fit(found).transform(found)
    means = scaled.groupBy("cluster_pred").agg(*[F.avg(c) for c in cols]).orderBy("cluster_pred").collect()
    nearest = K.nearest(cols, [tuple(m)[1:] for m in means])
    sums = scaled.groupBy("cluster_pred").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("k"),
        F.count_if(nearest != F.col("cluster_pred")).alias("astray"),
    )
    every = Window.partitionBy()
    return sums.select(
        "cluster_pred",
        F.sum("n").over(every).alias("n_rows"),
        F.sum("k").over(every).alias("key_sum"),
        (F.col("astray") * 100 <= F.col("n")).alias("settled"),
    )


@query(
    "kmeans_elbow",
    kmeans_sql(
        "embeddings", "vec_id", "vec_id", [f"embedding[{i + 1}]" for i in range(64)], list(range(1, 10)), 1, 10,
        "select k::int as k, round(sum(gap), 4) as wcss from near group by k",
    ),
)
def _(t):
    """Cost of one to nine clusters after ten steps, all in the same reads."""
    found = K.elbow(vectors(t), [f"e{i}" for i in range(64)], seed=1, key="vec_id", max_iter=10, settled=0.0)
    return rounded(found, ["wcss"], 4)


@query(
    "kmeans_saved",
    kmeans_sql(
        "part", "p_partkey, p_size, p_retailprice", "p_partkey", ["p_size", "p_retailprice"], [2, 3, 6], 5, 10,
        "select p_partkey, p_size, p_retailprice, max(c) filter (k = 2) as cluster_2, max(c) filter (k = 3) as cluster_3, "
        "max(c) filter (k = 6) as cluster_6 from near join scaled using (id) group by 1, 2, 3",
    ),
)
def _(t):
    """Two, three and six clusters next to the original columns, saved and read back."""
    some = t.part.select("p_partkey", "p_size", "p_retailprice")
    found = K.kmeans_many(some, ["p_size", "p_retailprice"], [2, 3, 6], seed=5, key="p_partkey", max_iter=10, settled=0.0)
    path = shared_dir(t.spark, "clusters")
    found.write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "single_cluster_cost",
    """select 1 as k, round(count(*) * 2.0, 3)::double as wcss from lineitem""",
)
def _(t):
    """Scaled columns have variance one, so two of them cost two per row."""
    found = K.single_cluster_cost(t.lineitem, ["l_quantity", "l_extendedprice"])
    return rounded(found, ["wcss"], 3)


def fixed_model():
    scaler = ColumnScaler(["o_totalprice", "month"])
    scaler.stats = {"o_totalprice": (250000.0, 140000.0), "month": (6.5, 3.5)}
    return ScoringModel(
        scaler, L.LogisticModel(["urgent", "o_totalprice", "month"], [0.0, 1.0], [-0.2], [[1.1, 0.7, -0.3]])
    )


def order_features(t):
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
        "o_totalprice",
        F.month("o_orderdate").alias("month"),
    )


SCORED = """(select *, 1 / (1 + exp(-(-0.2 + 1.1 * urgent + 0.7 * (o_totalprice - 250000) / 140000
                                    - 0.3 * (month - 6.5) / 3.5))) as p
   from (select o_orderkey, (o_orderpriority = '1-URGENT')::int as urgent, o_totalprice,
                month(o_orderdate)::int as month from orders))"""


@query(
    "score_saved_model",
    f"""select o_orderkey, urgent, o_totalprice, month, round(p, 9) as Probability,
               (p > 0.5)::int as Prediction from {SCORED}""",
)
def _(t):
    """Save, load and apply a scaler and model with known coefficients."""
    path = shared_dir(t.spark, "model")
    fixed_model().save(t.spark, path)
    scored = ScoringModel.load(t.spark, path).score(order_features(t))
    return rounded(scored, ["Probability"], 9)


@query(
    "prediction_report",
    f"""select month, round(avg(p), 9) as mean_probability, max(urgent) as max_urgent, count(*) as n_rows
        from {SCORED} where month not in (2, 12) group by 1""",
)
def _(t):
    scored = fixed_model().score(order_features(t))
    return rounded(prediction_report(scored, "month", "urgent", [2, 12]), ["mean_probability"], 9)


@query(
    "cluster_assignment",
    """select l_orderkey, l_linenumber, l_partkey,
         case when a <= b and a <= c then 0 when b <= c then 1 else 2 end as cluster_pred
       from (select *, pow(x + 1, 2) + pow(y + 0.5, 2) as a, pow(x, 2) + pow(y - 1, 2) as b,
                    pow(x - 1, 2) + pow(y + 0.25, 2) as c
             from (select l_orderkey, l_linenumber, l_partkey, (l_quantity - 25) / 14 as x, l_discount * 20 - 1 as y
                   from lineitem))""",
)
def _(t):
    """Rows to the nearest of given centres."""
    points = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        ((F.col("l_quantity") - 25) / 14).alias("x"),
        (F.col("l_discount") * 20 - 1).alias("y"),
    )
    number = K.nearest(["x", "y"], [(-1, -0.5), (0, 1), (1, -0.25)])
    return points.withColumn("cluster_pred", number).drop("x", "y")


# A three-class model over all 64 places with known coefficients.
KNOWN = [[((7 * i + 3 * k) % 9 - 4) / 4 for i in range(64)] for k in range(3)]
KNOWN_EXP = ", ".join(
    f"exp({b} + " + " + ".join(f"({w}) * embedding[{i + 1}]::double" for i, w in enumerate(row)) + ")"
    for b, row in zip((0.1, -0.2, 0.0), KNOWN)
)


@query(
    "softmax_prediction",
    f"""select vec_id, round(list_max(e) / list_sum(e), 6) as top_probability,
              (list_position(e, list_max(e)) * 10)::double as prediction
       from (select vec_id, [{KNOWN_EXP}] as e from embeddings)""",
)
def _(t):
    """A three-class model with known coefficients."""
    df = vectors(t)
    model = L.LogisticModel([f"e{i}" for i in range(64)], [10.0, 20.0, 30.0], [0.1, -0.2, 0.0], KNOWN)
    return model.transform(df).select(
        "vec_id", F.round(F.array_max("probability"), 6).alias("top_probability"), "prediction"
    )
