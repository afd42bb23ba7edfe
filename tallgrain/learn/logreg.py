"""Logistic regression: fitted by Newton's steps or by Spark ML, applied as plain column expressions.

Two classes are fitted by Newton's method: a step is one aggregation, in which each task adds up the
weighted products of all pairs of features, and a small system solved on the driver.  It ends at the
optimum to the last digits, so a fit can be compared with any other way to get there.  More classes
or many features go to Spark ML, whose steps send only a gradient.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import present
from ..session import stored


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class LogisticModel:
    """Coefficients per class; a binary model has one line, for the larger class."""

    features: list[str]
    classes: list[float]
    intercepts: list[float]
    coefs: list[list[float]]

    @property
    def binary(self) -> bool:
        return len(self.coefs) == 1

    def _margins(self) -> list[Column]:
        out = []
        for b, line in zip(self.intercepts, self.coefs):
            # one parsed text per class: hundreds of separate Column calls would be slow
            terms = [f"({float(w)!r}D) * {quoted(f)}" for w, f in zip(line, self.features)]
            out.append(F.expr(" + ".join([f"({float(b)!r}D)", *terms])))
        return out

    def probabilities(self) -> Column:
        """Array of class probabilities in the order of ``classes``."""
        margins = self._margins()
        if self.binary:
            p = 1 / (1 + F.exp(-margins[0]))
            return F.array(1 - p, p)
        scores = F.array(*margins)
        shifted = F.transform(scores, lambda m: F.exp(m - F.array_max(scores)))
        total = F.aggregate(shifted, F.lit(0.0), lambda a, e: a + e)
        return F.transform(shifted, lambda e: e / total)

    def transform(
        self, df: DataFrame, probability: str = "probability", prediction: str = "prediction"
    ) -> DataFrame:
        """Add the array of probabilities and the likeliest class (the first one on a tie)."""
        out = df.withColumn(probability, self.probabilities())
        best = F.array_position(F.col(probability), F.array_max(probability))
        names = F.array(*[F.lit(c) for c in self.classes])
        return out.withColumn(prediction, F.element_at(names, best.cast("int")))

    def positive_probability(self) -> Column:
        return self.probabilities()[1]

    def to_table(self, spark: SparkSession) -> DataFrame:
        lines = self.classes[1:] if self.binary else self.classes
        rows = []
        for i, (c, b, ws) in enumerate(zip(lines, self.intercepts, self.coefs)):
            rows.append((i, float(c), -1, "Intercept", float(b)))
            rows += [(i, float(c), j, f, float(w)) for j, (f, w) in enumerate(zip(self.features, ws))]
        if self.binary:
            rows.append((-1, float(self.classes[0]), -1, "Intercept", 0.0))
        return spark.createDataFrame(rows, "line int, class double, position int, feature string, coef double")

    @classmethod
    def from_table(cls, table: DataFrame) -> LogisticModel:
        """Back from the saved table: one row per class and feature."""
        rows = sorted(table.collect(), key=lambda r: (r["line"], r["position"]))
        base = [r["class"] for r in rows if r["line"] < 0]
        real = [r for r in rows if r["line"] >= 0]
        lines = sorted({r["line"] for r in real})
        by_line = {i: [r for r in real if r["line"] == i] for i in lines}
        return cls(
            [r["feature"] for r in by_line[0] if r["position"] >= 0],
            base + [by_line[i][0]["class"] for i in lines],
            [by_line[i][0]["coef"] for i in lines],
            [[r["coef"] for r in by_line[i] if r["position"] >= 0] for i in lines],
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LogisticModel:
        return cls.from_table(spark.read.parquet(path))


#: Features up to which two classes are fitted by Newton's method; a task sends their square on.
NEWTON_FEATURES = 200


def _normal_sums(points: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, curvature) of the summed log loss at ``beta``, the intercept first."""
    size = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, slope, bend = 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size - 1)
            x = np.column_stack([np.ones(len(x)), x])
            y = batch.column(1).to_numpy(zero_copy_only=False)
            margin = x @ beta
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            loss += float((np.logaddexp(0, margin) - y * margin).sum())
            slope += x.T @ (p - y)
            bend += (x * (p * (1 - p))[:, None]).T @ x
        value = np.concatenate([[loss], slope, bend.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], ["place", "value"])

    added = points.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(1 + size + size * size)
    for place, value in added.collect():
        total[place] = value
    return float(total[0]), total[1 : 1 + size], total[1 + size :].reshape(size, size)


def newton(points: DataFrame, n_features: int, c: float, max_iter: int = 100) -> np.ndarray:
    """Intercept and coefficients at the optimum; ``points`` has ``x`` (array) and ``y`` (0 or 1).

    A step that raises the loss is halved.  A curvature without an inverse (features that depend on
    each other) is met by the least of all steps that fit.
    """
    penalty = np.append(0.0, np.full(n_features, 1.0 / c))
    beta, best, step = np.zeros(n_features + 1), math.inf, np.zeros(n_features + 1)
    for _ in range(max_iter):
        loss, slope, bend = _normal_sums(points, beta + step)
        loss += float(penalty @ (beta + step) ** 2) / 2
        if loss > best * (1 + 1e-12) + 1e-12:
            step = step / 2
            if np.abs(step).max() < 1e-12:
                break
            continue
        beta, best = beta + step, loss
        step = -np.linalg.lstsq(bend + np.diag(penalty), slope + penalty * beta, rcond=None)[0]
        if np.abs(step).max() <= 1e-10 * (1 + np.abs(beta).max()):
            beta = beta + step
            break
    return beta


def fit_logreg(
    df: DataFrame, features: Sequence[str], label: str, c: float = 1.0, max_iter: int = 100, max_classes: int = 1000
) -> LogisticModel:
    """Ridge-penalised logistic regression with a free intercept.

    The penalty is stated the usual way: ``c`` weighs the summed loss against half the
    squared coefficients.  Spark averages the loss over n rows, hence ``1 / (c n)``.
    Labels are numbers; two of them give a binary model, more a multinomial one.  More than
    ``max_classes`` of them is an error.
    """
    clean = present(df, [label, *features])
    counted = clean.groupBy(F.col(label).cast("double").alias("y")).count()
    stats = counted.limit(max_classes + 1).collect()
    if len(stats) > max_classes:
        raise ValueError(f"the label has more than {max_classes} classes")
    classes = sorted(r["y"] for r in stats)
    n = sum(r["count"] for r in stats)
    if len(classes) < 2:
        raise ValueError("the label needs at least two classes")
    index = F.array_position(F.array(*[F.lit(v) for v in classes]), F.col(label).cast("double")) - 1
    if len(classes) == 2 and len(features) <= NEWTON_FEATURES:
        x = F.array(*[F.col(f).cast("double") for f in features])
        points = stored(clean.select(x.alias("x"), index.cast("double").alias("y")), "logreg-input")
        beta = newton(points, len(features), c, max_iter).tolist()
        return LogisticModel(list(features), classes, beta[:1], [beta[1:]])
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x").transform(
        clean.select(*features, index.cast("double").alias("_y"))
    )
    fitted = LogisticRegression(
        featuresCol="_x",
        labelCol="_y",
        family="binomial" if len(classes) == 2 else "multinomial",
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-9,
    ).fit(stored(assembled.select("_x", "_y"), "logreg-input"))
    coefs = fitted.coefficientMatrix.toArray().tolist()
    return LogisticModel(list(features), classes, list(fitted.interceptVector.toArray()), coefs)


def accuracy(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """Share, number of hits and rows, from one pass."""
    hit = (F.col(prediction) == F.col(label)).cast("int")
    return df.agg(
        F.avg(hit).alias("accuracy"), F.sum(hit).alias("n_right"), F.count(hit).alias("n_rows")
    )


def coef_table(spark: SparkSession, model: LogisticModel) -> DataFrame:
    """Intercept and features of a binary model with their odds ratios, largest ratio first."""
    rows = [(0, "Intercept", float(model.intercepts[0]))]
    rows += [(i, f, float(w)) for i, (f, w) in enumerate(zip(model.features, model.coefs[0]), 1)]
    table = spark.createDataFrame(rows, "position int, feature_name string, coefficient double")
    return table.withColumn("odds_ratio", F.exp("coefficient")).orderBy(
        F.col("odds_ratio").desc(), "position"
    )


def top_feature_per_class(spark: SparkSession, model: LogisticModel) -> DataFrame:
    """Per class the feature with the largest absolute coefficient."""
    lines = model.classes[1:] if model.binary else model.classes
    rows = []
    for c, ws in zip(lines, model.coefs):
        best = max(range(len(ws)), key=lambda i: (abs(ws[i]), -i))
        rows.append((float(c), model.features[best], math.fabs(ws[best])))
    return spark.createDataFrame(rows, "class double, feature string, strength double")
