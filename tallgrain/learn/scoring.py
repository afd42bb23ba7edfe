"""A saved scaler and model, applied to batches in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .logreg import LogisticModel, fit_logreg
from .scaler import ColumnScaler


@dataclass
class ScoringModel:
    scaler: ColumnScaler
    model: LogisticModel

    def score(
        self, df: DataFrame, probability: str = "Probability", prediction: str = "Prediction"
    ) -> DataFrame:
        """The unscaled input rows with probability and class of the positive outcome.

        Scaling is folded into the coefficients, so that the rows themselves stay unscaled
        and scoring is one expression.
        """
        weights, shift = [], 0.0
        for f, w in zip(self.model.features, self.model.coefs[0]):
            mean, sd = (self.scaler.stats or {}).get(f, (0.0, 1.0))
            weights.append(w / (sd or 1.0))
            shift += w * mean / (sd or 1.0)
        raw = LogisticModel(
            self.model.features, self.model.classes, [self.model.intercepts[0] - shift], [weights]
        )
        p = raw.positive_probability()
        low, high = (F.lit(c) for c in self.model.classes)
        return df.withColumn(probability, p).withColumn(
            prediction, F.when(F.col(probability) > 0.5, high).otherwise(low).cast("int")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.scaler.to_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
        self.model.save(spark, f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ScoringModel:
        scaler = ColumnScaler.from_table(spark.read.parquet(f"{path}/scaler"))
        return cls(scaler, LogisticModel.load(spark, f"{path}/model"))


def train(
    df: DataFrame, features: Sequence[str], label: str, scale: Sequence[str], c: float = 1.0
) -> ScoringModel:
    scaler = ColumnScaler(list(scale)).fit(df)
    return ScoringModel(scaler, fit_logreg(scaler.transform(df), features, label, c))


def prediction_report(
    scored: DataFrame, by: str, flag: str | Sequence[str], excluded: Sequence = (), probability: str = "Probability"
) -> DataFrame:
    """Mean probability by a feature and largest value of one or more flags, some members left out."""
    flags = [flag] if isinstance(flag, str) else list(flag)
    kept = scored
    if excluded:
        kept = scored.filter(~F.col(by).isin(*excluded) | F.col(by).isNull())
    return kept.groupBy(by).agg(
        F.avg(probability).alias("mean_probability"),
        *[F.max(f).alias(f"max_{f}") for f in flags],
        F.count(F.lit(1)).alias("n_rows"),
    )
