"""Absence records: features, training, scoring and report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date, weekday
from ..learn.scoring import ScoringModel, prediction_report, train
from ..operators.bins import above_median
from ..operators.recode import range_flags, recode

# fixed values: groups of reason codes; code 0 belongs to none
REASONS = {"Reason_1": (1, 14), "Reason_2": (15, 17), "Reason_3": (18, 21), "Reason_4": (22, None)}
# fixed values: column order of the prepared table
FEATURES = [
    "Reason_1", "Reason_2", "Reason_3", "Reason_4", "Month_value", "Day of the Week",
    "Transportation Expense", "Distance to Work", "Age", "Daily Work Load Average",
    "Body Mass Index", "Education", "Children", "Pets",
]
HOURS = "Absenteeism Time in Hours"
# fixed values: columns left out of the model and columns left unscaled
UNUSED = ["Day of the Week", "Distance to Work", "Daily Work Load Average"]
UNSCALED = ["Reason_1", "Reason_2", "Reason_3", "Education"]
MODEL_FEATURES = [f for f in FEATURES if f not in UNUSED]


def absence_features(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Raw records to features: a single projection, no shuffle.

    ``keep`` names extra columns (a key) to carry along; the hours stay if they are there.
    """
    day = parse_date("Date", "dd/MM/yyyy")
    dated = raw.withColumns({"Month_value": F.month(day), "Day of the Week": weekday(day)})
    flagged = range_flags(dated, "Reason for Absence", REASONS)
    graded = recode(flagged, "Education", {1: 0, 2: 1, 3: 1, 4: 1}, unmapped="null")
    hours = [HOURS] if HOURS in raw.columns else []
    return graded.select(*keep, *FEATURES, *hours)


def train_absence(features: DataFrame) -> ScoringModel:
    """Model of hours above the median."""
    target = above_median(features, HOURS, out="Excessive Absenteeism")
    scaled = [f for f in MODEL_FEATURES if f not in UNSCALED]
    return train(target, MODEL_FEATURES, "Excessive Absenteeism", scaled)


def score_absence(raw: DataFrame, model: ScoringModel, keep: Sequence[str] = ()) -> DataFrame:
    prepared = absence_features(raw, keep).select(*keep, *MODEL_FEATURES).fillna(0, subset=MODEL_FEATURES)
    return model.score(prepared)


def absence_report(scored: DataFrame, flags: str | Sequence[str] = "Reason_1", excluded: Sequence = ()) -> DataFrame:
    return prediction_report(scored, "Age", flags, excluded)
