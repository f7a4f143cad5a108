"""Codes and scores to labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import rules
from tidepost.functions.binding import bind


def target_label(target: Column) -> Column:
    out = F
    for code, label in rules.TARGET_LABELS.items():
        out = out.when(target == code, F.lit(label))
    return out.otherwise(F.lit("Neutral"))


def target_score(target: Column) -> Column:
    out = F
    for code, score in rules.TARGET_SCORES.items():
        out = out.when(target == code, F.lit(score))
    return out.otherwise(F.lit(0.0))


def classify(
    score: Column,
    inclusive: bool = False,
    positive: float = rules.POSITIVE_ABOVE,
    negative: float = rules.NEGATIVE_BELOW,
) -> Column:
    """Three-way label; null is Neutral. ``inclusive`` lets the thresholds themselves count."""

    def decide(s: Column) -> Column:
        up = s >= positive if inclusive else s > positive
        down = s <= negative if inclusive else s < negative
        return F.when(up, F.lit("Positive")).when(down, F.lit("Negative")).otherwise(F.lit("Neutral"))

    return bind(score, decide)


def floor_percent(part: Column, total: Column) -> Column:
    """Whole percent, rounded down; 0 where there is nothing to count."""
    return F.floor(F.lit(100) * part / F.greatest(total, F.lit(1)))


def model_score(probability: Column, label: Column) -> Column:
    """A classifier's probability as a score: up to 0.8 either way, neutral is 0."""
    return (
        F.when(F.lower(label) == "positive", probability * rules.ALERT_LEVEL)
        .when(F.lower(label) == "negative", -probability * rules.ALERT_LEVEL)
        .otherwise(F.lit(0.0))
    )
