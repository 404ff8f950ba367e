"""Fraud rules on one transaction; the same columns serve batch and stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FraudLimits:
    """Amounts at which the rules start to hold."""

    abroad: float = -300
    night: float = -200
    discretionary: float = 500


# Points and reason of each rule, in rule order.
RULES = {
    "abroad": (85, "Large international transaction"),
    "night": (70, "Unusual hour transaction (late night)"),
    "discretionary": (60, "Large discretionary spending"),
}
FLAGGED_POINTS, FLAGGED_REASON = 100, "Pre-flagged as fraudulent"
BASE_POINTS = 10

# Score above which a level applies, highest first.
ALERT_LEVELS = {"HIGH_RISK": 50, "MEDIUM_RISK": 30}
LOWEST_LEVEL = "LOW_RISK"


def _holds(limits: FraudLimits) -> dict[str, Column]:
    """Condition of each rule on the columns of a transaction."""
    spent, hour = F.col("amount"), F.hour(F.try_to_timestamp("timestamp"))
    return {
        "abroad": (F.col("location") == "INTERNATIONAL") & (spent < limits.abroad),
        "night": (hour < 6) & (spent < limits.night),
        "discretionary": F.col("category").isin("Food", "Entertainment")
        & (F.abs(spent) > limits.discretionary),
    }


def first_match_score(limits: FraudLimits = FraudLimits()) -> Column:
    """Points of the first rule that holds, a flag before all; a NULL flag counts
    as not flagged."""
    score = F.when(F.col("is_fraudulent"), FLAGGED_POINTS)
    for rule, condition in _holds(limits).items():
        score = score.when(condition, RULES[rule][0])
    return score.otherwise(BASE_POINTS)


def alert_level(score: Column) -> Column:
    levels = F
    for level, limit in ALERT_LEVELS.items():
        levels = levels.when(score > limit, level)
    return levels.otherwise(LOWEST_LEVEL)


def additive_score(limits: FraudLimits = FraudLimits()) -> Column:
    """Points of all rules that hold; a flag replaces the sum."""
    points = [F.when(condition, RULES[rule][0]).otherwise(0)
              for rule, condition in _holds(limits).items()]
    return F.when(F.col("is_fraudulent"), FLAGGED_POINTS).otherwise(sum(points, F.lit(0)))


def reasons(limits: FraudLimits = FraudLimits()) -> Column:
    """Texts of all rules that hold, in rule order, the flag last."""
    texts = [F.when(condition, RULES[rule][1]) for rule, condition in _holds(limits).items()]
    return F.array_compact(F.array(*texts, F.when(F.col("is_fraudulent"), FLAGGED_REASON)))
