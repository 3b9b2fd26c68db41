"""Category labels and step scores, as tables of limits turned into `when` chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseframe.functions.compat import stable

# Fixed values: (limit, label) from best to worst, then the label of everything
# else; a null value falls into the last label.
MOMENTUM_ABOVE = (
    (2.0, "Accelerating"),
    (0.5, "Improving"),
    (-0.5, "Stable"),
    (-2.0, "Declining"),
)
MOMENTUM_ELSE = "Deteriorating"
VOLATILITY_BELOW = (
    (5.0, "Very Stable"),
    (10.0, "Stable"),
    (15.0, "Moderate"),
    (20.0, "Volatile"),
)
VOLATILITY_ELSE = "Very Volatile"
BALANCE_FROM = (
    (80.0, "Excellent Balance"),
    (60.0, "Good Balance"),
    (40.0, "Moderate Balance"),
    (20.0, "Poor Balance"),
)
BALANCE_ELSE = "Very Poor Balance"
EFFICIENCY_ABOVE = (
    (1.0, "Highly Efficient"),
    (0.5, "Efficient"),
    (0.0, "Moderate"),
    (-0.5, "Poor"),
)
EFFICIENCY_ELSE = "Very Poor"
ADAPTATION_ABOVE = (
    (10.0, "Thriving"),
    (5.0, "Well Adapted"),
    (-5.0, "Normal Adaptation"),
    (-10.0, "Struggling"),
)
ADAPTATION_ELSE = "Poorly Adapted"
SUSTAINABILITY_ABOVE = (
    (0.7, "Highly Sustainable"),
    (0.5, "Sustainable"),
    (0.3, "Moderately Sustainable"),
)
SUSTAINABILITY_ELSE = "Unsustainable"
TRAINING_STEP_ABOVE = ((15.0, 90), (12.0, 70), (9.0, 50), (6.0, 30))
TRAINING_STEP_ELSE = 10
RISK_GAP_BELOW = -30.0
RISK_STRAIN_ABOVE = 14.0
SCORE_STATE_TEXT = {
    "SCORED": "{} data fully processed",
    "PENDING": "{} data being processed",
    "UNSCORABLE": "Unable to score {} data",
}
SCORE_STATE_ELSE = "Unknown state"


def _steps(c: Column, table: Sequence[tuple[float, object]], otherwise: object, test) -> Column:
    value, out = stable(c), None
    for limit, label in table:
        hit = test(value, limit)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def _above(c: Column, table, otherwise) -> Column:
    return _steps(c, table, otherwise, lambda v, limit: v > limit)


def momentum(raw: Column) -> Column:
    return _above(raw, MOMENTUM_ABOVE, MOMENTUM_ELSE)


def volatility(stddev: Column) -> Column:
    return _steps(stddev, VOLATILITY_BELOW, VOLATILITY_ELSE, lambda v, limit: v < limit)


def balance(score: Column) -> Column:
    return _steps(score, BALANCE_FROM, BALANCE_ELSE, lambda v, limit: v >= limit)


def efficiency(ratio: Column) -> Column:
    return _above(ratio, EFFICIENCY_ABOVE, EFFICIENCY_ELSE)


def adaptation(deviation: Column) -> Column:
    return _above(deviation, ADAPTATION_ABOVE, ADAPTATION_ELSE)


def sustainability(optimal_share: Column) -> Column:
    return _above(optimal_share, SUSTAINABILITY_ABOVE, SUSTAINABILITY_ELSE)


def training_step(target: Column) -> Column:
    """Recommended training load 10..90 for a strain target; null gives 10."""
    return _above(target, TRAINING_STEP_ABOVE, TRAINING_STEP_ELSE)


def strain_zone(strain: Column, low: Column, high: Column) -> Column:
    """Under / Optimal / Over; null where a needed limit is null."""
    return (
        F.when(strain < low, "Under")
        .when((strain >= low) & (strain <= high), "Optimal")
        .when(strain > high, "Over")
    )


def strain_distance(strain: Column, low: Column, high: Column) -> Column:
    """Distance to the optimal range, 0 inside it."""
    return (
        F.when(strain < low, low - strain)
        .when(strain > high, strain - high)
        .otherwise(F.lit(0.0))
    )


def readiness_gap(gap: Column) -> Column:
    """Five labels around zero; the tests are read in this order."""
    gap = stable(gap)
    return (
        F.when(gap > 20, "Body Ready, Training Light")
        .when(gap > 10, "Slight Over-recovery")
        .when((gap >= -10) & (gap <= 10), "Well Aligned")
        .when(gap < -20, "Body Tired, Training High")
        .otherwise("Slight Under-recovery")
    )


def overtraining_risk(gap: Column, recent_strain: Column) -> Column:
    hit = (stable(gap) < RISK_GAP_BELOW) & (stable(recent_strain) > RISK_STRAIN_ABOVE)
    return F.coalesce(hit, F.lit(False))


def gap_color(gap: Column) -> Column:
    """Traffic light of a readiness gap; null is green."""
    return F.when(gap < -20, "red").when(gap < 0, "orange").otherwise("green")


def sign_color(value: Column) -> Column:
    return F.when(value > 0, "green").otherwise("red")


def bubble_size(value: Column) -> Column:
    """Absolute value, 1 where there is none."""
    return F.coalesce(F.abs(value), F.lit(1.0))


def score_state_text(state: Column, subject: str) -> Column:
    """Description of a score state for e.g. ``Sleep`` or ``Cycle``."""
    out = None
    for name, text in SCORE_STATE_TEXT.items():
        subject_text = subject if text.startswith("{}") else subject.lower()
        value = F.lit(text.format(subject_text))
        out = F.when(state == name, value) if out is None else out.when(state == name, value)
    return out.otherwise(SCORE_STATE_ELSE)
