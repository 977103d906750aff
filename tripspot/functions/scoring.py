"""Score expressions."""

from pyspark.sql import Column, functions as F

from tripspot.functions.fixed import ALERT, LEVEL_BOUNDS, LEVEL_LABELS, NORMAL


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def relative_score(trips, busiest) -> Column:
    """Percentage of the busiest zone of the same bucket, two decimals."""
    return F.round(_col(trips) / F.greatest(_col(busiest), F.lit(1.0)) * F.lit(100.0), 2)


def clamp_score(score, low=0.0, high=100.0) -> Column:
    """Keep a score inside [low, high]; NULL becomes low."""
    return F.least(F.greatest(_col(score).cast("double"), F.lit(low)), F.lit(high))


def score_level(score, lang="vi") -> Column:
    """Level label of a score; NULL counts as 0."""
    labels = LEVEL_LABELS[lang]
    value = F.coalesce(_col(score).cast("double"), F.lit(0.0))
    hottest, *rest = [(labels[name], bound) for name, bound in LEVEL_BOUNDS if bound is not None]
    level = F.when(value >= hottest[1], hottest[0])
    for label, bound in rest:
        level = level.when(value >= bound, label)
    return level.otherwise(labels["low"])


def alert_flag(score, threshold) -> Column:
    """Strict comparison on the unrounded score."""
    return F.when(_col(score) > _col(threshold), ALERT).otherwise(NORMAL)
