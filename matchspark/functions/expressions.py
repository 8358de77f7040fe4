"""Column expressions. Everything here is a built-in expression and stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class codes 0, 1, 2 in this order.
CLASS_NAMES = ("HOME_WINS", "DRAW", "AWAY_WINS")
HOME, DRAW, AWAY = 0, 1, 2


def _any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def any_null(*columns: Column) -> Column:
    return _any_of([c.isNull() for c in columns])


# -- classes and one-hot ------------------------------------------------------------


def class_from_one_hot(home: Column, draw: Column, away: Column, unlabelled: str = "null") -> Column:
    """Index of the largest of the three, the first one on ties.

    A row with a missing value has no class. ``unlabelled='home'`` instead gives the position
    of its first missing value, which is HOME for a row without any label.
    """
    if unlabelled not in ("null", "home"):
        raise ValueError("unlabelled must be 'null' or 'home'")
    best = F.greatest(home, draw, away)
    if unlabelled == "null":
        missing = F.when(any_null(home, draw, away), F.lit(None).cast("int"))
    else:
        missing = F.when(home.isNull(), HOME).when(draw.isNull(), DRAW).when(away.isNull(), AWAY)
    return missing.when(home == best, HOME).when(draw == best, DRAW).otherwise(AWAY)


def top_class(p_home: Column, p_draw: Column, p_away: Column) -> Column:
    """Predicted class of three probabilities, the first maximum wins."""
    return class_from_one_hot(p_home, p_draw, p_away)


def one_hot(predicted: Column, code: int) -> Column:
    return (predicted == F.lit(code)).cast("byte")


# -- margins and weights ------------------------------------------------------------


def win_margin(home_wins: Column, away_wins: Column, goal_difference: Column) -> Column:
    """Goals by which the winner won; 0 for a draw, an unknown difference or a wrong sign."""
    gd = F.coalesce(goal_difference.cast("double"), F.lit(0.0))
    return (
        F.when(home_wins == 1, F.greatest(gd, F.lit(0.0)))
        .when(away_wins == 1, F.greatest(-gd, F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def margin_weight(
    margin: Column,
    scheme: str,
    beta: float = 0.25,
    alpha: float = 0.2,
    base: float = 1.0,
    cap: float | None = None,
) -> Column:
    """Row weight from the win margin; ``beta`` acts on 'linear' only, ``alpha`` on 'exp' only."""
    if scheme == "none":
        weight = F.lit(1.0)
    elif scheme == "linear":
        weight = F.lit(float(base)) + F.lit(float(beta)) * margin
    elif scheme == "exp":
        weight = F.lit(float(base)) + F.expm1(F.lit(float(alpha)) * margin)
    else:
        raise ValueError(f"unknown weighting scheme {scheme!r}: use 'none', 'linear' or 'exp'")
    return weight if cap is None else F.least(weight, F.lit(float(cap)))


# -- probabilities ------------------------------------------------------------------


def scale_draw(p_home: Column, p_draw: Column, p_away: Column, alpha: float) -> tuple[Column, Column, Column]:
    """Multiply the draw probability by ``alpha`` and renormalise; unchanged at 1."""
    if alpha == 1.0:
        return p_home, p_draw, p_away
    scaled = p_draw * F.lit(float(alpha))
    total = p_home + scaled + p_away
    return F.try_divide(p_home, total), F.try_divide(scaled, total), F.try_divide(p_away, total)
