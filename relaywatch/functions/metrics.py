"""Column expressions for rates, scores and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaywatch.schema import (BREACH_CANCEL_PCT, BREACH_DELAY_PCT,
                               BREACH_MIN_ORDERS, BREACH_PREP_MIN,
                               SCORE_CANCEL_WEIGHT, SCORE_DELAY_WEIGHT)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct(n, d, if_zero: float = 0.0) -> Column:
    """``n * 100 / d`` as DOUBLE, ``if_zero`` when ``d`` is not positive."""
    n, d = _c(n), _c(d)
    return F.when(d > 0, n.cast("double") * 100.0 / d).otherwise(F.lit(float(if_zero)))


def ratio(n, d, if_zero: float = 0.0) -> Column:
    """``n / d`` as DOUBLE with a zero-denominator default."""
    n, d = _c(n), _c(d)
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(float(if_zero)))


def floored_diff(a, b) -> Column:
    """``max(a - b, 0)``; a null difference gives 0 (greatest skips nulls)."""
    return F.greatest(_c(a) - _c(b), F.lit(0))


def reliability_score(delay_rate, cancel_rate) -> Column:
    """``max(100 - 0.4*delay - 2*cancel, 0)``."""
    return F.greatest(F.lit(100.0) - _c(delay_rate) * SCORE_DELAY_WEIGHT
                      - _c(cancel_rate) * SCORE_CANCEL_WEIGHT, F.lit(0.0))


def order_status(is_cancelled="is_cancelled", is_delayed="is_delayed") -> Column:
    """Cancelled, else Delayed, else Delivered."""
    return (F.when(_c(is_cancelled), "Cancelled")
            .when(_c(is_delayed), "Delayed").otherwise("Delivered"))


def breach(total, incident, delay_rate, cancel_rate, avg_prep,
           min_orders: int = BREACH_MIN_ORDERS, delay_pct: float = BREACH_DELAY_PCT,
           cancel_pct: float = BREACH_CANCEL_PCT, prep_min: float = BREACH_PREP_MIN) -> Column:
    """Enough orders, a non-normal incident, and any threshold exceeded (strict)."""
    return ((_c(total) >= min_orders) & (_c(incident) != F.lit("normal"))
            & ((_c(delay_rate) > delay_pct) | (_c(cancel_rate) > cancel_pct)
               | (_c(avg_prep) > prep_min)))

