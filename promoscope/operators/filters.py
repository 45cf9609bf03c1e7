"""Row filters over the log and the user table (FLT-1..8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from promoscope.functions.predicates import (
    action_in, action_not_in, day_window, known_age_lenient, known_age_strict,
    known_gender, young,
)
from promoscope.schemas import CLICK, PURCHASE, YOUNG_AGES


def promo_log(log: DataFrame, day_from: int, day_to: int | None = None,
              actions: Iterable[int] | None = None,
              exclude_actions: Iterable[int] | None = None) -> DataFrame:
    """Log rows inside the day window, optionally restricted by action."""
    cond = day_window(day_from, day_to)
    if actions is not None:
        cond = cond & action_in(actions)
    if exclude_actions is not None:
        cond = cond & action_not_in(exclude_actions)
    return log.filter(cond)


def promo_non_click(log: DataFrame, day_from: int, day_to: int | None = None) -> DataFrame:
    """FLT-1: cart, purchase or favourite in the window."""
    return promo_log(log, day_from, day_to, exclude_actions=(CLICK,))


def promo_purchases(log: DataFrame, day_from: int, day_to: int | None = None) -> DataFrame:
    """FLT-2: purchases in the window."""
    return promo_log(log, day_from, day_to, actions=(PURCHASE,))


def young_users(users: DataFrame, ages: Iterable[int] = YOUNG_AGES) -> DataFrame:
    """FLT-3 (and FLT-7: a blank age never matches)."""
    ages = tuple(ages)
    return users.filter(young() if ages == YOUNG_AGES else users.age_range.isin(*ages))


def with_known_gender(users: DataFrame) -> DataFrame:
    """FLT-4."""
    return users.filter(known_gender())


def with_known_age(users: DataFrame, unknown: str = "drop") -> DataFrame:
    """FLT-5 (``unknown="drop"``) or FLT-6 (``unknown="keep_zero"``)."""
    if unknown == "drop":
        return users.filter(known_age_strict())
    if unknown == "keep_zero":
        return users.filter(known_age_lenient())
    raise ValueError("unknown must be 'drop' or 'keep_zero'")
