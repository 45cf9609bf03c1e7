"""Row predicates of the shopper log and the user table (FLT-1..7)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from promoscope.schemas import AGE_UNKNOWN, FEMALE, MALE, YOUNG_AGES


def day_window(day_from: int, day_to: int | None = None, col: str = "time_stamp") -> Column:
    """Month-day code inside [day_from, day_to]; one day when day_to is None."""
    if day_to is None or day_to == day_from:
        return F.col(col) == F.lit(day_from)
    return F.col(col).between(F.lit(day_from), F.lit(day_to))


def action_in(actions: Iterable[int], col: str = "action_type") -> Column:
    return F.col(col).isin(*[F.lit(a) for a in actions])


def action_not_in(actions: Iterable[int], col: str = "action_type") -> Column:
    # NULL action fails both forms: a row with no action is dropped.
    return ~F.col(col).isin(*[F.lit(a) for a in actions])


def young(col: str = "age_range") -> Column:
    return F.col(col).isin(*[F.lit(a) for a in YOUNG_AGES])


def known_gender(col: str = "gender") -> Column:
    return F.col(col).isin(F.lit(FEMALE), F.lit(MALE))


def known_age_strict(col: str = "age_range") -> Column:
    """Age present and not the unknown code."""
    return F.col(col).isNotNull() & (F.col(col) != F.lit(AGE_UNKNOWN))


def known_age_lenient(col: str = "age_range") -> Column:
    """Age present; the unknown code 0 is kept (the DataFrame variant's rule)."""
    return F.col(col).isNotNull()
