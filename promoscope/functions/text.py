"""Text and arithmetic helpers: delimited lines, ratios, percent text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_fields(cols: Sequence[str], sep: str = ",") -> Column:
    """Columns to one delimited line; NULL becomes an empty field.

    ``concat_ws`` alone would skip NULLs and shift the positions.
    """
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def field(line: str | Column, index: int, sep: str = ",") -> Column:
    """Field ``index`` (0-based) of a delimited line; NULL when the line is short."""
    line = F.col(line) if isinstance(line, str) else line
    return F.get(F.split(line, sep), F.lit(index))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, NULL when den is 0 (plain ``/`` raises under ANSI)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent_text(count: str | Column, total: str | Column) -> Column:
    """'12.34%' for count/total, rounded half-up on the exact ratio.

    Integer arithmetic (hundredths of a percent) gives the same text in
    every engine, where float formatting differs at ties.
    """
    count = F.col(count) if isinstance(count, str) else count
    total = F.col(total) if isinstance(total, str) else total
    hundredths = F.floor((count * 20000 + total) / (total * 2)).cast("long")
    return F.when(total > 0, F.format_string(
        "%d.%02d%%", (hundredths / 100).cast("long"), hundredths % 100))


def ranked_line(rank: str, key: str, number: str) -> Column:
    """'rank<TAB>key, number', the text form of a ranked list."""
    return F.format_string("%d\t%s, %d", F.col(rank), F.col(key).cast("string"), F.col(number))
