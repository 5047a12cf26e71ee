"""Date column functions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from surtido.constants import DATE_FORMATS


# Letters of patterns that stand for digits, and for texts.
_DIGITS, _TEXTS = "yuMdHhkKmsS", "MEa"
_FIELD = re.compile(r"([A-Za-z])\1*|[^A-Za-z]")


def _could_read(text: Column, pattern: str) -> Column:
    """False only where the pattern cannot read a text, told by its digits and separators.

    A format that fails costs an exception, many times this look at the text.
    """
    if re.search(r"[\[\]'{}#]", pattern):
        return F.lit(True)
    parts = []
    for field in _FIELD.finditer(pattern):
        token, letter = field[0], field[1]
        if letter is None:
            parts.append(re.escape(token))
        elif letter in _TEXTS and (letter != "M" or len(token) > 2):
            parts.append(".+")
        elif letter in _DIGITS:
            parts.append("[+-]?[0-9]+")
        else:
            return F.lit(True)
    return text.rlike(f"^{''.join(parts)}$")


def parse_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS,
                    strict: bool = True) -> Column:
    """ISO texts by a plain cast, others by the first format that reads them.

    A text that nothing reads raises in strict mode and is null otherwise.
    """
    iso = F.when(text.rlike(r"^\s*\d{4}-\d"), text.try_cast("timestamp"))
    parsed = F.coalesce(iso, *[
        F.when(_could_read(text, f), F.try_to_timestamp(text, F.lit(f))) for f in formats])
    if not strict:
        return parsed
    unreadable = F.raise_error(F.concat(F.lit("unreadable date: "), text))
    return F.when(parsed.isNull() & text.isNotNull(), unreadable.cast("timestamp")).otherwise(parsed)


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def months_to_end_of_next_year(last: Column) -> Column:
    """Array of month starts after ``last`` up to December of the following year."""
    return F.sequence(
        F.add_months(month_start(last), 1),
        F.make_date(F.year(last) + 1, F.lit(12), F.lit(1)),
        F.expr("interval 1 month"),
    )
