"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surtido.constants import CANCELLED_PREFIX, MISSING_TOKENS, WHITE_SPACE


def strip_upper(c: Column) -> Column:
    """Text form, without white space at either end, in upper case.

    Plain ``trim`` removes blanks only. That is enough when visible ASCII characters are
    left at both ends; only other texts are searched for the rarer white space.
    """
    text = F.trim(c.cast("string"))
    ends = (F.ascii(text), F.ascii(F.substring(text, -1, 1)))
    visible = ends[0].between(33, 126) & ends[1].between(33, 126)
    return F.upper(F.when(visible, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE))))


def is_cancelled(invoice: Column) -> Column:
    """True for cancelled invoices; an invoice without a number is not cancelled."""
    return F.coalesce(invoice.cast("string").startswith(CANCELLED_PREFIX), F.lit(False))


def with_missing_as_null(c: Column, tokens=MISSING_TOKENS) -> Column:
    return F.when(~c.isin(list(tokens)), c)
