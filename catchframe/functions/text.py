"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catchframe.functions.semantics import as_col, to_double


def split_to_numbers(c: Column | str) -> Column:
    """Text such as ``'1,200 3.5 x'`` -> ``[1200.0, 3.5, NULL]``.

    A blank at the end makes no piece, and an empty text has none.
    """
    plain = F.regexp_replace(F.replace(as_col(c), F.lit(","), F.lit("")), "[ \\t]+$", "")
    pieces = F.split(plain, "[ \\t]+")
    return F.transform(F.when(plain == "", F.slice(pieces, 1, 0)).otherwise(pieces), to_double)


def digits(c: Column | str) -> Column:
    """First run of digits in a text, as int."""
    return F.regexp_extract(as_col(c).cast("string"), r"(\d+)", 1).try_cast("int")


def number_text(c: Column | str) -> Column:
    """Number as short text: ``10`` and not ``10.0``."""
    return F.regexp_replace(as_col(c).cast("string"), r"\.0$", "")
