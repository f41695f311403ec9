"""String cleaning for dimension values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as whitespace at either end of a
# value (Python's str.isspace set). Spark's trim knows the plain space only.
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_str(column: Column) -> Column:
    """Upper case, then strip whitespace at both ends; NULL stays NULL."""
    return F.btrim(F.upper(column), F.lit(WHITESPACE))


def first_letter_acronym(column: Column) -> Column:
    """First letter of each word; words of one or two letters are kept whole.

    Words are what single spaces separate, so runs of spaces give empty words,
    which add nothing.
    """
    words = F.split(column, " ", -1)
    parts = F.transform(words, lambda w: F.when(F.length(w) > 2, F.substring(w, 1, 1)).otherwise(w))
    return F.array_join(parts, "")
