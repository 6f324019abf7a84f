"""Words of a text as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters and digits of ASCII and of anything beyond ASCII.
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is (``lower`` alone would change other scripts)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def alnum_words(text: Column) -> Column:
    """The words between white space and punctuation, in order; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(ALNUM), 0)
