"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters they fold to.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"

# Texts that mean "no value".
NULL_TOKENS = ("na", "n/a", "null", "none")

ZIP_WIDTH = 5


def lower_trimmed(c: Column | str) -> Column:
    return F.lower(F.trim(c))


def upper_trimmed(c: Column | str) -> Column:
    return F.upper(F.trim(c))


def not_blank(c: Column | str) -> Column:
    """True for text with a character other than a space."""
    return F.trim(c) != ""


def fold_accents(c: Column | str) -> Column:
    """Lower-case, then map accented vowels and cedilla to plain letters in one pass."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def collapse_spaces(c: Column | str) -> Column:
    """Trim, then turn every run of whitespace into one space."""
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def null_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trimmed text; blank text and the given tokens become NULL."""
    trimmed = F.trim(c)
    return F.when(~F.lower(trimmed).isin("", *tokens), trimmed)


def pad_zip(c: Column | str, width: int = ZIP_WIDTH) -> Column:
    """Zip code as text with its leading zeros; longer text is cut to ``width``."""
    return F.lpad(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), width, "0")
