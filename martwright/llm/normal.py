"""Text normalisation in column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is.

    ``lower`` does that for texts of single-byte characters, and much faster than ``translate``.
    """
    single = F.octet_length(text) == F.length(text)
    return F.when(single, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
