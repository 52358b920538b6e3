"""Code lists of the e-commerce domain and the expressions that use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.numbers import banded
from martwright.functions.text import lower_trimmed

# Macro-region -> its state codes (27 in all).
REGION_STATES = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "SC", "RS"),
    "Northeast": ("BA", "PE", "CE", "MA", "PB", "RN", "PI", "AL", "SE"),
    "North": ("AM", "PA", "RO", "RR", "AC", "AP", "TO"),
    "Center-West": ("MT", "MS", "GO", "DF"),
}
STATE_CODES = tuple(state for states in REGION_STATES.values() for state in states)
UNKNOWN_REGION = "Unknown"

# Canonical payment type -> spellings that mean it.
PAYMENT_SYNONYMS = {
    "credit_card": ("credit_card", "credit card", "card"),
    "boleto": ("boleto", "bank_slip", "bank slip"),
    "voucher": ("voucher", "gift_card"),
    "debit_card": ("debit_card", "debit card"),
    "not_defined": ("not_defined", "undefined", "unknown"),
}


def region_of(state: Column, regions: Mapping[str, Sequence[str]] = REGION_STATES) -> Column:
    """Macro-region of a state code; other codes and NULL are ``Unknown``."""
    return banded([(state.isin(*codes), F.lit(name)) for name, codes in regions.items()], UNKNOWN_REGION)


def map_synonyms(c: Column | str, synonyms: Mapping[str, Sequence[str]]) -> Column:
    """Canonical code of a spelling, compared lower-cased and trimmed; others pass through that way."""
    cleaned = lower_trimmed(c)
    return banded([(cleaned.isin(*names), F.lit(code)) for code, names in synonyms.items()], cleaned)


def is_valid_state(state: Column) -> Column:
    return (F.length(state) == 2) & state.isin(*STATE_CODES)
