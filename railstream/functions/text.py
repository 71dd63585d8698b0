"""Text helpers that keep the rules of the feed's own tooling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense, with the four ASCII separators.
_SPACE = r"[\s\x{1c}-\x{1f}]"
_EDGES = rf"(?U)^{_SPACE}+|{_SPACE}+$"
_NUMBER = r"^[+-]?(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?$"
_SPECIAL = r"^[+-]?(inf|infinity|nan)$"


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(text, _EDGES, "")


def ends_with_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}\z")


def without_last(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.greatest(F.length(text) - 1, F.lit(0)))


def float_text(text: Column) -> Column:
    """Text -> double; NULL when empty or not a number."""
    plain = F.lower(strip(text))
    number = F.when(plain.rlike(_NUMBER), F.replace(plain, F.lit("_"), F.lit("")))
    return F.coalesce(number, F.when(plain.rlike(_SPECIAL), plain)).try_cast("double")
