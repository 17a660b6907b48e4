"""Text folding used for city and province names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented vowels and their plain forms, position by position.
ACCENTED = "ÁÉÍÓÚáéíóú"
PLAIN = "AEIOUaeiou"


def accent_fold(c: Column, upper: bool = False) -> Column:
    """Replace accented vowels, both as characters and as the literal escapes
    ``\\U00C1`` / ``\\u00c1`` that some sources leave in the text."""
    escaped = c
    for accented, plain in zip(ACCENTED, PLAIN):
        for escape in (f"\\U{ord(accented):04X}", f"\\u{ord(accented):04x}"):
            escaped = F.replace(escaped, F.lit(escape), F.lit(plain))
    unescaped = F.when(F.contains(c, F.lit("\\")), escaped).otherwise(c)
    folded = F.translate(unescaped, ACCENTED, PLAIN)
    return F.upper(folded) if upper else folded


def city_key(c: Column) -> Column:
    """Join key of a city name: accents and case do not matter."""
    return F.lower(accent_fold(c))
