"""Snake-case cleaning of names, for header lists on the driver and for column values on the JVM.

Both forms walk the same list of replacement steps, so a header and a value clean alike.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols spelt out or dropped before cleaning.
SYMBOLS = (("'", ""), ('"', ""), ("%", "_percent_"), ("#", "_number_"))

# Letters whose plain spelling is longer than one character or has no accent to drop.
LETTERS = (
    ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ß", "ss"), ("þ", "th"), ("Þ", "TH"),
    ("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ð", "d"), ("Ð", "D"), ("ł", "l"), ("Ł", "L"),
)

# Word boundaries inside a run of letters, as (pattern, left group, right group).
BOUNDARIES = (r"([a-z])([A-Z])", r"([0-9])([A-Z][a-z])", r"([A-Z])([A-Z][a-z])")


@lru_cache(maxsize=1)
def _accents() -> tuple[str, str]:
    accented, plain = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


def clean_name(text: str | None) -> str:
    """Snake-case one name; a missing name reads ``na`` and an empty one ``x``."""
    value = "NA" if text is None else text
    for symbol, spelt in SYMBOLS + LETTERS:
        value = value.replace(symbol, spelt)
    value = value.translate(str.maketrans(*_accents()))
    value = re.sub(r"[\W_]+", "_", value).strip("_")
    for boundary in BOUNDARIES:
        value = re.sub(boundary, r"\1_\2", value)
    value = value.lower()
    return value if value and not value[0].isdigit() else f"x{value}"


def unique_names(names: Iterable[str]) -> list[str]:
    """Number the later copies of a repeated name: a, a_2, a_3."""
    result = list(names)
    while len(set(result)) < len(result):
        seen: dict[str, int] = {}
        numbered = []
        for name in result:
            seen[name] = seen.get(name, 0) + 1
            numbered.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
        result = numbered
    return result


def clean_names(names: Iterable[str | None]) -> list[str]:
    """Snake-case a whole header, keeping the names distinct."""
    return unique_names(clean_name(name) for name in names)


def clean_name_column(col: Column) -> Column:
    """Column form of :func:`clean_name`; repeated values stay repeated."""
    value = F.coalesce(col, F.lit("NA"))
    for symbol, spelt in SYMBOLS + LETTERS:
        value = F.replace(value, F.lit(symbol), F.lit(spelt))
    value = F.translate(value, *_accents())
    value = F.regexp_replace(value, r"[^\p{L}\p{N}]+", "_")
    value = F.regexp_replace(value, "^_|_$", "")
    for boundary in BOUNDARIES:
        value = F.regexp_replace(value, boundary, "$1_$2")
    value = F.lower(value)
    return F.when(value.rlike("^[0-9]") | (value == ""), F.concat(F.lit("x"), value)).otherwise(value)
