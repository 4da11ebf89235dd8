"""Words of texts: unbroken runs of letters and digits, without letter case."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The same class of characters for Java and for the regex package.
WORD = r"[\p{L}\p{N}]+"
_WORD = regex.compile(WORD)


def words(text: str | None) -> list[str]:
    """Words of a text; case is folded fully, so that a sharp s equals its capital form."""
    return _WORD.findall(text.casefold()) if text else []


def word_array(text: Column) -> Column:
    """The same inside the JVM; null has no words."""
    folded = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\u00df"), F.lit("ss"))  # a sharp s has no single capital
    return F.regexp_extract_all(folded, F.lit(f"({WORD})"), F.lit(1))


@lru_cache(maxsize=1)
def _plain_letters() -> tuple[str, str]:
    """Letters of the planes in which letters carry marks, and what they are without."""
    bare = {c: "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x)) for c in map(chr, range(0xC0, 0x2000))}
    one = {c: b for c, b in bare.items() if b != c and len(b) == 1}
    return "".join(one), "".join(one.values())


def without_marks(text: Column) -> Column:
    """Letters without their diacritical marks, composed or not."""
    return F.regexp_replace(F.translate(text, *_plain_letters()), r"\p{Mn}+", "")


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no layout; what can't be parsed stays as it is, without blanks around it."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), F.trim(text))
