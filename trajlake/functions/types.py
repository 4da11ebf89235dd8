"""A lattice of element types: the narrowest type that holds all values of two."""

from __future__ import annotations

import re
from collections.abc import Iterable

#: Bits of whole numbers that a float of so many bits holds without loss.
_EXACT = {16: 11, 32: 24, 64: 53}


def normal(dtype: str | None) -> str:
    """Spelling without letter case and blanks; none is the empty string, which fits below every type."""
    return re.sub(r"\s+", "", (dtype or "").lower())


def promote(a: str | None, b: str | None) -> str:
    """The join of two types: '' < bool < numbers < string; what nothing else holds becomes string.

    Commutative, associative and idempotent: a fold gives the same type in whatever order and grouping files come.
    """
    return promote_all([a, b])


def promote_all(dtypes: Iterable[str | None]) -> str:
    kinds = sorted({normal(x) for x in dtypes} - {""})
    numbers = [k for k in kinds if k != "bool"]
    if len(kinds) <= 1 or len(numbers) == 1 and re.fullmatch(r"(u?int|float)\d*", numbers[0]):
        return (numbers or kinds or [""])[0]
    parsed = [re.fullmatch(r"(u?int|float)(\d*)", k) for k in numbers]
    if not all(parsed):
        return "string"
    of = {"int": [], "uint": [], "float": []}
    for m in parsed:
        of[m[1]].append(int(m[2] or 64))
    # an unsigned number counts as the signed one that holds it, or floats would forget what they were joined with
    whole = max([*of["int"], *(2 * n for n in of["uint"])], default=0)
    if of["float"]:
        return f"float{min(n for n in (16, 32, 64) if n >= max(of['float']) and _EXACT[n] >= min(whole, 53))}"
    if not of["int"]:
        return f"uint{max(of['uint'])}"
    return f"int{whole}" if whole <= 64 else "float64"
