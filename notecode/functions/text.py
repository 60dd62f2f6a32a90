"""Text folding as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _plain_letters() -> tuple[str, str]:
    """Letters with diacritics and their base letters, from the Unicode decompositions of the Latin blocks."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0xFF01, 0xFF5F)) for c in block]
    pairs = [(a, b) for a, b in pairs if a != b and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _BASE = _plain_letters()


def fold(text: Column) -> Column:
    """Lower case, without diacritics, invisible characters and full-width forms."""
    plain = F.translate(F.regexp_replace(text, r"[\p{M}\x{ad}\x{200b}-\x{200d}\x{2060}\x{feff}]", ""), _ACCENTED, _BASE)
    return F.lower(plain)


def squash(text: Column) -> Column:
    """Folded letters and digits only."""
    return F.regexp_replace(fold(text), r"[^\p{L}\p{N}]", "")


def sound_key(key: Column) -> Column:
    """Equal for spellings that sound alike: ph and f, y and i, ae and e, doubled letters."""
    k = F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "ph", "f"), "y", "i"), "ae|oe", "e")
    return F.regexp_replace(k, r"([a-z])\1+", "$1")
