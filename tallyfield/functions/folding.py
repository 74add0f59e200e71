"""Names without case and marks, as a full-text index of names folds them.

A letter whose canonical decomposition is a letter of the Latin alphabet a-z with marks becomes that letter, the marks of such
decompositions vanish where they stand alone, and every other letter takes its single-letter case folding (so the slashed or barred
letters, which don't decompose, keep their stroke).
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands between tokens.
BETWEEN = r"[^\p{L}\p{N}\p{Co}]+"


def _parts(c: str) -> tuple[str, str] | None:
    """The plain letter and the marks of a marked letter."""
    d = unicodedata.normalize("NFD", c)
    if d[0].isascii() and d[0].isalpha() and all(unicodedata.category(m) == "Mn" for m in d[1:]):
        return d[0].lower(), d[1:]
    return None


@lru_cache(maxsize=1)
def tables() -> tuple[str, str, str]:
    """Letters that change, what they become, and marks that vanish; from the Unicode data at hand."""
    source, into, marks = [], [], set()
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if unicodedata.category(c)[0] not in "LN":
            continue
        if parts := _parts(c):
            marks.update(parts[1])
            plain = parts[0]
        else:
            low = c.lower() if len(c.lower()) == 1 else c
            plain = low.casefold() if len(low.casefold()) == 1 else low
            plain = (_parts(plain) or (plain,))[0]
        if plain != c:
            source.append(c)
            into.append(plain)
    return "".join(source), "".join(into), "".join(sorted(marks))


def fold(c: Column) -> Column:
    source, into, marks = tables()
    return F.translate(c, source + marks, into)


def fold_text(s: str) -> str:
    """The same of a string."""
    source, into, marks = tables()
    return s.translate(str.maketrans(source, into, marks))
