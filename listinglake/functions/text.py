"""Text functions, all JVM-side ``Column -> Column``."""

from __future__ import annotations

import sys
from functools import cache, reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake.constants import HTML_ENTITIES, HTML_TAG

# Every character that str.strip() removes.
_SPACE = "".join(filter(str.isspace, map(chr, range(sys.maxunicode + 1))))


def strip(column: Column) -> Column:
    """Trim all Unicode white space; ``F.trim`` alone would only take blanks."""
    return F.btrim(column, F.lit(_SPACE))


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def squeeze(column: Column) -> Column:
    """Turn every white-space run into one blank."""
    return F.regexp_replace(column, r"\s+", " ")


def clean_text(column: Column) -> Column:
    """Squeeze, trim and turn blanks into null."""
    return blank_to_null(F.trim(squeeze(column)))


def strip_html(column: Column) -> Column:
    """Take tags out, decode the known entities in order, then clean."""
    text = F.regexp_replace(column, HTML_TAG, " ")
    for entity, plain in HTML_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return clean_text(text)


def text_or_empty(column: Column) -> Column:
    """Stripped text, ``""`` for null."""
    return F.coalesce(strip(column.cast("string")), F.lit(""))


def or_else(first: Column, *others: Column) -> Column:
    """First value that is neither null nor ``""``; white space does count as a value."""
    return F.coalesce(*[blank_to_null(c) for c in (first, *others[:-1])], others[-1])


def default_to(column: Column, member: str) -> Column:
    return F.coalesce(column, F.lit(member))


def contains_any(column: Column, words: tuple[str, ...]) -> Column:
    """True when the text holds one of ``words`` literally, in any case."""
    lowered = F.lower(column)
    return reduce(or_, [lowered.contains(F.lower(F.lit(word))) for word in words], F.lit(False))


def _code_point_class(chars: list[str]) -> str:
    """Regex class of ``chars``, neighbouring code points written as ranges."""
    points, parts = sorted(map(ord, chars)), []
    while points:
        first = last = points.pop(0)
        while points and points[0] == last + 1:
            last = points.pop(0)
        parts.append(f"\\x{{{first:x}}}-\\x{{{last:x}}}")
    return "[" + "".join(parts) + "]"


# Lower case is already the fold of nearly all text; this mends two common letters of it.
_SIMPLE = {"ß": "ss", "µ": "μ"}


class _Folding(NamedTuple):
    one_to_one: str
    folds: str
    growing: list[tuple[str, str]]
    has_rare: str


@cache
def _folding() -> _Folding:
    """Case folding of the interpreter's Unicode tables, derived at first use.

    Only text with one of the few hundred exceptions to lower case takes the exact route.
    Capital sigma counts as one, since its lower case depends on its place in the word.
    """
    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if not c == c.lower() == c.casefold()]
    changed = [c for c in letters if c.casefold() != c]
    rare = [c for c in letters if c.casefold() != c.lower() and c not in "ßẞµ"] + ["Σ"]
    alike = [c for c in changed if len(c.casefold()) == 1]
    growing = [(c, c.casefold()) for c in changed if len(c.casefold()) > 1]
    # The first range turns most letters away before the long list is looked at.
    has_rare = f"[\\x{{{min(map(ord, rare)):x}}}-\\x{{10ffff}}&&{_code_point_class(rare)}]"
    return _Folding("".join(alike), "".join(c.casefold() for c in alike), growing, has_rare)


def fold(column: Column) -> Column:
    """Full Unicode case folding without a Python worker."""
    folding = _folding()
    simple = F.lower(column)
    for char, folded in _SIMPLE.items():
        simple = F.replace(simple, F.lit(char), F.lit(folded))
    exact = F.aggregate(
        F.array(*[F.array(F.lit(c), F.lit(folded)) for c, folded in folding.growing]),
        F.translate(column, folding.one_to_one, folding.folds),
        lambda text, pair: F.replace(text, pair[0], pair[1]),
    )
    return (
        F.when(F.octet_length(column) == F.char_length(column), F.lower(column))
        .when(column.rlike(folding.has_rare), exact)
        .otherwise(simple)
    )
