"""String columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions._column import col, value_of

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def upper(c) -> Column:
    return F.upper(col(c))


def lower(c) -> Column:
    return F.lower(col(c))


def title_case(c) -> Column:
    """Upper-case the first letter of each word and lower-case the rest.

    A word is a run of letters and digits, so every other character starts a
    new one: ``o'brien-smith`` becomes ``O'Brien-Smith``.
    """
    runs = F.regexp_extract_all(
        col(c), F.lit(r"[\p{IsAlphabetic}\p{N}]+|[^\p{IsAlphabetic}\p{N}]+"), F.lit(0)
    )
    return F.array_join(F.transform(runs, capitalize), "")


def strip(c, chars: str | None = None, side: str = "both") -> Column:
    """Remove white space of any kind, or the given characters, from the ends."""
    trims = {"both": F.btrim, "left": F.ltrim, "right": F.rtrim}
    if side not in trims:
        raise ValueError(f"side must be both, left or right, not {side!r}")
    # a set of characters looks at the ends only; a pattern would search the whole text
    return trims[side](col(c), F.lit(WHITE_SPACE if chars is None else chars))


def capitalize(c) -> Column:
    """First character upper case, everything after it lower case."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def prepend_text(c, text: str) -> Column:
    return F.concat(F.lit(text), col(c))


def append_text(c, text: str) -> Column:
    return F.concat(col(c), F.lit(text))


def concat_columns(*cols, sep: str = " ", null_text: str = "None") -> Column:
    """Join columns with a separator; a null shows up as ``null_text``."""
    return F.concat_ws(
        sep, *[F.coalesce(col(c).cast("string"), F.lit(null_text)) for c in cols]
    )


def concat_present(*cols, sep: str = " ") -> Column:
    """Join columns with a separator, leaving nulls out."""
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])


def split_text(c, sep: str = ",") -> Column:
    """Split at a literal separator."""
    return F.split(col(c), re.escape(sep), -1)


def extract_pattern(c, pattern: str, group: int = 1, no_match: str | None = None) -> Column:
    """A capture group; no match gives null, or ``no_match`` when it is given.

    A group that matches the empty string counts as a match and stays ``''``.
    """
    c = col(c)
    found = F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, group))
    if no_match is None:
        return found
    return F.when(c.isNotNull(), F.coalesce(found, F.lit(no_match)))


def replace_value(c, old, new) -> Column:
    """Replace a value where the whole cell equals ``old``; ``new`` may be null."""
    c = col(c)
    return F.when(c == value_of(old), value_of(new)).otherwise(c)


def replace_pattern(c, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col(c), pattern, replacement)


def collapse_whitespace(c) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(col(c), f"[{WHITE_SPACE}]+", " ")


def replace_text(c, old: str, new: str) -> Column:
    """Replace every occurrence of a literal piece of text."""
    return F.replace(col(c), F.lit(old), F.lit(new))


def first_character(c) -> Column:
    return F.left(col(c), F.lit(1))


def normalise_name(c) -> Column:
    """Strip, then upper-case."""
    return upper(strip(c))


def contains_text(c, text: str) -> Column:
    return F.contains(col(c), F.lit(text))


def matches_pattern(c, pattern: str) -> Column:
    return F.regexp_like(col(c), F.lit(pattern))
