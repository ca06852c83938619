"""Text expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = "[a-z0-9]+"

# Whitespace for keyword splitting (ASCII space, tab, newline, CR, FF, VT).
WS_PATTERN = "[ \\t\\n\\r\\f\\x0B]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ASCII whitespace, as removed by a plain ``strip()`` of the reference's text.
WHITESPACE = " \t\n\r\f\x0b"


def strip(x) -> Column:
    """Remove leading and trailing ASCII whitespace (``trim`` removes only
    spaces, which would keep the ``\r`` of CRLF text or a tab indent)."""
    return F.trim(_c(x), F.lit(WHITESPACE))


def tokenize(text) -> Column:
    """Lower-case, then every run of ``[a-z0-9]`` (an ARRAY<STRING>)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TOKEN_PATTERN), 0)


def keywords(text, min_len: int = 4) -> Column:
    """Whitespace-separated words of at least ``min_len`` characters;
    the whole string when there are none."""
    t = _c(text)
    words = F.filter(F.split(F.trim(t), WS_PATTERN), lambda w: F.length(w) >= min_len)
    return F.when(F.size(words) == 0, F.array(t)).otherwise(words)


def like_pattern(word) -> Column:
    """``%word%`` for a case-insensitive LIKE; ``%``/``_`` inside the
    word stay wildcards, as in the reference."""
    return F.concat(F.lit("%"), _c(word), F.lit("%"))


def contains_word(text, word) -> Column:
    """Case-insensitive contains (``ilike '%word%'``)."""
    return F.ilike(_c(text), like_pattern(word))


# Signed or decimal number (metric values) and plain digit runs.
NUMBER_PATTERN = r"([-+]?\d*\.\d+|\d+)"
DIGITS_PATTERN = r"(\d+)"


def first_number(text, default: float = 0.0, digits_only: bool = False) -> Column:
    """The first number in ``text`` as DOUBLE, ``default`` when none."""
    pat = DIGITS_PATTERN if digits_only else NUMBER_PATTERN
    found = F.regexp_extract(_c(text), pat, 1)
    return F.coalesce(F.when(found != "", found).try_cast("double"), F.lit(float(default)))


def named_metric(text, name: str) -> Column:
    """The rest of the line after ``name =`` or ``name:`` (case-insensitive)."""
    pat = "(?i)" + re.escape(name) + r"\s*[:=]\s*([^\n]+)"
    found = strip(F.regexp_extract(_c(text), pat, 1))
    return F.when(found != "", found)


def fmt1(x) -> Column:
    """One decimal place, ties to even (as ``%.1f`` on a binary tie)."""
    return F.format_string("%.1f", F.bround(_c(x), 1))


def join_actions(actions) -> Column:
    """Actions joined with `` | ``."""
    return F.array_join(_c(actions), " | ")
