"""Text expressions (JVM-side regex, whole-stage codegen; no Python UDFs).

Fixed values that must equal the source behaviour:
  * white space = Unicode White_Space plus U+001C..U+001F (what Python's
    ``str.strip``/``str.split`` treat as space);
  * the literal ``"nan"`` (exact match, before stripping) becomes ``""``;
  * script classes, tested in this order over code points:
      chinese  U+4E00..U+9FFF  share > 0.3
      cyrillic U+0400..U+04FF  share > 0.3
      arabic   U+0600..U+06FF  share > 0.3
      english  U+0000..U+007F  share > 0.8
      mixed    otherwise;  null or "" -> empty
  * emoji ranges: U+1F600..U+1F64F, U+1F300..U+1F5FF, U+1F680..U+1F6FF,
    U+1F1E0..U+1F1FF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white-space characters, in code point order (equal to the
# set Python's str.isspace() accepts: Unicode White_Space plus U+001C..U+001F).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Java regex (Spark).  (?U) makes \s the Unicode White_Space class.
WS_CLASS = r"\s\x{1c}-\x{1f}"
WORD_RE = rf"(?U)[^{WS_CLASS}]+"
EMOJI_RE = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]"

# (label, code point range, share threshold), in test order.
SCRIPT_RULES = [
    ("chinese", r"\x{4e00}-\x{9fff}", 0.3),
    ("cyrillic", r"\x{0400}-\x{04ff}", 0.3),
    ("arabic", r"\x{0600}-\x{06ff}", 0.3),
    ("english", r"\x{0000}-\x{007f}", 0.8),
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Strip Unicode white space at both ends (Spark ``trim`` only strips U+0020).

    Fast path: ``trim`` the spaces, then test the two edge characters only —
    the first with one set-membership test, the last with suffix compares
    (neither walks the string).  Only when an edge is other white space does
    the full ``btrim`` with the character set run, whose cost grows with the
    whole string.  The result equals ``btrim(c, WHITESPACE)`` always.
    """
    x = F.trim(_col(c))
    other = [ch for ch in WHITESPACE if ch != " "]
    edge = F.substring(x, 1, 1).isin(*other)
    for ch in other:
        edge = edge | x.endswith(ch)
    return F.when(edge, F.btrim(x, F.lit(WHITESPACE))).otherwise(x)


def clean_text(c, blank_to_null: bool) -> Column:
    """``"nan"`` -> ``""``, then strip; optionally ``""`` -> null.  Null stays null."""
    c = _col(c)
    x = ustrip(F.when(c == F.lit("nan"), F.lit("")).otherwise(c))
    return F.nullif(x, F.lit("")) if blank_to_null else x


def word_count(c) -> Column:
    """Number of white-space separated words; null counts as 0."""
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(WORD_RE)).cast("bigint")


def char_length(c) -> Column:
    """Length in code points; null counts as 0."""
    return F.coalesce(F.length(_col(c)), F.lit(0)).cast("bigint")


def _share(c: Column, char_range: str) -> Column:
    return F.regexp_count(c, F.lit(f"[{char_range}]")) / F.length(c)


def script_class(c) -> Column:
    """Dominant script of a text by code-point share (see module doc).

    The ranges are disjoint, so a text more than 80 % ASCII cannot be more than
    30 % of another script: testing ``english`` first gives the same label as
    the documented order and skips three regex scans for most texts.
    """
    c = _col(c)
    rules = {label: (rng, thr) for label, rng, thr in SCRIPT_RULES}
    expr = F.when(c.isNull() | (c == F.lit("")), F.lit("empty"))
    non_ascii = F.regexp_count(c, F.lit(r"[^\x{0000}-\x{007f}]"))
    expr = expr.when(non_ascii < F.length(c) * F.lit(1.0 - rules["english"][1]), F.lit("english"))
    for label, rng, thr in SCRIPT_RULES:
        if label != "english":
            expr = expr.when(_share(c, rng) > F.lit(thr), F.lit(label))
    return expr.otherwise(F.lit("mixed"))


def has_emoji(c) -> Column:
    """True when the text holds a code point of the emoji ranges; null -> false."""
    return F.coalesce(_col(c).rlike(EMOJI_RE), F.lit(False))


def contains_ci(c, keyword: str) -> Column:
    """Case-insensitive literal substring test (Unicode case folding by ``lower``)."""
    return F.contains(F.lower(_col(c)), F.lower(F.lit(keyword)))


def like_ci(c, keyword: str) -> Column:
    """Compatibility mode: ``%``/``_`` in the keyword act as wildcards.

    The escape character is U+0001, so a backslash in the keyword is literal and
    a trailing backslash cannot end the pattern in an escape.
    """
    return F.like(F.lower(_col(c)), F.lower(F.lit(f"%{keyword}%")), F.lit("\u0001"))
