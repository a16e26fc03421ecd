"""Safe coercion of dirty text to numbers and timestamps.

Every cast is a ``try_cast`` behind a regex gate, so the result does not depend
on ANSI mode and Spark-only spellings (``3d``, ``3f``, bare ``2026`` as a
timestamp) are rejected the same way an independent SQL engine rejects them.

Fixed values:
  * numeric text: optional sign, digits with optional fraction (or a leading
    dot), optional exponent, surrounding white space allowed;
  * timestamp text: ``yyyy-MM-dd`` optionally followed by `` ``/``T`` and
    ``HH:mm[:ss[.ffffff]]``, optional trailing ``Z`` (UTC); or ``Mon d, yyyy``
    with English month abbreviations Jan Feb Mar Apr May Jun Jul Aug Sep Oct
    Nov Dec.
  * rounding of scores: half to even (2.5 -> 2, 3.5 -> 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
ISO_TS_RE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?Z?$"
MONTH_DAY_YEAR_RE = r"^([A-Z][a-z]{2}) (\d{1,2}), (\d{4})$"
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Dirty text -> double, or null when the text is not a plain number."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMERIC_RE), c.try_cast("double"))


def round_half_even_int(c) -> Column:
    """Round a double half-to-even and make it an int (``round`` is half-up)."""
    return F.bround(_col(c), 0).cast("int")


def _month_number(name: Column) -> Column:
    expr = None
    for i, m in enumerate(MONTHS, start=1):
        expr = (F.when(name == F.lit(m), F.lit(i)) if expr is None else expr.when(name == F.lit(m), F.lit(i)))
    return expr


def to_timestamp_ntz(c) -> Column:
    """Dirty text -> ``timestamp_ntz`` (wall clock, no zone), or null.

    Independent of the session time zone: month-name dates are rebuilt as ISO
    text and everything goes through ``try_cast``.
    """
    c = _col(c).cast("string")
    # the trailing-Z rewrite (a second regex) runs only for values that end in Z
    no_z = F.when(c.endswith("Z"), F.regexp_replace(c, "Z$", "")).otherwise(c)
    iso = F.when(c.rlike(ISO_TS_RE), no_z.try_cast("timestamp_ntz"))
    mdy = F.regexp_extract(c, MONTH_DAY_YEAR_RE, 0)
    # an unknown month name gives null (concat propagates it)
    rebuilt = F.concat(
        F.regexp_extract(c, MONTH_DAY_YEAR_RE, 3), F.lit("-"),
        F.lpad(_month_number(F.regexp_extract(c, MONTH_DAY_YEAR_RE, 1)).cast("string"), 2, "0"), F.lit("-"),
        F.lpad(F.regexp_extract(c, MONTH_DAY_YEAR_RE, 2), 2, "0"),
    )
    named = F.when(mdy != F.lit(""), rebuilt.try_cast("timestamp_ntz"))
    return F.coalesce(iso, named)


# ISO date-time with an optional UTC offset (``Z``, ``+00:00``, ``-0530``)
ISO_OFFSET_RE = r"^(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)(Z|([+-])(\d{2}):?(\d{2}))?$"


def iso_to_utc_ntz(c) -> Column:
    """ISO text with an optional UTC offset -> UTC wall clock as ``timestamp_ntz``.

    The local part is cast, then the offset is subtracted — no session time
    zone is involved.  Text without an offset is taken as UTC already.
    """
    c = _col(c).cast("string")
    local = F.regexp_extract(c, ISO_OFFSET_RE, 1).try_cast("timestamp_ntz")
    sign = F.when(F.regexp_extract(c, ISO_OFFSET_RE, 5) == F.lit("-"), F.lit(-1)).otherwise(F.lit(1))
    hh = F.regexp_extract(c, ISO_OFFSET_RE, 6)
    mm = F.regexp_extract(c, ISO_OFFSET_RE, 7)
    minutes = F.when(hh == F.lit(""), F.lit(0)).otherwise(sign * (hh.cast("int") * 60 + mm.cast("int")))
    return F.when(c.rlike(ISO_OFFSET_RE), F.timestamp_add("MINUTE", -minutes, local))
