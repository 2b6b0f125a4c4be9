"""Error-tolerant casts of raw text.  Text that is not a plain number or date becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r"
# A date, optionally followed by a complete time of day and a zone offset.
_CLOCK = r"(?:(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d*)?)?|24:00:00)"
_TIME = rf"(?:[T ]{_CLOCK}\s*(?:Z|UTC|[+-]\d{{1,2}}(?::?\d{{2}})?)?)?"
ISO_DATE = rf"^\s*\d{{4,6}}-\d{{1,2}}-\d{{1,2}}{_TIME}\s*$"
# Other separators, or a year of fewer than four digits.
OTHER_DATE = rf"^\s*(\d{{1,6}})([-/ \\])(\d{{1,2}})\2(\d{{1,2}}){_TIME}\s*$"


def to_date_or_null(text: Column) -> Column:
    year, month, day = (F.regexp_extract(text, OTHER_DATE, g) for g in (1, 3, 4))
    padded = F.lpad(year, F.greatest(F.length(year), F.lit(4)), "0")
    return F.when(text.rlike(ISO_DATE), text.try_cast("date")).when(
        text.rlike(OTHER_DATE), F.concat_ws("-", padded, month, day).try_cast("date")
    )


def to_double_or_null(text: Column) -> Column:
    """Number or NULL.  Type suffixes (``5d``, ``1F``) and hexadecimal text are not numbers; ``5_000`` and ``+-5`` are."""
    letters = F.lower(text) != F.upper(text)
    bare = F.lower(F.btrim(text, F.lit(_BLANKS)))
    typed = F.right(bare, F.lit(1)).isin("d", "f") & ~F.endswith(bare, F.lit("inf"))
    hexadecimal = F.contains(bare, F.lit("x"))
    grouped = F.when(
        bare.rlike(r"^[\d_.e+-]+$"), F.regexp_replace(bare, r"(?<=\d)_(?=\d)|^\+(?=-)", "").try_cast("double")
    )
    return F.coalesce(F.when(~letters | ~(typed | hexadecimal), text.try_cast("double")), grouped)
