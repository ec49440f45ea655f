"""Dates: one format per file, months as periods.  All functions give SQL text."""

from __future__ import annotations

from .text import literal, strip

# The formats tried in this order on a file's first date.  MMM is a month's name, short or
# written out: in May one cannot tell.
DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "M/d/yyyy",
    "M/d/yy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "d/M/yyyy",
    "d/M/yy",
    "d/M/yyyy H:mm",
    "yyyy/M/d",
    "M-d-yyyy",
    "d-M-yyyy",
    "d-MMM-yyyy",
    "d-MMM-yy",
    "d MMM yyyy",
    "MMM d, yyyy",
    "d.M.yyyy",
    "yyyy/M/d H:mm",
    "yyyy/M/d H:mm:ss",
    "M/d/yyyy h:mm:ss a",
    "d/M/yyyy H:mm:ss",
    "M-d-yyyy H:mm",
    "M-d-yyyy H:mm:ss",
    "d.M.yyyy H:mm",
    "d.M.yyyy H:mm:ss",
    "d MMM yyyy H:mm",
    "d MMM yyyy H:mm:ss",
    "d-MMM-yyyy H:mm",
    "d-MMM-yyyy H:mm:ss",
    "MMM d, yyyy H:mm",
    "MMM d, yyyy H:mm:ss",
    "MMM d, yyyy h:mm a",
    "MMM d, yyyy h:mm:ss a",
]


# Those that may also end in an offset (Z, +00:00); the date and time are kept as written.
OFFSET_FORMATS = [f + "XXX" for f in DATE_FORMATS if f.startswith("yyyy-MM-dd") and ":ss" in f]
_OFFSET = "(?<=:[0-9][0-9]|[.][0-9][0-9][0-9]|[.][0-9][0-9][0-9][0-9][0-9][0-9])(Z|[+-][0-9][0-9]:?[0-9][0-9])$"

_ALL_FORMATS = [*DATE_FORMATS, *OFFSET_FORMATS]


def _moment(text: str, date_format: str) -> str:
    if date_format.endswith("XXX"):
        # A text without an offset is not of this format.
        bare = f"regexp_replace({text}, {literal(_OFFSET)}, '')"
        return f"CASE WHEN {bare} <> {text} THEN try_to_timestamp({bare}, {literal(date_format.removesuffix('XXX'))}) END"
    pattern = date_format.replace("MMM", "[MMMM][MMM]")
    return f"try_to_timestamp({text}, {literal(pattern)})"


def parse_date(c: str, date_format: str) -> str:
    return f"CAST({_moment(strip(c), date_format)} AS TIMESTAMP_NTZ)"


def guess_format(sample: str) -> str:
    """The first known format that reads ``sample``; NULL if none does."""
    cases = " ".join(
        f"WHEN {parse_date(sample, f)} IS NOT NULL THEN {literal(f)}" for f in _ALL_FORMATS
    )
    return f"CASE {cases} END"


def to_date(c: str, date_format: str, formats: list[str | None] | None = None) -> str:
    """Read ``c`` with its file's format; a file without one is read value by value.

    Every known format is a branch with a literal pattern: Spark builds its parser
    once, where a pattern from a column is looked up for every row.  ``formats`` are all
    that the files with a date have, if known: with fewer branches the code can be compiled.
    """
    text = strip(c)
    if formats is not None and None not in formats:
        cases = " ".join(f"WHEN {literal(f)} THEN {_moment(text, f)}" for f in sorted(formats))
        return f"CAST({f'CASE {date_format} {cases} END' if cases else 'NULL'} AS TIMESTAMP_NTZ)"
    branches = " ".join(f"WHEN {literal(f)} THEN {_moment(text, f)}" for f in _ALL_FORMATS)
    by_value = ", ".join(_moment(text, f) for f in _ALL_FORMATS)
    return (
        f"CAST(CASE WHEN {date_format} IS NULL THEN coalesce({by_value}) "
        f"ELSE CASE {date_format} {branches} ELSE try_to_timestamp({text}, {date_format}) END END AS TIMESTAMP_NTZ)"
    )


def parse_us_date(c: str) -> str:
    """``MM/dd/yyyy`` or NULL; two digits for month and day are read without a format, which takes longer."""
    iso = f"concat(substr({c}, 7, 4), '-', substr({c}, 1, 2), '-', substr({c}, 4, 2))"
    # No braces: the text may become part of a format string.
    plain = rf"{c} RLIKE r'^[0-9][0-9]/[0-9][0-9]/[0-9][0-9][0-9][0-9]\z'"
    return f"CASE WHEN {plain} THEN CAST(try_cast({iso} AS TIMESTAMP) AS TIMESTAMP_NTZ) ELSE {parse_date(c, 'M/d/yyyy')} END"


def month_start(c: str) -> str:
    return f"trunc({c}, 'month')"


def month_bucket(c: str) -> str:
    """``yyyy-MM``; sorts in time order as text."""
    return f"date_format(to_date({c}), 'yyyy-MM')"
