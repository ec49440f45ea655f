"""Quoted cells in lines of delimited text, as SQL text over a line and its delimiter.

A quote opens a cell only where a cell begins; within a quoted cell two quotes stand
for one; a quote anywhere else is a character like others.  All patterns are
possessive, so that Java matches them without recursion however long the line is.
"""

from __future__ import annotations

import re

from ..functions import literal

# Delimiters that may separate the cells, by preference.
DELIMITERS = [",", ";", "\t", "|"]

_INSIDE = '[^"]*+(?:""[^"]*+)*+'


def _patterns(delimiter: str) -> tuple[str, str, str]:
    d, other = re.escape(delimiter), f"[^{delimiter}]"
    cell = f'(?:"{_INSIDE}"{other}*+|[^"{delimiter}]{other}*+)?+'
    left_open = f'^(?:{cell}{d})*+"{_INSIDE}\\z'
    rest_of_open = f'^{_INSIDE}"{other}*+'
    quoted_cell = f'(^|{d})"{_INSIDE}"'
    return left_open, rest_of_open, quoted_cell


def opens(line: str, delimiter: str) -> str:
    """Whether a line that begins outside quotes ends inside."""
    left_open = _patterns(delimiter)[0]
    return f"(contains({line}, '\"') AND {line} RLIKE {literal(left_open)})"


def stays_open(line: str, delimiter: str) -> str:
    """Whether a line that begins inside quotes ends inside."""
    _, rest, _ = _patterns(delimiter)
    after = f"regexp_replace({line}, {literal(rest)}, '')"
    return f"(NOT {line} RLIKE {literal(rest)} OR {opens(after, delimiter)})"


def cells_in(line: str, delimiter: str) -> str:
    """How many cells a whole record has."""
    bare = f"CASE WHEN contains({line}, '\"') THEN regexp_replace({line}, {literal(_patterns(delimiter)[2])}, '$1') ELSE {line} END"
    return f"(octet_length({bare}) - octet_length(replace({bare}, {literal(delimiter)})) + 1)"


def by_delimiter(expression, column: str = "delimiter") -> str:
    """``expression(d)`` for the delimiter that a column names."""
    cases = " ".join(f"WHEN {literal(d)} THEN {expression(d)}" for d in DELIMITERS)
    return f"CASE {column} {cases} END"
