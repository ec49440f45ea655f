"""Text clean-up.  Every function takes and gives SQL text for ``F.expr`` or ``selectExpr``."""

from __future__ import annotations

from ..schema import LABEL_TEXT, NA_TOKENS

# Every character Unicode counts as white space, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
)
_LONGEST_TOKEN = max(len(t.encode()) for t in NA_TOKENS)
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def literal(text: str) -> str:
    """A SQL string literal."""
    plain = text.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() else f"\\u{ord(c):04x}" for c in plain) + "'"


def strip(c: str) -> str:
    """Strip all Unicode white space from both ends; NULL stays NULL."""
    return f"btrim({c}, {literal(WHITESPACE)})"


def trim_text(c: str) -> str:
    """Missing text becomes ``''``, the rest is stripped."""
    return strip(f"coalesce({c}, '')")


def null_tokens(c: str) -> str:
    """NULL for the cells that stand for a missing value (``NA``, ``n/a``, ...); longer cells are not looked up."""
    return f"CASE WHEN octet_length({c}) > {_LONGEST_TOKEN} OR {c} NOT IN ({', '.join(map(literal, NA_TOKENS))}) THEN {c} END"


def title_case(c: str) -> str:
    """Capitalise every run of letters: ``o'brien 3rd`` -> ``O'Brien 3Rd``; words of A to Z need no list of runs."""
    runs = f"regexp_extract_all({trim_text(c)}, r'([{_CASED}]+|[^{_CASED}]+)', 1)"
    plain = rf"{c} RLIKE r'^[A-Za-z]+( [A-Za-z]+)*+\z'"
    return f"CASE WHEN {plain} THEN initcap({c}) ELSE array_join(transform({runs}, word -> initcap(word)), '') END"


def label_text(label: str) -> str:
    """Plain words for a quality label; an unknown label is kept as it is."""
    cases = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in LABEL_TEXT.items())
    return f"CASE {label} {cases} ELSE {label} END"
