"""Number parsing and ratio arithmetic, as SQL text."""

from __future__ import annotations

from .text import strip

# A number short enough to be finite, and any decimal number.
_PLAIN = r"^[+-]?(\d{1,100}\.?\d{0,100}|\.\d{1,100})([eE][+-]?\d{1,2})?$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_BARE = _PLAIN.removesuffix("$") + r"\z"


def to_number(c: str) -> str:
    """A finite decimal number, or NULL.

    The patterns keep out what a cast would accept beyond that: ``1d``, ``nan``,
    ``Infinity`` and hexadecimal floats.  Only a number of unusual length is
    also checked for overflow; only a cell that is no plain number as it stands is stripped.
    """
    text = strip(c)
    long = f"nullif(nullif(try_cast({text} AS DOUBLE), double('Infinity')), double('-Infinity'))"
    return (
        f"CASE WHEN {c} RLIKE r'{_BARE}' THEN try_cast({c} AS DOUBLE) WHEN {text} RLIKE r'{_PLAIN}' THEN try_cast({text} AS DOUBLE) "
        f"WHEN {text} RLIKE r'{_NUMBER}' THEN {long} END"
    )


def clean_currency(c: str) -> str:
    """``--$3,600.00`` -> -3600.0: a leading double dash is a minus sign."""
    text = strip(c)
    return to_number(f"translate(CASE WHEN startswith({text}, '--') THEN substr({text}, 2) ELSE {text} END, '$,', '')")


def clean_percent(c: str) -> str:
    """``10%`` -> 0.10; the division happens with or without the sign."""
    number = to_number(f"replace({strip(c)}, '%')")
    return f"({number}) / 100D"


def fill_zero(c: str) -> str:
    return f"coalesce({c}, 0D)"


def normalise_discount(c: str) -> str:
    """A discount above 1 was typed as a percentage."""
    return f"CASE WHEN {c} > 1 THEN {_nested(c)} / 100D ELSE {c} END"


def safe_ratio(numerator: str, denominator: str) -> str:
    """NULL instead of an error where the denominator is zero."""
    return f"({_nested(numerator)} / nullif({denominator}, 0D))"


def pct_change(current: str, prior: str) -> str:
    return f"{safe_ratio(f'{_nested(current)} - {_nested(prior)}', f'abs({prior})')} * 100"


def price_from_total(total: str, quantity: str, discount: str) -> str:
    """Unit price behind a line total; 0 where it cannot be told."""
    return fill_zero(safe_ratio(total, f"{_nested(quantity)} * (1 - {_nested(discount)})"))


def round_half_even(c: str, digits: int) -> str:
    scale = f"{10**digits}D"
    return f"rint({_nested(c)} * {scale}) / {scale}"


def discount_percent(rate: str) -> str:
    """0.125 -> 12.5, one decimal."""
    return round_half_even(f"{_nested(rate)} * 100", 1)


def _nested(c: str) -> str:
    return c if c.replace("_", "").isalnum() else f"({c})"
