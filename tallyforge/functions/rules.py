"""Business rules, as SQL text."""

from __future__ import annotations

from ..schema import DISCOUNT_BANDS, HIGH_DISCOUNT, LOW_MARGIN
from .text import literal


def _by_band(discount: str, values: list[str]) -> str:
    """CASE over the band bounds; a missing discount falls in the first band."""
    bounds = [upper for upper, _ in DISCOUNT_BANDS]
    cases = [f"WHEN {discount} IS NULL THEN {values[0]}"]
    cases += [f"WHEN {discount} <= {upper!r}D THEN {value}" for upper, value in zip(bounds[:-1], values)]
    return f"CASE {' '.join(cases)} ELSE {values[-1]} END"


def band_order(discount: str) -> str:
    return _by_band(discount, [str(i) for i in range(len(DISCOUNT_BANDS))])


def discount_band(discount: str) -> str:
    return _by_band(discount, [literal(label) for _, label in DISCOUNT_BANDS])


def band_label(order: str) -> str:
    """Label of a band number; lets a group-by carry the small number only."""
    return f"element_at(array({', '.join(literal(label) for _, label in DISCOUNT_BANDS)}), {order} + 1)"


def margin_risk(avg_discount: str, margin: str) -> str:
    """Big discount on a thin margin; an unknown margin is no risk."""
    return f"coalesce({avg_discount} >= {HIGH_DISCOUNT!r}D AND {margin} < {LOW_MARGIN!r}D, false)"


def loss_flag(profit: str) -> str:
    return f"coalesce({profit} < 0, false)"
