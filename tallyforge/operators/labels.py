"""Quality labels of a row, an array in rule order.  All functions give SQL text."""

from __future__ import annotations

from ..functions import literal
from ..schema import LABEL_TEXT

NO_LABELS = "CAST(array() AS ARRAY<STRING>)"


def append_label(labels: str, condition: str, label: str) -> str:
    """Add a label where the condition holds, once."""
    return f"CASE WHEN {condition} THEN array_union({labels}, array({literal(label)})) ELSE {labels} END"


def dq_flag(labels: str) -> str:
    """``a;b`` for the edge of the system; NULL for a clean row."""
    return f"nullif(array_join({labels}, ';'), '')"


def note_counts(condition: str = "true") -> list[str]:
    """Aggregates behind a group's note: tagged rows, and rows per label."""
    per_label = [
        f"count_if({condition} AND array_contains(dq, {literal(label)})) AS `n_{label}`"
        for label in sorted(LABEL_TEXT)
    ]
    return [f"count_if({condition} AND size(dq) > 0) AS n_tagged", *per_label]


def note() -> str:
    """``3 rows affected: missing region (2), duplicate row (1)``; NULL if none."""
    parts = [
        f"CASE WHEN `n_{label}` > 0 THEN concat({literal(LABEL_TEXT[label])}, ' (', `n_{label}`, ')') END"
        for label in sorted(LABEL_TEXT)
    ]
    word = "CASE WHEN n_tagged = 1 THEN ' row' ELSE ' rows' END"
    return (
        f"CASE WHEN n_tagged > 0 THEN concat(n_tagged, {word}, ' affected: ', "
        f"concat_ws(', ', {', '.join(parts)})) END"
    )
