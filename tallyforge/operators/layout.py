"""From a file's own columns to typed line items.

Three layouts: the clean one, and two raw ones with formatted cells.  Which one
a file has is told by its header.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ..functions import (
    clean_currency,
    clean_percent,
    fill_zero,
    literal,
    normalise_discount,
    null_tokens,
    price_from_total,
    title_case,
    to_number,
    trim_text,
)
from ..schema import (
    BUSINESS_COLUMNS,
    HEADER_ALIASES,
    LINE_TOTAL_HEADERS,
    MISSING_COLUMNS,
    OPTIONAL_DEFAULTS,
    REQUIRED_COLUMNS,
    TEXT_COLUMNS,
    UNDERSCORE_HEADERS,
)
from .derive import ensure_order_id

CLEAN, UNDERSCORE, LINE_TOTAL = "clean", "underscore", "line_total"


class HeaderMap(NamedTuple):
    """Layout of a header, and which of its columns feeds which target."""

    layout: str
    columns: dict[str, int]
    repeated: list[str]


def detect_layout(header: list[str] | tuple[str, ...]) -> str:
    names = {h.strip().lower() for h in header}
    if names >= UNDERSCORE_HEADERS.keys():
        return UNDERSCORE
    if names >= LINE_TOTAL_HEADERS.keys():
        return LINE_TOTAL
    return CLEAN


def map_header(header: list[str] | tuple[str, ...]) -> HeaderMap:
    """Target column -> position.  Of two columns for one target the first wins."""
    layout = detect_layout(header)
    names = [h.strip().lower() for h in header]
    if layout == UNDERSCORE:
        target = {**UNDERSCORE_HEADERS, "order_id": "order_id"}.get
    elif layout == LINE_TOTAL:
        target = {**LINE_TOTAL_HEADERS, "order id": "order_id"}.get
    else:
        own = set(names)

        def target(name: str) -> str:
            alias = HEADER_ALIASES.get(name)
            return alias if alias and alias not in own else name

    columns: dict[str, int] = {}
    repeated = []
    for i, name in enumerate(names):
        to = target(name)
        if to in columns:
            repeated.append(to)
        elif to is not None:
            columns[to] = i
    return HeaderMap(layout, columns, repeated)


def missing_required(columns) -> list[str]:
    return [c for c in REQUIRED_COLUMNS if c not in columns]


def missing_message(file: str, missing: list[str]) -> str:
    """The message for a rejected file, from its template."""
    return MISSING_COLUMNS[len(missing) > 1].format(
        file=file,
        first=missing[0],
        missing=", ".join(missing),
        others=", ".join(missing[1:]),
        required=", ".join(REQUIRED_COLUMNS),
        optional=", ".join(OPTIONAL_DEFAULTS),
    )


#: Columns that a cell of a file can be meant for, in the order of ``positions``.
TARGETS = ("date", "order_id", "customer", "product", "category", "region", "quantity", "price", "discount", "profit", "sales_target", "sales")


def positions(mapping: HeaderMap) -> list[int]:
    """For each target the place of its column, -1 for none."""
    return [mapping.columns.get(t, -1) for t in TARGETS]


def absent_columns(mapping: HeaderMap) -> list[str]:
    """Optional columns that the header does not have."""
    return [c for c in OPTIONAL_DEFAULTS if c not in mapping.columns]


def to_line_items(raw: DataFrame, mapping: HeaderMap, cell) -> DataFrame:
    """Typed line items of rows that all have one header; ``cell(i)`` names the column at position i."""
    cells = [cell(i) if i >= 0 else "CAST(NULL AS STRING)" for i in positions(mapping)]
    return _typed(raw.selectExpr(
        "file_path", "block_start", "row_id", f"'{mapping.layout}' AS layout",
        f"array({', '.join(map(str, positions(mapping)))}) AS at",
        f"CAST(array({', '.join(map(literal, absent_columns(mapping)))}) AS ARRAY<STRING>) AS absent",
        *[f"{c} AS {_own(t)}" for t, c in zip(TARGETS, cells, strict=True)],
    ))


def cells_to_line_items(rows: DataFrame, facts: DataFrame, layouts: list[str] | None = None, at: list[int] | None = None) -> DataFrame:
    """Typed line items of ``file_path, block_start, row_id, cells``; ``facts`` has ``file_path, path, layout, at, absent`` of each file.

    ``at`` has the positions of the targets, so the plan does not grow with the headers.
    If all files have the same, pass it: the scan then parses only the cells meant.
    ``layouts`` are those that the files have, if known; the plan has the rules of these only.
    """

    def picked(rows: DataFrame, place) -> DataFrame:
        others = [c for c in rows.columns if c != "cells"]
        cells = [f"get(cells, {place(i)}) AS {_own(t)}" for i, t in enumerate(TARGETS)]
        return rows.selectExpr(*others, *cells).selectExpr(*others, *[f"{null_tokens(_own(t))} AS {_own(t)}" for t in TARGETS])

    if at is None:
        found = picked(rows.join(facts, "file_path"), lambda i: f"at[{i}]")
    else:
        found = picked(rows, lambda i: at[i]).join(facts, "file_path")
    return _typed(found.drop("file_path").withColumnRenamed("path", "file_path"), layouts)


def _own(target: str) -> str:
    return f"{target}_cell"


def _typed(raw: DataFrame, layouts: list[str] | None = None) -> DataFrame:
    """Line items of text cells by target; the date stays text until its format is known.

    The path is the file's identity; source_file, its last part, is for display.
    """
    rules = {CLEAN: _clean(), UNDERSCORE: _underscore(), LINE_TOTAL: _line_total()}
    rules = {layout: rule for layout, rule in rules.items() if layouts is None or layout in layouts}

    def value(column: str) -> str:
        cases = " ".join(f"WHEN '{layout}' THEN {rule[column]}" for layout, rule in rules.items() if column in rule)
        return f"CAST({f'CASE layout {cases} END' if cases else 'NULL'} AS {_type_of(column)})"

    return raw.selectExpr(
        f"{_own('date')} AS date_text",
        *[f"{value(c)} AS {c}" for c in BUSINESS_COLUMNS if c != "date"],
        f"{ensure_order_id(_own('order_id'), 'file_path', 'row_id')} AS order_id",
        f"{_own('order_id')} AS given_order_id",
        "layout",
        "element_at(split(file_path, '/'), -1) AS source_file",
        "file_path",
        "absent AS missing_optional",
        "block_start",
        "row_id",
    )


def _type_of(column: str) -> str:
    return "STRING" if column in TEXT_COLUMNS else "DOUBLE"


def _default(column: str) -> str:
    value = OPTIONAL_DEFAULTS[column]
    return "NULL" if value is None else literal(value) if isinstance(value, str) else repr(value)


def _clean() -> dict[str, str]:
    rules = {
        "customer": trim_text, "product": trim_text, "category": trim_text, "region": trim_text,
        "quantity": lambda c: fill_zero(to_number(c)),
        "price": lambda c: fill_zero(to_number(c)),
        "discount": lambda c: normalise_discount(fill_zero(to_number(c))),
        "profit": to_number,
        "sales_target": to_number,
    }

    def given_or_default(column: str) -> str:
        own = rules[column](_own(column))
        if column not in OPTIONAL_DEFAULTS:
            return own
        return f"(CASE WHEN at[{TARGETS.index(column)}] < 0 THEN {_default(column)} ELSE {own} END)"

    return {column: given_or_default(column) for column in rules}


def _raw_common() -> dict[str, str]:
    return {
        "customer": trim_text(_own("customer")),
        "product": trim_text(_own("product")),
        "category": title_case(_own("category")),
        "region": title_case(_own("region")),
        "quantity": fill_zero(to_number(_own("quantity"))),
        "profit": fill_zero(clean_currency(_own("profit"))),
    }


def _underscore() -> dict[str, str]:
    return _raw_common() | {
        "price": fill_zero(clean_currency(_own("price"))),
        "discount": fill_zero(clean_percent(_own("discount"))),
    }


def _line_total() -> dict[str, str]:
    discount = to_number(_own("discount"))
    price = price_from_total(clean_currency(_own("sales")), to_number(_own("quantity")), discount)
    return _raw_common() | {"price": price, "discount": fill_zero(discount)}
