"""Calendar months: which ones there are, the current and the prior one."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame

from ..functions import month_start


def distinct_periods(rows: DataFrame) -> DataFrame:
    """The months present, newest first.

    Groups on the month's first day (plain arithmetic per row) and formats the
    few results; a table partitioned by ``period`` groups on that column.
    """
    stored = "period" in rows.columns
    month = "period" if stored else month_start("date")
    label = "month" if stored else "date_format(month, 'yyyy-MM')"
    return rows.sparkSession.sql(
        f"""
        SELECT {label} AS period
        FROM (SELECT DISTINCT {month} AS month FROM {{rows}})
        WHERE month IS NOT NULL
        ORDER BY period DESC
        """,
        rows=rows,
    )


def latest_two(rows: DataFrame) -> tuple[str | None, str | None]:
    """(current, prior): the two newest months present, not calendar neighbours.

    Two short strings reach the driver, so that they can be literals in the
    filters of the plans that follow and be pushed into their scans.
    """
    found = [r["period"] for r in distinct_periods(rows).limit(2).collect()]
    return tuple(found + [None] * (2 - len(found)))


def stored_periods(table: DataFrame) -> list[str]:
    """The months of a table that is stored by ``period``, newest first, from the names of its directories.

    ``table`` is the table as it was read: filters of rows do not count.  No file is
    opened; the paths are those Spark listed when it read the table.
    """
    months = {unquote(m.group(1)) for m in map(re.compile("/period=([^/]*)/").search, table.inputFiles()) if m}
    return sorted(months - {"__HIVE_DEFAULT_PARTITION__"}, reverse=True)


def latest_two_stored(table: DataFrame) -> tuple[str | None, str | None]:
    """``latest_two`` of a table stored by month, without a scan."""
    found = stored_periods(table)[:2]
    return tuple(found + [None] * (2 - len(found)))


def is_period(period: str | None, date: str = "date") -> str:
    """True for the rows of a month, written as a range the scan can use."""
    if period is None:
        return "false"
    year, month = map(int, period.split("-"))
    following = f"{year + month // 12:04}-{month % 12 + 1:02}-01"
    return f"({date} >= TIMESTAMP_NTZ'{period}-01' AND {date} < TIMESTAMP_NTZ'{following}')"


def in_periods(rows: DataFrame, *periods: str | None) -> DataFrame:
    """The rows of some months."""
    wanted = [p for p in periods if p]
    kept = rows.where(" OR ".join(map(is_period, wanted)) or "false")
    if not wanted or "period" not in rows.columns:
        return kept
    # Also name the months, for the directories of a table partitioned by them.
    return kept.where(f"period IN ({', '.join(repr(p) for p in wanted)})")


def in_period(rows: DataFrame, period: str | None) -> DataFrame:
    return in_periods(rows, period)
