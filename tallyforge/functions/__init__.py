"""Scalar functions as SQL text over column names.

Use them with ``F.expr`` or ``selectExpr``::

    df.withColumn("change", F.expr(pct_change("revenue", "prior_revenue")))

They are plain Spark SQL, so everything stays inside Catalyst; as text, a long
expression reaches the JVM in one call instead of one per operator.
"""

from .dates import guess_format, month_bucket, month_start, parse_date, parse_us_date, to_date
from .formats import bar_length, fmt_delta, fmt_money, fmt_num, fmt_pct
from .numbers import (
    clean_currency,
    clean_percent,
    discount_percent,
    fill_zero,
    normalise_discount,
    pct_change,
    price_from_total,
    round_half_even,
    safe_ratio,
    to_number,
)
from .rules import band_label, band_order, discount_band, loss_flag, margin_risk
from .text import label_text, literal, null_tokens, strip, title_case, trim_text

__all__ = [name for name in dir() if not name.startswith("_")]
