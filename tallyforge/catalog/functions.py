"""Queries of the scalar functions, each over a whole table."""

from __future__ import annotations

from .. import functions as fn
from ..functions.text import WHITESPACE
from ..operators.labels import dq_flag
from ..operators.quality import flagged, usable
from ..sources.exports import with_dates
from ..sources.star import star_items, table
from .base import counted, exports_sql, query, items_sql
from .quality import _accepted, kept_rows


def _totals(rows, value: str, by: str = "l_linenumber", digits: int = 2):
    """Count, number of values and sum of a derived column."""
    derived = rows.selectExpr(by, f"{value} AS v")
    return counted(derived, by, "count(v) AS present", "sum(v) AS total", total=digits)


def _totals_sql(value: str, by: str = "l_linenumber", digits: int = 2, relation: str = "lineitem") -> str:
    return (
        f"SELECT {by}, count(*) AS n, count(v) AS present, round(sum(v), {digits}) AS total "
        f"FROM (SELECT {by}, {value} AS v FROM {relation}) GROUP BY {by}"
    )


def _over_lines(name: str, text: str, render, sql: str, digits: int = 2, by: str = "l_linenumber"):
    """A number function over a text or number built from every line item."""
    query(name, _totals_sql(sql, by, digits))(
        lambda spark, d: _totals(
            table(spark, d, "lineitem").selectExpr("*", f"{text} AS given"), render("given"), by, digits
        )
    )


# -------------------------------------------------------------- numbers

_over_lines(
    "clean_currency",
    """CASE WHEN l_tax = 0D THEN 'n/a'
       ELSE concat(CASE WHEN l_returnflag = 'R' THEN ' --$' ELSE ' $' END, format_number(l_extendedprice, 2)) END""",
    fn.clean_currency,
    "CASE WHEN l_tax = 0 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END",
)
_over_lines(
    "clean_percent",
    "concat(int(rint(l_tax * 100)), CASE WHEN l_returnflag = 'R' THEN '.1' ELSE '% ' END)",
    fn.clean_percent,
    "l_tax + CASE WHEN l_returnflag = 'R' THEN CAST(0.001 AS DOUBLE) ELSE 0 END",
    digits=4,
)
_over_lines(
    "to_number",
    """CASE l_linenumber WHEN 1 THEN concat(int(l_quantity), 'd') WHEN 2 THEN 'nan'
       WHEN 3 THEN concat('\\t', int(l_quantity), '.5 ') WHEN 4 THEN concat(int(l_quantity), 'e3')
       WHEN 5 THEN concat('$', int(l_quantity)) WHEN 6 THEN concat('-', int(l_quantity))
       ELSE concat('+', int(l_quantity)) END""",
    fn.to_number,
    """CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN l_quantity + 0.5 WHEN 4 THEN l_quantity * 1000
       WHEN 5 THEN NULL WHEN 6 THEN -l_quantity ELSE l_quantity END""",
)
_over_lines(
    "normalise_discount",
    "CASE WHEN l_returnflag = 'A' AND l_discount > 0.01D THEN l_discount * 100 ELSE l_discount END",
    fn.normalise_discount,
    "CASE WHEN l_returnflag = 'A' AND l_discount > 0.01 THEN l_discount * 100 / 100 ELSE l_discount END",
)
query("derive_price_from_sales", _totals_sql(
    "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 0 ELSE l_extendedprice / l_quantity END", by="l_linestatus"
))(
    lambda spark, d: _totals(
        table(spark, d, "lineitem"),
        fn.price_from_total(
            "l_extendedprice * (1 - l_discount)",
            "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 0D ELSE l_quantity END",
            "l_discount",
        ),
        by="l_linestatus",
    )
)

query("fill_zero", items_sql(_totals_sql("coalesce(profit, 0)", by="category", relation="items")))(
    lambda spark, d: _totals(
        star_items(spark, d, "category", "profit", labels=False), fn.fill_zero("profit"), by="category"
    )
)


@query("pct_change", """
    SELECT p_name, round((a - r) / abs(nullif(r, 0)) * 100, 6) AS change FROM (
      SELECT p_name, sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS a, sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS r
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1)
""")
def pct_change(spark, d):
    rows = star_items(spark, d, "product", "quantity", "return_flag", labels=False)
    return spark.sql(
        f"""
        SELECT p_name, round({fn.pct_change("a", "r")}, 6) AS change
        FROM (SELECT product AS p_name, sum(CASE WHEN return_flag = 'A' THEN quantity END) AS a,
                     sum(CASE WHEN return_flag = 'R' THEN quantity END) AS r FROM {{rows}} GROUP BY product)
        """,
        rows=rows,
    )


query("safe_ratio", """
    SELECT l_suppkey, round(sum(l_tax) / nullif(sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END), 0), 6) AS ratio
    FROM lineitem GROUP BY 1
""")(
    lambda spark, d: spark.sql(
        f"""
        SELECT l_suppkey, round({fn.safe_ratio("t", "q")}, 6) AS ratio
        FROM (SELECT l_suppkey, sum(l_tax) AS t, sum(CASE WHEN l_discount > 0.05D THEN l_quantity ELSE 0D END) AS q
              FROM {{lines}} GROUP BY l_suppkey)
        """,
        lines=table(spark, d, "lineitem"),
    )
)

query("discount_pct", """
    SELECT round_even(l_discount / 8 * 100 * 10, 0) / 10 AS "Discount %", count(*) AS n FROM lineitem GROUP BY 1
""")(lambda spark, d: counted(table(spark, d, "lineitem"), f"{fn.discount_percent('l_discount / 8')} AS `Discount %`"))


# ---------------------------------------------------------------- rules

query("discount_band", items_sql("SELECT band, band_ord, count(*) AS n FROM x GROUP BY 1, 2"))(
    lambda spark, d: spark.sql(
        f"""
        SELECT {fn.discount_band("discount")} AS band, {fn.band_order("discount")} AS band_ord, count(*) AS n
        FROM {{rows}} GROUP BY 1, 2
        """,
        rows=star_items(spark, d, "discount", labels=False),
    )
)


@query("margin_risk", items_sql("""
    SELECT order_id, coalesce(round(avg(discount), 9) >= CAST(0.15 AS DOUBLE)
             AND sum(profit) / nullif(sum(rev), 0) < CAST(0.10 AS DOUBLE), false) AS margin_risk
    FROM x GROUP BY order_id
"""))
def margin_risk(spark, d):
    # Rounded, as a mean of exactly 0.15 may come out a rounding error above or below it.
    return spark.sql(
        f"""
        SELECT order_id, {fn.margin_risk("mean", fn.safe_ratio("profit", "revenue"))} AS margin_risk
        FROM (SELECT order_id, round(avg(discount), 9) AS mean, sum(profit) AS profit,
                     sum(quantity * price * (1 - discount)) AS revenue FROM {{rows}} GROUP BY order_id)
        """,
        rows=star_items(spark, d, "order_id", "quantity", "price", "discount", "profit", labels=False),
    )


query("loss_flag", items_sql("SELECT product, coalesce(profit < 0, false) AS loss_flag, count(*) AS n FROM items GROUP BY 1, 2"))(
    lambda spark, d: spark.sql(
        f"SELECT product, {fn.loss_flag('profit')} AS loss_flag, count(*) AS n FROM {{rows}} GROUP BY 1, 2",
        rows=star_items(spark, d, "product", "profit", labels=False),
    )
)


query("dq_label_text", exports_sql("""
    SELECT CASE label WHEN 'flagged:invalid_region' THEN 'missing region' WHEN 'flagged:invalid_category' THEN 'missing category'
             WHEN 'flagged:invalid_customer' THEN 'missing customer' WHEN 'flagged:negative_profit' THEN 'negative profit on this row'
             WHEN 'clamped:discount' THEN 'discount was out of the valid 0-100% range and was corrected' END AS label_text, count(*) AS n
    FROM (SELECT unnest(string_split(row_flag, ';')) AS label FROM labelled WHERE row_flag IS NOT NULL) GROUP BY 1
"""))(
    lambda spark, d: counted(
        kept_rows(spark, d).selectExpr("explode(dq) AS label"), f"{fn.label_text('label')} AS label_text"
    )
)

query("row_labels", exports_sql("SELECT row_flag AS dq_flag, count(*) AS n FROM labelled GROUP BY 1"))(
    lambda spark, d: counted(flagged(usable(_accepted(spark, d))), f"{dq_flag('dq')} AS dq_flag")
)


# ----------------------------------------------------------------- text

_NAMES = "SELECT p_partkey, lower(p_name || ' o''' || p_brand || '-' || p_type || ' 3rd') AS s FROM part"


query("title_case", f"""
    SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(s, '[a-z]+|[^a-z]+'),
           lambda w: upper(w[1]) || substr(w, 2)), '') AS title FROM ({_NAMES})
""")(
    lambda spark, d: table(spark, d, "part")
    .selectExpr("p_partkey", "lower(concat(p_name, ' o\\'', p_brand, '-', p_type, ' 3rd')) AS s")
    .selectExpr("p_partkey", f"{fn.title_case('s')} AS title")
)

_SPACES = fn.literal(WHITESPACE)
_PADDED = f"CASE WHEN c_mktsegment <> 'BUILDING' THEN concat({_SPACES}, c_name, {_SPACES}) END"

query("trim_text", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS trimmed FROM customer")(
    lambda spark, d: table(spark, d, "customer").selectExpr(
        "c_custkey", f"{fn.trim_text(_PADDED)} AS trimmed"
    )
)

query("null_tokens", """
    SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS present
    FROM customer GROUP BY 1
""")(
    lambda spark, d: counted(
        table(spark, d, "customer").selectExpr(
            "c_mktsegment", "CASE c_mktsegment WHEN 'BUILDING' THEN 'n/a' WHEN 'MACHINERY' THEN '#N/A' ELSE c_name END AS given"
        ),
        "c_mktsegment", f"count({fn.null_tokens('given')}) AS present",
    )
)


# ---------------------------------------------------------------- dates

@query("to_date", """
    SELECT l_returnflag || (l_orderkey % 2) AS source_file, count(*) AS n, count(*) FILTER (WHERE l_linenumber <> 7) AS parsed,
           min(l_shipdate) FILTER (WHERE l_linenumber <> 7) AS first_day, max(l_shipdate) FILTER (WHERE l_linenumber <> 7) AS last_day
    FROM lineitem GROUP BY 1
""")
def to_date(spark, d):
    # The sample of a file is its first readable value: the undated rows come last here.
    formats = {
        "A0": "yyyy-MM-dd", "A1": "yyyy-MM-dd'T'HH:mm:ss'Z'", "N0": "d-MMM-yyyy", "N1": "yyyy-MM-dd'T'HH:mm:ss'+00:00'",
        "R0": "yyyy/M/d", "R1": "yyyy-MM-dd HH:mm:ss.SSS'+02:00'",
    }
    cases = " ".join(f"WHEN '{file}' THEN date_format(l_shipdate, {fn.literal(pattern)})" for file, pattern in formats.items())
    rows = table(spark, d, "lineitem").selectExpr("*", "concat(l_returnflag, l_orderkey % 2) AS file_path").selectExpr(
        "file_path",
        "file_path AS source_file",
        f"CASE WHEN l_linenumber = 7 THEN '20260102' ELSE CASE file_path {cases} END END AS date_text",
        "l_linenumber AS block_start",
        "monotonically_increasing_id() AS row_id",
    )
    return counted(
        with_dates(rows), "source_file", "count(date) AS parsed", "min(date) AS first_day", "max(date) AS last_day"
    )


_TIMED = {
    "A0": "yyyy/M/d H:mm", "A1": "MMM d, yyyy h:mm a", "N0": "MMMM d, yyyy h:mm:ss a", "N1": "d MMM yyyy H:mm:ss",
    "R0": "d.M.yyyy H:mm", "R1": "d-MMM-yyyy H:mm:ss",
}


@query("to_date_with_time", """
    SELECT l_returnflag || (l_orderkey % 2) AS source_file, count(*) AS n, count(*) AS parsed,
           min(CAST(l_shipdate AS TIMESTAMP) + INTERVAL 785 MINUTE) AS first_moment, max(CAST(l_shipdate AS TIMESTAMP) + INTERVAL 785 MINUTE) AS last_moment
    FROM lineitem GROUP BY 1
""")
def to_date_with_time(spark, d):
    """Month names and slashes with a time of day, a format for each file."""
    cases = " ".join(f"WHEN '{file}' THEN date_format(at, {fn.literal(pattern)})" for file, pattern in _TIMED.items())
    rows = table(spark, d, "lineitem").selectExpr(
        "concat(l_returnflag, l_orderkey % 2) AS file_path", "CAST(l_shipdate AS TIMESTAMP_NTZ) + INTERVAL 785 MINUTE AS at"
    ).selectExpr("file_path", "file_path AS source_file", f"CASE file_path {cases} END AS date_text", "0L AS block_start", "monotonically_increasing_id() AS row_id")
    return counted(with_dates(rows), "source_file", "count(date) AS parsed", "min(date) AS first_moment", "max(date) AS last_moment")


query("parse_us_date", """
    SELECT strftime(l_shipdate, '%Y') AS year, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R' OR day(l_shipdate) <= 12) AS parsed
    FROM lineitem GROUP BY 1
""")(
    lambda spark, d: counted(
        table(spark, d, "lineitem").selectExpr(
            "date_format(l_shipdate, 'yyyy') AS year",
            "CASE WHEN l_returnflag = 'R' THEN date_format(l_shipdate, 'dd/MM/yyyy') ELSE date_format(l_shipdate, 'MM/dd/yyyy') END AS given",
        ),
        "year", f"count({fn.parse_us_date('given')}) AS parsed",
    )
)

query("month_bucket", "SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1")(
    lambda spark, d: counted(table(spark, d, "orders"), f"{fn.month_bucket('o_orderdate')} AS period")
)


# -------------------------------------------------------------- formats

def _format_query(name: str, render, sql: str):
    """A formatter over every account balance."""
    query(name, f"""
        SELECT c_custkey, {sql} AS shown FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS v FROM customer)
    """)(
        lambda spark, d: table(spark, d, "customer")
        .selectExpr("c_custkey", "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS v")
        .selectExpr("c_custkey", f"{render('v')} AS shown")
    )


_format_query("fmt_money", fn.fmt_money, "coalesce(format('${:,.0f}', v), 'n/a')")
_format_query("fmt_pct", fn.fmt_pct, "coalesce(format('{:+.1f}%', v), 'n/a')")
_format_query("fmt_num", fn.fmt_num, "coalesce(format('{:,.0f}', v), 'n/a')")
_format_query(
    "fmt_delta", fn.fmt_delta,
    "coalesce(CASE WHEN v >= 0 THEN '▲ ' ELSE '▼ ' END || format('{:.1f}%', abs(v)), 'n/a')",
)
