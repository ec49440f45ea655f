"""Queries of the monthly review."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..operators import flat, summaries as S
from ..operators.derive import with_measures
from ..operators.flags import (
    flag_counts,
    flag_lines,
    flag_rows,
    generate_flags,
    summary_bullets,
    summary_facts,
)
from ..operators.kpis import kpi_rows, kpis
from ..operators.labels import note, note_counts
from ..operators.periods import distinct_periods, in_period, latest_two
from ..functions import bar_length
from ..schema import KPI_NAMES
from ..sources.star import star_items
from .base import counted, exports_sql, money, periods, query, rate, rounded, items_sql

_MEASURES = ("date", "quantity", "price", "discount", "profit")

# ------------------------------------------------------------- periods

query("periods_present", items_sql(
    "SELECT DISTINCT strftime(date, '%Y-%m') AS period FROM items"
))(lambda spark, d: distinct_periods(star_items(spark, d, "date", labels=False)))

query("latest_two_periods", items_sql(
    "SELECT strftime(c, '%Y-%m') AS period, 'current' AS role FROM cur "
    "UNION ALL SELECT strftime(p, '%Y-%m'), 'prior' FROM pri"
))(lambda spark, d: _roles(spark, d))


def _roles(spark, d):
    newest = distinct_periods(star_items(spark, d, "date", labels=False)).limit(2)
    return spark.sql(
        "SELECT period, CASE WHEN period = (SELECT max(period) FROM {t}) THEN 'current' ELSE 'prior' END AS role FROM {t}",
        t=newest,
    )


def _period_query(name: str, condition: str, which: int):
    @query(name, items_sql(
        f"SELECT region, count(*) AS line_items, round(sum(rev), 2) AS revenue FROM x WHERE {condition} GROUP BY region"
    ))
    def run(spark, d):
        rows = in_period(star_items(spark, d, "date", "region", "quantity", "price", "discount"), periods(spark, d)[which])
        table = counted(rows, "region", f"sum({S.REVENUE}) AS revenue", **money("revenue"))
        return table.withColumnRenamed("n", "line_items")


_period_query("filter_current_period", "is_cur", 0)
_period_query("filter_prior_period", "is_pri", 1)


# ----------------------------------------------------- grouped summaries

def _summary_sql(by: str) -> str:
    return f"""
    SELECT {by}, round(revenue, 2) AS revenue, round(profit, 2) AS profit, quantity,
           round(avg_discount, 6) AS avg_discount, round(prior_revenue, 2) AS prior_revenue,
           round(profit / nullif(revenue, 0), 6) AS margin,
           round((revenue - prior_revenue) / abs(nullif(prior_revenue, 0)) * 100, 6) AS pct_change, dq_note
    FROM (
      SELECT {by}, sum(rev) AS revenue, sum(profit) AS profit, sum(quantity) AS quantity, avg(discount) AS avg_discount,
             CASE WHEN count(*) FILTER (WHERE profit < 0) > 0 THEN
               concat(count(*) FILTER (WHERE profit < 0), CASE WHEN count(*) FILTER (WHERE profit < 0) = 1 THEN ' row' ELSE ' rows' END,
                      ' affected: negative profit on this row (', count(*) FILTER (WHERE profit < 0), ')') END AS dq_note
      FROM x WHERE is_cur AND {by} IS NOT NULL GROUP BY {by}
    ) LEFT JOIN (SELECT {by}, sum(rev) AS prior_revenue FROM x WHERE is_pri GROUP BY {by}) USING ({by})
    """


_SUMMARY_ROUNDS = money("revenue", "profit", "prior_revenue") | rate("avg_discount", "margin", "pct_change")


def _summary(name: str, by: str, table):
    query(name, items_sql(_summary_sql(by)))(
        lambda spark, d: rounded(
            table(star_items(spark, d, *_MEASURES, by), *periods(spark, d)), **_SUMMARY_ROUNDS
        )
    )


_summary("category_summary", "category", S.category_summary)
_summary("region_summary", "region", S.region_summary)
_summary("product_summary", "product", S.product_summary)


@query("dimension_summaries", items_sql(
    " UNION ALL ".join(
        f"SELECT '{by}' AS dimension, {by} AS name, * EXCLUDE ({by}) FROM ({_summary_sql(by)})"
        for by in ("category", "region", "product")
    )
))
def dimension_summaries(spark, d):
    rows = star_items(spark, d, *_MEASURES, *S.DIMENSIONS)
    table = S.dimension_summaries(rows, *periods(spark, d)).where(F.col("dimension") != "all")
    return rounded(table, **_SUMMARY_ROUNDS)


@query("current_prior_join", items_sql("""
    SELECT product, round(c.revenue, 2) AS revenue, round(p.revenue, 2) AS prior_revenue
    FROM (SELECT product, sum(rev) AS revenue FROM x WHERE is_cur GROUP BY product) c
    LEFT JOIN (SELECT product, sum(rev) AS revenue FROM x WHERE is_pri GROUP BY product) p USING (product)
"""))
def current_prior_join(spark, d):
    table = S.product_summary(star_items(spark, d, *_MEASURES, "product"), *periods(spark, d))
    return rounded(table.select("product", "revenue", "prior_revenue"), **money("revenue", "prior_revenue"))


def _discounts(name: str, by: str, table_of=lambda t, by: t, extra: str = "", tail: str = "", top_n=None):
    @query(name, items_sql(f"""
        SELECT {by}, round(avg_discount, 6) AS avg_discount, round(revenue, 2) AS revenue, round(profit, 2) AS profit,
               round(profit / nullif(revenue, 0), 6) AS margin,
               coalesce(avg_discount >= CAST(0.15 AS DOUBLE) AND profit / nullif(revenue, 0) < CAST(0.10 AS DOUBLE), false) AS margin_risk{extra}
        FROM (SELECT {by}, avg(discount) AS avg_discount, sum(rev) AS revenue, sum(profit) AS profit
              FROM x WHERE is_cur GROUP BY {by}) {tail}
    """))
    def run(spark, d):
        rows = star_items(spark, d, *_MEASURES, by)
        table = S.discount_analysis(rows, by, periods(spark, d)[0], top_n).drop("dq_note")
        return rounded(table_of(table, by), **money("revenue", "profit"), **rate("avg_discount", "margin"))


_discounts("discounts_by_product", "product")
_discounts("discounts_by_category", "category")
_discounts("top_n", "product", tail="ORDER BY avg_discount DESC, product LIMIT 10", top_n=10)
_discounts(
    "top10_marker", "product", S.with_top_marker,
    extra=", row_number() OVER (ORDER BY avg_discount DESC, product) <= 10 AS in_top",
)


@query("discount_bands", items_sql("""
    SELECT band, count(DISTINCT order_id) AS orders, round(sum(gross), 2) AS gross_sales,
           round(sum(disc), 2) AS discount_amount, round(sum(rev), 2) AS revenue, round(sum(profit), 2) AS profit,
           round(sum(profit) / nullif(sum(rev), 0), 6) AS margin,
           round(sum(rev) / count(DISTINCT order_id), 6) AS avg_order_value
    FROM x WHERE is_cur GROUP BY band
"""))
def discount_bands(spark, d):
    table = S.discount_bands(star_items(spark, d, *_MEASURES, "order_id"), periods(spark, d)[0])
    return rounded(
        table, **money("gross_sales", "discount_amount", "revenue", "profit"), **rate("margin", "avg_order_value")
    )


@query("discount_bands_by_product", items_sql("""
    SELECT band, product, round(avg(discount), 6) AS avg_discount, round(sum(rev), 2) AS revenue,
           round(sum(profit), 2) AS profit, round(sum(profit) / nullif(sum(rev), 0), 6) AS margin,
           coalesce(avg(discount) >= CAST(0.15 AS DOUBLE) AND sum(profit) / nullif(sum(rev), 0) < CAST(0.10 AS DOUBLE), false) AS margin_risk
    FROM x WHERE is_cur GROUP BY band, product
"""))
def discount_bands_by_product(spark, d):
    table = S.discount_bands_by_product(star_items(spark, d, *_MEASURES, "product"), periods(spark, d)[0])
    return rounded(table, **money("revenue", "profit"), **rate("avg_discount", "margin"))


@query("monthly_summary", items_sql("""
    SELECT strftime(date, '%Y-%m') AS period, round(sum(rev), 2) AS revenue, round(sum(profit), 2) AS profit,
           round(sum(profit) / nullif(sum(rev), 0), 6) AS margin FROM x GROUP BY 1
"""))
def monthly_summary(spark, d):
    table = S.monthly_summary(star_items(spark, d, *_MEASURES, labels=False))
    return rounded(table, **money("revenue", "profit"), **rate("margin"))


# --------------------------------------------------------------- order

def _placed(table, *names):
    """The place of each row as the table comes; a sort's output is numbered as it stands."""
    rows = table.select(*names, F.monotonically_increasing_id().alias("at"))
    return rows.select(*names, F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


@query("order_by_revenue", items_sql(" UNION ALL ".join(f"""
    SELECT '{by}' AS dimension, {by} AS name, row_number() OVER (ORDER BY revenue DESC, {by}) AS place
    FROM (SELECT {by}, round(sum(rev), 2) AS revenue FROM x WHERE is_cur GROUP BY {by})""" for by in S.DIMENSIONS)))
def order_by_revenue(spark, d):
    current, prior = periods(spark, d)
    parts = [
        _placed(S.grouped_summary(star_items(spark, d, *_MEASURES, by), by, current, prior).withColumnRenamed(by, "name"), "name")
        .withColumn("dimension", F.lit(by))
        for by in S.DIMENSIONS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("order_by_avg_discount", items_sql("""
    SELECT category, row_number() OVER (ORDER BY avg(discount) DESC, category) AS place FROM x WHERE is_cur GROUP BY category
"""))
def order_by_avg_discount(spark, d):
    rows = star_items(spark, d, *_MEASURES, "category")
    return _placed(S.discount_analysis(rows, "category", periods(spark, d)[0]), "category")


@query("order_by_band", items_sql("""
    SELECT band, row_number() OVER (ORDER BY min(band_ord)) AS place FROM x WHERE is_cur GROUP BY band
"""))
def order_by_band(spark, d):
    return _placed(S.discount_bands(star_items(spark, d, *_MEASURES, "order_id"), periods(spark, d)[0]), "band")


@query("order_by_period", items_sql("""
    SELECT strftime(m, '%Y-%m') AS period, row_number() OVER (ORDER BY m) AS place FROM (SELECT DISTINCT date_trunc('month', date) AS m FROM x)
"""))
def order_by_period(spark, d):
    return _placed(S.monthly_summary(star_items(spark, d, *_MEASURES, labels=False)), "period")


@query("headline_totals", items_sql("""
    SELECT round(sum(rev), 2) AS revenue, round(sum(profit), 2) AS profit,
           round(sum(profit) / nullif(sum(rev), 0) * 100, 6) AS margin FROM x WHERE is_cur
"""))
def headline_totals(spark, d):
    table = S.headline_totals(star_items(spark, d, *_MEASURES), periods(spark, d)[0])
    return rounded(table, **money("revenue", "profit"), **rate("margin"))


@query("revenue_change", items_sql("""
    SELECT round(r, 2) AS revenue, round(pr, 2) AS prior_revenue, round((r - pr) / abs(nullif(pr, 0)) * 100, 6) AS revenue_change
    FROM (SELECT sum(rev) FILTER (WHERE is_cur) AS r, sum(rev) FILTER (WHERE is_pri) AS pr FROM x)
"""))
def revenue_change(spark, d):
    table = S.revenue_change(star_items(spark, d, *_MEASURES), *periods(spark, d))
    return rounded(table, **money("revenue", "prior_revenue"), **rate("revenue_change"))


_BAR = """CASE WHEN max(revenue) OVER () = 0 THEN 0
               ELSE greatest(CAST(2 AS DOUBLE), revenue / max(revenue) OVER () * 100) END"""


@query("bar_share", items_sql(f"""
    SELECT product, round(revenue, 2) AS revenue, round({_BAR}, 6) AS bar
    FROM (SELECT product, sum(rev) AS revenue FROM x WHERE is_cur GROUP BY product)
"""))
def bar_share(spark, d):
    rows = star_items(spark, d, *_MEASURES, "product")
    table = S.with_bar_share(S.product_summary(rows, *periods(spark, d)))
    return rounded(table.select("product", "revenue", "bar"), **money("revenue"), **rate("bar"))


@query("bar_length", items_sql("""
    SELECT product, round(greatest(CAST(2 AS DOUBLE), revenue / 1000000000 * 100), 6) AS bar
    FROM (SELECT product, sum(rev) AS revenue FROM x GROUP BY product)
"""))
def bar_lengths(spark, d):
    by_product = flat.revenue_by(star_items(spark, d, "product", "quantity", "price", "discount"), "product")
    return rounded(by_product.selectExpr("product", f"{bar_length('revenue', '1e9D')} AS bar"), **rate("bar"))


@query("name_with_note", items_sql(f"""
    SELECT region, dq_note IS NOT NULL AS is_marked, coalesce(region || '  ⚠ ' || dq_note, region) AS shown_name
    FROM ({_summary_sql("region")})
"""))
def name_with_note(spark, d):
    table = S.region_summary(star_items(spark, d, *_MEASURES, "region"), *periods(spark, d))
    return S.with_name_note(table, "region").select("region", "is_marked", "shown_name")


# ------------------------------------------------------------------ KPIs

_KPI_SQL = """
    k AS (
      SELECT sum(gross) AS gross, sum(disc) AS disc, sum(rev) AS net, sum(profit) AS profit,
             count(DISTINCT order_id) AS orders, sum(quantity) AS units, count(DISTINCT customer) AS customers,
             nullif(sum(sales_target), 0) AS target
      FROM x WHERE is_cur
    ),
    pk AS (SELECT sum(rev) AS pnet, sum(profit) AS pprofit FROM x WHERE is_pri),
    ok AS (
      SELECT count(*) FILTER (WHERE p < 0) AS loss, count(*) FILTER (WHERE dd > 0) AS cut
      FROM (SELECT order_id, sum(profit) AS p, sum(disc) AS dd FROM x WHERE is_cur GROUP BY order_id)
    ),
    figures AS (
      SELECT gross AS gross_sales, disc AS discount_amount, net AS net_sales, profit AS total_profit,
             profit / nullif(net, 0) * 100 AS overall_margin, orders AS num_orders, units AS units_sold,
             net / nullif(orders, 0) AS avg_order_value, net / nullif(units, 0) AS avg_selling_price,
             disc / nullif(gross, 0) * 100 AS discount_rate, profit / nullif(orders, 0) AS profit_per_order,
             customers AS distinct_customers, target AS sales_target, net / target * 100 AS target_achievement,
             (net - pnet) / abs(nullif(pnet, 0)) * 100 AS sales_growth,
             (profit - pprofit) / abs(nullif(pprofit, 0)) * 100 AS profit_growth,
             loss AS negative_profit_orders, cut AS discounted_orders
      FROM k, pk, ok
    )
"""
_COUNTS = {"num_orders", "distinct_customers", "negative_profit_orders", "discounted_orders"}
_AMOUNTS = {"gross_sales", "discount_amount", "net_sales", "total_profit", "units_sold", "sales_target"}


def _kpi_columns() -> str:
    return ", ".join(
        n if n in _COUNTS else f"round({n}, {2 if n in _AMOUNTS else 6}) AS {n}" for n in KPI_NAMES
    )


def _kpis(spark, d):
    return kpis(
        star_items(spark, d, *_MEASURES, "order_id", "customer", "sales_target", labels=False), *periods(spark, d)
    )


@query("kpis", f"WITH {items_sql('')[5:]}, {_KPI_SQL} SELECT {_kpi_columns()} FROM figures")
def kpi_figures(spark, d):
    digits = {n: 2 if n in _AMOUNTS else 6 for n in KPI_NAMES if n not in _COUNTS}
    return rounded(_kpis(spark, d), **digits)


_KPI_TEXT = """
    SELECT unnest([1,2,3,4,5,6,7,8,9,10,11,12,13,14,15,16,17,18]) AS ord,
           unnest([
             format('${:,.0f}', gross_sales), format('${:,.0f}', discount_amount), format('${:,.0f}', net_sales),
             format('${:,.0f}', total_profit), format('{:.1f}%', overall_margin), format('{:,.0f}', CAST(num_orders AS DOUBLE)),
             format('{:,.0f}', units_sold), format('${:,.0f}', avg_order_value), format('${:,.0f}', avg_selling_price),
             format('{:.1f}%', discount_rate), format('${:,.0f}', profit_per_order),
             format('{:,.0f}', CAST(distinct_customers AS DOUBLE)),
             coalesce(format('${:,.0f}', sales_target), 'Not available from source data'),
             coalesce(format('{:.1f}%', target_achievement), 'Not available from source data'),
             format('{:+.1f}%', sales_growth), format('{:+.1f}%', profit_growth),
             format('{:,.0f}', CAST(negative_profit_orders AS DOUBLE)), format('{:,.0f}', CAST(discounted_orders AS DOUBLE))
           ]) AS value
    FROM figures
"""

# Label and definition of each figure, in the order shown.
_KPI_NAMES = [
    ("Gross Sales", "Quantity x Price, summed"),
    ("Discount Amount", "Gross Sales x Discount %, summed"),
    ("Net Sales", "Gross Sales - Discount Amount"),
    ("Total Profit", "Net Sales - Total Cost (from the profit column)"),
    ("Profit Margin %", "Total Profit / Net Sales x 100"),
    ("Distinct Orders", "Distinct count of Order ID"),
    ("Units Sold", "Sum of Quantity"),
    ("Average Order Value", "Net Sales / distinct Orders"),
    ("Average Selling Price", "Net Sales / Units Sold"),
    ("Discount Rate %", "Discount Amount / Gross Sales x 100"),
    ("Profit per Order", "Total Profit / distinct Orders"),
    ("Distinct Customers", "Distinct count of Customer"),
    ("Sales Target", "Sum of the sales_target column (not in this source file unless provided)"),
    ("Target Achievement %", "Net Sales / Sales Target x 100"),
    ("Sales Growth vs Prior Period", "(Current Net Sales - Prior Net Sales) / Prior Net Sales x 100"),
    ("Profit Growth vs Prior Period", "(Current Total Profit - Prior Total Profit) / Prior Total Profit x 100"),
    ("Negative-Profit Orders", "Distinct orders whose summed profit is below 0"),
    ("Discounted Orders", "Distinct orders with a non-zero discount amount"),
]
_KPI_LABELS = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(_KPI_NAMES, 1))

query("kpi_rows", f"""
    WITH {items_sql('')[5:]}, {_KPI_SQL}, named(ord, metric, definition) AS (VALUES {_KPI_LABELS})
    SELECT ord, metric, value, definition FROM ({_KPI_TEXT}) JOIN named USING (ord)
""")(lambda spark, d: kpi_rows(_kpis(spark, d)))


# ------------------------------------------------------ flags and summary

_FLAGS_SQL = f"""
    long AS (
      {" UNION ALL ".join(
        f"SELECT '{by}' AS dimension, {by} AS name, c.revenue, c.profit, p.revenue AS prior_revenue, "
        f"c.profit / nullif(c.revenue, 0) AS margin, "
        f"(c.revenue - p.revenue) / abs(nullif(p.revenue, 0)) * 100 AS pct_change "
        f"FROM (SELECT {by}, sum(rev) AS revenue, sum(profit) AS profit FROM x WHERE is_cur GROUP BY {by}) c "
        f"LEFT JOIN (SELECT {by}, sum(rev) AS revenue FROM x WHERE is_pri GROUP BY {by}) p USING ({by})"
        for by in ("category", "region", "product"))}
    ),
    flags AS (
      SELECT dimension, name, reason,
             CASE WHEN coalesce(pct_change <= -30, false) OR coalesce(profit < 0, false) THEN 'critical' ELSE 'warning' END AS severity
      FROM (
        SELECT *, nullif(concat_ws('; ',
                 CASE WHEN pct_change <= -15 THEN format('revenue down {{:.1f}}% vs prior period', pct_change) END,
                 CASE WHEN margin < CAST(0.10 AS DOUBLE) THEN format('margin only {{:.1f}}%', margin * 100) END,
                 CASE WHEN profit < 0 THEN format('negative total profit (${{:,.0f}})', profit) END), '') AS reason
        FROM long
      ) WHERE reason IS NOT NULL
    )
"""


def flags_sql(statement: str) -> str:
    return f"WITH {items_sql('')[5:]}, {_FLAGS_SQL} {statement}"


def _long(spark, d):
    return S.dimension_summaries(star_items(spark, d, *_MEASURES, *S.DIMENSIONS), *periods(spark, d))


@query("order_flags", flags_sql("""
    SELECT dimension, name, row_number() OVER (ORDER BY severity, CASE dimension WHEN 'category' THEN 1 WHEN 'region' THEN 2 ELSE 3 END,
           revenue DESC, name) AS place
    FROM flags JOIN (SELECT dimension, name, round(revenue, 2) AS revenue FROM long) USING (dimension, name)
"""))
def order_flags(spark, d):
    return _placed(flag_rows(_long(spark, d)), "dimension", "name")


query("flags", flags_sql("SELECT dimension, name, reason, severity FROM flags"))(
    lambda spark, d: flag_rows(_long(spark, d))
)


# The two months before the last year begun: whole months, where some groups are fine and some only warned of.
_EARLIER = f"WITH {items_sql('')[5:]}, {_FLAGS_SQL}".replace(
    "AS c FROM items)", "AS c FROM items WHERE date < (SELECT date_trunc('year', max(date)) FROM items))"
)


@query("flags_and_unflagged", _EARLIER + """
    SELECT long.dimension, coalesce(severity, 'none') AS outcome, count(*) AS n, string_agg(reason, ' | ' ORDER BY long.name) AS reasons
    FROM long LEFT JOIN flags ON flags.dimension = long.dimension AND flags.name = long.name GROUP BY 1, 2
""")
def flags_and_unflagged(spark, d):
    rows = star_items(spark, d, *_MEASURES, *S.DIMENSIONS)
    rows = rows.where(F.col("date") < rows.agg(F.date_trunc("year", F.max("date"))).scalar())
    long = S.dimension_summaries(rows, *latest_two(rows))
    raised = flag_rows(long).select("dimension", "name", "reason", "severity")
    found = long.where("dimension <> 'all'").select("dimension", "name").join(raised, ["dimension", "name"], "left")
    reasons = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("name", "reason")))), lambda r: r["reason"]), " | ")
    return found.groupBy("dimension", F.coalesce("severity", F.lit("none")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.nullif(reasons, F.lit("")).alias("reasons")
    )


@query("union_flags", flags_sql("SELECT dimension, count(*) AS raised FROM flags GROUP BY 1"))
def union_flags(spark, d):
    current, prior = periods(spark, d)
    tables = [
        S.grouped_summary(star_items(spark, d, *_MEASURES, by), by, current, prior) for by in S.DIMENSIONS
    ]
    return generate_flags(*tables).groupBy("dimension").agg(F.count(F.lit(1)).alias("raised"))


query("flag_counts", flags_sql(
    "SELECT count(*) FILTER (WHERE severity = 'critical') AS critical, "
    "count(*) FILTER (WHERE severity = 'warning') AS warning FROM flags"
))(lambda spark, d: flag_counts(flag_rows(_long(spark, d))))

query("flag_lines", flags_sql(
    "SELECT dimension, name, severity, upper(dimension[1]) || substr(dimension, 2) || ': ' || name || ' — ' "
    "|| replace(reason, '; ', ' and ') || '.' AS line FROM flags"
))(lambda spark, d: flag_lines(flag_rows(_long(spark, d))))

_FACTS_SQL = """
    facts AS (
      SELECT (SELECT sum(rev) FROM x WHERE is_cur) AS revenue, (SELECT sum(profit) FROM x WHERE is_cur) AS profit,
             (SELECT sum(rev) FROM x WHERE is_pri) AS prior_revenue,
             (SELECT name FROM long WHERE dimension = 'category' ORDER BY revenue DESC, name LIMIT 1) AS top_category,
             (SELECT revenue FROM long WHERE dimension = 'category' ORDER BY revenue DESC, name LIMIT 1) AS top_category_revenue,
             (SELECT count(*) FROM long WHERE dimension = 'region') AS regions,
             (SELECT name FROM long WHERE dimension = 'region' AND pct_change IS NOT NULL ORDER BY pct_change, name LIMIT 1) AS worst_region,
             (SELECT min(pct_change) FROM long WHERE dimension = 'region') AS worst_change,
             (SELECT name FROM long WHERE dimension = 'region' AND pct_change IS NOT NULL ORDER BY pct_change DESC, name DESC LIMIT 1) AS best_region,
             (SELECT max(pct_change) FROM long WHERE dimension = 'region') AS best_change,
             (SELECT count(*) FROM flags WHERE severity = 'critical') AS critical,
             (SELECT count(*) FROM flags WHERE severity = 'warning') AS warning
    )
"""


def facts_sql(statement: str) -> str:
    return f"WITH {items_sql('')[5:]}, {_FLAGS_SQL}, {_FACTS_SQL} {statement}"


@query("summary_facts", facts_sql(
    "SELECT * REPLACE (round(revenue, 2) AS revenue, round(profit, 2) AS profit, round(prior_revenue, 2) AS prior_revenue, "
    "round(top_category_revenue, 2) AS top_category_revenue, round(worst_change, 6) AS worst_change, "
    "round(best_change, 6) AS best_change) FROM facts"
))
def facts(spark, d):
    return rounded(
        summary_facts(_long(spark, d)),
        **money("revenue", "profit", "prior_revenue", "top_category_revenue"), **rate("worst_change", "best_change"),
    )


_BULLETS = """
    SELECT ord, bullet FROM (
      SELECT unnest([1, 2, 3, 4, 5]) AS ord, unnest([
        format('In {}, total sales revenue was ${:,.0f} with ${:,.0f} in profit (a {:.1f}% overall margin).',
               strftime(c, '%Y-%m'), revenue, profit, profit / revenue * 100),
        format('{} {:.1f}% versus {} (${:,.0f}).', CASE WHEN revenue >= prior_revenue THEN 'Up' ELSE 'Down' END,
               abs((revenue - prior_revenue) / abs(prior_revenue) * 100), strftime(p, '%Y-%m'), prior_revenue),
        format('{} was the top category by revenue (${:,.0f}).', top_category, top_category_revenue),
        CASE WHEN regions > 1 AND worst_change < 0 THEN
          format('{} was the weakest region ({:.1f}%), while {} led growth ({:+.1f}%).', worst_region, worst_change,
                 best_region, best_change) END,
        CASE WHEN critical + warning > 0 THEN
          format('{} critical and {} warning flag(s) were raised below — see Flags for detail.', critical, warning)
          ELSE 'No critical issues were flagged this period.' END
      ]) AS bullet FROM facts, cur, pri
    ) WHERE bullet IS NOT NULL
"""


@query("summary_bullets", facts_sql(_BULLETS))
def bullets(spark, d):
    return summary_bullets(summary_facts(_long(spark, d)), *periods(spark, d))


query("top_category", flags_sql(
    "SELECT name AS category, round(revenue, 2) AS revenue FROM long WHERE dimension = 'category' "
    "ORDER BY long.revenue DESC, name LIMIT 1"
))(
    lambda spark, d: rounded(
        S.category_summary(star_items(spark, d, *_MEASURES, "category"), *periods(spark, d))
        .select("category", "revenue").limit(1),
        **money("revenue"),
    )
)


@query("extreme_regions", flags_sql("""
    SELECT (SELECT name FROM long WHERE dimension = 'region' ORDER BY pct_change, name LIMIT 1) AS worst,
           (SELECT name FROM long WHERE dimension = 'region' ORDER BY pct_change DESC, name DESC LIMIT 1) AS best
"""))
def extreme_regions(spark, d):
    table = S.region_summary(star_items(spark, d, *_MEASURES, "region"), *periods(spark, d))
    change = F.struct("pct_change", "region")
    return table.where("pct_change IS NOT NULL").agg(
        F.min_by("region", change).alias("worst"), F.max_by("region", change).alias("best")
    )


# ------------------------------------------------------- derived columns

def _derived(name: str, sql: str):
    @query(name, items_sql(f"SELECT category, count({sql}) AS n, round(sum({sql}), 2) AS total FROM x GROUP BY category"))
    def run(spark, d):
        rows = with_measures(star_items(spark, d, *_MEASURES, "category", labels=False))
        measure = name.removeprefix("derive_")
        table = rows.groupBy("category").agg(F.count(measure).alias("n"), F.sum(measure).alias("total"))
        return rounded(table, total=2)


_derived("derive_gross_sales", "gross")
_derived("derive_discount_amount", "disc")
_derived("derive_revenue", "rev")


@query("derive_margin", items_sql(
    "SELECT category, count(profit / nullif(rev, 0)) AS n, round(avg(profit / nullif(rev, 0)), 6) AS mean FROM x GROUP BY category"
))
def derive_margin(spark, d):
    rows = with_measures(star_items(spark, d, *_MEASURES, "category", labels=False))
    table = rows.groupBy("category").agg(F.count("margin").alias("n"), F.avg("margin").alias("mean"))
    return rounded(table, mean=6)


query("derive_period", items_sql(
    "SELECT strftime(date, '%Y-%m') AS period, count(*) AS line_items FROM items GROUP BY 1"
))(
    lambda spark, d: with_measures(star_items(spark, d, *_MEASURES, labels=False))
    .groupBy("period").agg(F.count(F.lit(1)).alias("line_items"))
)


# ------------------------------------------------------------------ flat

def _flat(name: str, by: str):
    query(name, items_sql(f"SELECT {by}, round(sum(rev), 2) AS revenue FROM x GROUP BY {by}"))(
        lambda spark, d: rounded(
            flat.revenue_by(star_items(spark, d, by, "quantity", "price", "discount", labels=False), by),
            **money("revenue"),
        )
    )


_flat("flat_by_region", "region")
_flat("flat_by_category", "category")
_flat("flat_by_product", "product")


@query("flat_discount_impact", items_sql("""
    SELECT product, round(sum(rev), 2) AS revenue, round(sum(discount), 2) AS discount,
           round(coalesce(sum(profit), 0), 2) AS profit, round_even(sum(profit) / nullif(sum(rev), 0) * 100, 2) AS profit_margin
    FROM x GROUP BY product
"""))
def flat_discount_impact(spark, d):
    rows = star_items(spark, d, "product", "quantity", "price", "discount", "profit", labels=False)
    return rounded(flat.discount_impact_by_product(rows), **money("revenue", "discount", "profit"))


@query("weak_regions", items_sql("""
    SELECT region, round(revenue, 2) AS revenue
    FROM (SELECT *, avg(revenue) OVER () AS mean
          FROM (SELECT region, sum(rev * CASE region WHEN 'ASIA' THEN 0.125 WHEN 'EUROPE' THEN 0.25 ELSE 1 END) AS revenue FROM x GROUP BY region))
    WHERE revenue < mean * CAST(0.2 AS DOUBLE)
"""))
def weak_regions(spark, d):
    """Two regions earn less, one of them little enough to be weak."""
    less = "CASE region WHEN 'ASIA' THEN 0.125D WHEN 'EUROPE' THEN 0.25D ELSE 1D END"
    rows = star_items(spark, d, "region", "quantity", "price", "discount", labels=False).withColumn("price", F.expr(f"price * {less}"))
    return rounded(flat.weak_regions(rows), **money("revenue"))


# --------------------------------------------------------- quality notes

_NOTE_SQL = """
    SELECT product, count(*) AS line_items,
      CASE WHEN count(*) FILTER (WHERE row_flag IS NOT NULL OR copies > 1) > 0 THEN
        concat(count(*) FILTER (WHERE row_flag IS NOT NULL OR copies > 1),
               CASE WHEN count(*) FILTER (WHERE row_flag IS NOT NULL OR copies > 1) = 1 THEN ' row' ELSE ' rows' END,
               ' affected: ',
               concat_ws(', ',
                 CASE WHEN count(*) FILTER (WHERE contains(row_flag, 'clamped:discount')) > 0 THEN
                   format('discount was out of the valid 0-100% range and was corrected ({})', count(*) FILTER (WHERE contains(row_flag, 'clamped:discount'))) END,
                 CASE WHEN count(*) FILTER (WHERE copies > 1) > 0 THEN format('duplicate row ({})', count(*) FILTER (WHERE copies > 1)) END,
                 CASE WHEN count(*) FILTER (WHERE contains(row_flag, 'invalid_category')) > 0 THEN
                   format('missing category ({})', count(*) FILTER (WHERE contains(row_flag, 'invalid_category'))) END,
                 CASE WHEN count(*) FILTER (WHERE contains(row_flag, 'invalid_customer')) > 0 THEN
                   format('missing customer ({})', count(*) FILTER (WHERE contains(row_flag, 'invalid_customer'))) END,
                 CASE WHEN count(*) FILTER (WHERE contains(row_flag, 'invalid_region')) > 0 THEN
                   format('missing region ({})', count(*) FILTER (WHERE contains(row_flag, 'invalid_region'))) END,
                 CASE WHEN count(*) FILTER (WHERE contains(row_flag, 'negative_profit')) > 0 THEN
                   format('negative profit on this row ({})', count(*) FILTER (WHERE contains(row_flag, 'negative_profit'))) END))
      END AS dq_note
    FROM labelled GROUP BY product
"""


def _notes(spark, d, by):
    from .quality import checked

    return spark.sql(
        f"""
        SELECT {by}, line_items, {note()} AS dq_note
        FROM (SELECT {by}, count(*) AS line_items, {", ".join(note_counts())} FROM {{rows}} GROUP BY {by})
        """,
        rows=checked(spark, d).rows,
    )


query("dq_note", exports_sql(_NOTE_SQL))(lambda spark, d: _notes(spark, d, "product"))

query("dq_note_join", exports_sql(f"""
    SELECT *, dq_note IS NOT NULL AS is_marked, coalesce(category || '  ⚠ ' || dq_note, category) AS shown_name
    FROM ({_NOTE_SQL.replace("product", "category")})
"""))(lambda spark, d: S.with_name_note(_notes(spark, d, "category"), "category"))
