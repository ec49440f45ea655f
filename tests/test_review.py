"""KPI frame and the two-month sample with known results."""

import datetime

import pytest

from tallyforge.operators import flat, summaries as S
from tallyforge.operators.flags import flag_counts, flag_lines, flag_rows, flags, generate_flags, summary_bullets, summary_facts
from tallyforge.operators.kpis import kpi_rows, kpis
from tallyforge.operators.periods import distinct_periods, in_period, latest_two
from tallyforge.plans.report import report_sections
from tallyforge.schema import KPI_NAMES

JULY, JUNE = "2026-07", "2026-06"
DAY = {JULY: datetime.datetime(2026, 7, 15), JUNE: datetime.datetime(2026, 6, 15)}

SCHEMA = (
    "date timestamp_ntz, order_id string, customer string, product string, category string, region string, "
    "quantity double, price double, discount double, profit double, sales_target double, dq array<string>"
)


def line(month, order_id, customer, quantity, price, discount, profit, target=None):
    return (DAY[month], order_id, customer, "P", "C", "R", quantity, price, discount, profit, target, [])


KPI_LINES = [
    ("O1", "Alice", 2.0, 100.0, 0.10, 30.0), ("O1", "Alice", 1.0, 50.0, 0.0, 10.0), ("O2", "Bob", 1.0, 40.0, 0.25, -5.0),
]


def kpi_frame(spark, month=JULY, target=None, scale=1.0):
    return spark.createDataFrame([line(month, o, c, q, p * scale, d, x * scale, target) for o, c, q, p, d, x in KPI_LINES], SCHEMA)


def one(df):
    return df.first().asDict()


def test_order_kpis(spark):
    k = one(kpis(kpi_frame(spark), JULY, None))
    assert (k["gross_sales"], k["discount_amount"], k["net_sales"]) == (290, 30, 260)
    assert k["discount_rate"] == pytest.approx(30 / 290 * 100)
    assert (k["num_orders"], k["units_sold"], k["avg_order_value"], k["avg_selling_price"]) == (2, 4, 130, 65)
    assert (k["total_profit"], k["profit_per_order"], k["distinct_customers"]) == (35, 17.5, 2)
    assert (k["negative_profit_orders"], k["discounted_orders"]) == (1, 2)
    assert k["sales_target"] is k["target_achievement"] is k["sales_growth"] is k["profit_growth"] is None


def test_rows_count_as_orders_without_ids(spark):
    k = one(kpis(kpi_frame(spark).drop("order_id"), JULY, None))
    assert k["num_orders"] == 3 and k["negative_profit_orders"] is None and k["discounted_orders"] is None
    assert k["distinct_customers"] == 2
    k = one(kpis(kpi_frame(spark).drop("order_id", "customer"), JULY, None))
    assert k["num_orders"] == 3 and k["distinct_customers"] is None and k["net_sales"] == 260


def test_target(spark):
    k = one(kpis(kpi_frame(spark, target=200.0), JULY, None))
    assert k["sales_target"] == 600 and k["target_achievement"] == pytest.approx(260 / 600 * 100)
    assert one(kpis(kpi_frame(spark, target=0.0), JULY, None))["sales_target"] is None


def test_growth(spark):
    both = kpi_frame(spark).unionByName(kpi_frame(spark, JUNE, scale=0.5))
    k = one(kpis(both, JULY, JUNE))
    assert k["sales_growth"] == pytest.approx(100) and k["profit_growth"] == pytest.approx(100)
    assert k["num_orders"] == 2 and k["distinct_customers"] == 2


def test_no_profit_at_all(spark):
    rows = kpi_frame(spark).withColumn("profit", S.F.lit(None).cast("double"))
    k = one(kpis(rows, JULY, None))
    assert k["total_profit"] is k["overall_margin"] is k["negative_profit_orders"] is None and k["discounted_orders"] == 2
    head = one(S.headline_totals(rows, JULY))
    assert head == {"revenue": 260.0, "profit": None, "margin": None}
    facts = summary_facts(S.dimension_summaries(rows, JULY, None))
    texts = [r["bullet"] for r in summary_bullets(facts, JULY, None).collect()]
    assert texts[0].endswith("No profit data was provided, so profit and margin aren't shown.")
    assert texts[1].startswith("No prior period was found")
    assert texts[-1] == "No critical issues were flagged this period."


def test_empty_month(spark):
    empty = kpi_frame(spark).limit(0)
    assert set(one(kpis(empty, None, None)).values()) == {None}
    assert latest_two(empty) == (None, None)
    assert one(S.headline_totals(empty, None)) == {"revenue": 0.0, "profit": None, "margin": None}
    values = [r["value"] for r in kpi_rows(kpis(empty, None, None)).orderBy("ord").collect()]
    assert len(values) == len(KPI_NAMES) and set(values) == {"n/a", "Not available from source data"}
    sections = report_sections(empty, None, None)
    assert sections["by_category"].count() == 0 and sections["flags"].count() == 0


def test_discount_bands_of_the_kpi_frame(spark):
    bands = {r["band"]: r["orders"] for r in S.discount_bands(kpi_frame(spark), JULY).collect()}
    assert bands == {"No discount": 1, "Above 5% through 10%": 1, "Above 20%": 1}


# ------------------------------------------------------ two-month sample

SAMPLE = [
    ("North", "Electronics", "Laptop", (5000, 10, 1200), (4600, 10, 1050)),
    ("South", "Electronics", "Phone", (3000, 5, 800), (2800, 5, 720)),
    ("East", "Furniture", "Chair", (1200, 15, 200), (1100, 15, 180)),
    ("West", "Furniture", "Desk", (800, 20, 100), (2200, 12, 350)),
    ("North", "Clothing", "Jacket", (400, 25, 50), (900, 15, 180)),
    ("South", "Clothing", "Shoes", (300, 30, 30), (700, 15, 140)),
    ("East", "Electronics", "Tablet", (2500, 8, 600), (2300, 8, 550)),
    ("West", "Furniture", "Sofa", (150, 35, 10), (1300, 15, 220)),
]


@pytest.fixture(scope="module")
def sample(spark):
    rows = []
    for region, category, product, *months in SAMPLE:
        for month, (amount, pct, profit) in zip((JULY, JUNE), months):
            price = round(amount / (1 - pct / 100), 2)
            rows.append((
                DAY[month], f"{product}{month}", "Sample Customer", product, category, region, 1.0, price, pct / 100,
                float(profit), None, [],
            ))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_periods(sample):
    assert latest_two(sample) == (JULY, JUNE)
    assert [r["period"] for r in distinct_periods(sample).collect()] == [JULY, JUNE]
    assert in_period(sample, JULY).count() == 8 and in_period(sample, None).count() == 0


def test_months(sample):
    rows = {r["period"]: r for r in S.monthly_summary(sample).collect()}
    assert list(rows) == [JUNE, JULY]
    assert rows[JUNE]["revenue"] == pytest.approx(15899.9985) and rows[JUNE]["profit"] == 3390
    assert rows[JULY]["revenue"] == pytest.approx(13349.9913) and rows[JULY]["margin"] == pytest.approx(0.223970, abs=1e-6)


GROUPS = {
    "category": [
        ("Electronics", 10499.9983, 2600, 0.076667, 9700.0005, 0.247619, 8.2474),
        ("Furniture", 2149.9965, 310, 0.233333, 4600.0005, 0.144186, -53.2610),
        ("Clothing", 699.9965, 80, 0.275, 1599.9975, 0.114286, -56.2502),
    ],
    "region": [
        ("North", 5400.0015, 1250, 0.175, 5499.9960, 0.231481, -1.8181),
        ("East", 3699.9948, 800, 0.115, 3400.0020, 0.216217, 8.8233),
        ("South", 3299.9945, 830, 0.175, 3500.0020, 0.251516, -5.7145),
        ("West", 950.0005, 110, 0.275, 3499.9985, 0.115789, -72.8571),
    ],
}


@pytest.mark.parametrize("by", GROUPS)
def test_group_tables(sample, by):
    found = S.grouped_summary(sample, by, JULY, JUNE).collect()
    assert [r[by] for r in found] == [g[0] for g in GROUPS[by]]
    for r, (_, revenue, profit, discount, prior, margin, change) in zip(found, GROUPS[by]):
        assert r["revenue"] == pytest.approx(revenue) and r["profit"] == profit
        assert r["avg_discount"] == pytest.approx(discount, abs=1e-6) and r["prior_revenue"] == pytest.approx(prior)
        assert r["margin"] == pytest.approx(margin, abs=1e-6) and r["pct_change"] == pytest.approx(change, abs=1e-4)


def test_flags(sample):
    found = flags(sample, JULY, JUNE).collect()
    assert [r["name"] for r in found] == ["Furniture", "Clothing", "West", "Desk", "Jacket", "Shoes", "Sofa"]
    assert {r["severity"] for r in found} == {"critical"}
    assert found[-1]["reason"] == "revenue down -88.5% vs prior period; margin only 6.7%"
    line_ = flag_lines(flag_rows(S.dimension_summaries(sample, JULY, JUNE))).collect()[-1]["line"]
    assert line_ == "Product: Sofa — revenue down -88.5% vs prior period and margin only 6.7%."
    again = generate_flags(*[S.grouped_summary(sample, by, JULY, JUNE) for by in S.DIMENSIONS])
    assert [r.asDict() for r in again.collect()] == [r.asDict() for r in found]


@pytest.mark.parametrize("change, margin, profit, severity, reason", [
    (-15.0, 0.5, 5.0, "warning", "revenue down -15.0% vs prior period"),
    (-30.0, 0.05, 5.0, "critical", "revenue down -30.0% vs prior period; margin only 5.0%"),
    (None, 0.05, 5.0, "warning", "margin only 5.0%"),
    (5.0, -0.1, -5.0, "critical", "margin only -10.0%; negative total profit ($-5)"),
    (-14.9, 0.1, 5.0, None, None),
    (None, None, None, None, None),
])
def test_flag_rules(spark, change, margin, profit, severity, reason):
    rows = spark.createDataFrame(
        [("region", "X", 1.0, profit, margin, change)],
        "dimension string, name string, revenue double, profit double, margin double, pct_change double",
    )
    found = flag_rows(rows).collect()
    assert [(r["severity"], r["reason"]) for r in found] == ([(severity, reason)] if reason else [])
    assert sum(flag_counts(flag_rows(rows)).first()) == len(found)


def test_bullets(sample):
    facts = summary_facts(S.dimension_summaries(sample, JULY, JUNE))
    assert [r["bullet"] for r in summary_bullets(facts, JULY, JUNE).orderBy("ord").collect()] == [
        "In 2026-07, total sales revenue was $13,350 with $2,990 in profit (a 22.4% overall margin).",
        "Down 16.0% versus 2026-06 ($15,900).",
        "Electronics was the top category by revenue ($10,500).",
        "West was the weakest region (-72.9%), while East led growth (+8.8%).",
        "7 critical and 0 warning flag(s) were raised below — see Flags for detail.",
    ]


def test_discount_tables(sample):
    found = S.discount_analysis(sample, "product", JULY).collect()
    assert [r["product"] for r in found][:3] == ["Sofa", "Shoes", "Jacket"]
    assert [r["product"] for r in found if r["margin_risk"]] == ["Sofa"]
    assert S.discount_analysis(sample, "product", JULY, top_n=2).count() == 2
    marked = S.with_top_marker(S.discount_analysis(sample, "product", JULY), "product", 3).where("in_top").collect()
    assert {r["product"] for r in marked} == {"Sofa", "Shoes", "Jacket"}


def test_bands(sample):
    found = S.discount_bands(sample, JULY).collect()
    assert [(r["band"], r["orders"]) for r in found] == [
        ("Above 0% through 5%", 1), ("Above 5% through 10%", 2), ("Above 10% through 20%", 2), ("Above 20%", 3),
    ]
    assert found[3]["margin"] == pytest.approx(0.105883, abs=1e-6) and found[3]["gross_sales"] == pytest.approx(1192.67)
    by_product = S.discount_bands_by_product(sample, JULY).collect()
    assert [r["product"] for r in by_product][-3:] == ["Sofa", "Shoes", "Jacket"] and len(by_product) == 8


def test_prior_only_groups_vanish_and_new_groups_have_no_change(spark, sample):
    july = in_period(sample, JULY).where("category <> 'Clothing'")
    june = in_period(sample, JUNE).where("category <> 'Furniture'")
    found = {r["category"]: r["pct_change"] for r in S.category_summary(july.unionByName(june), JULY, JUNE).collect()}
    assert set(found) == {"Electronics", "Furniture"} and found["Furniture"] is None


def test_notes(spark, sample):
    tagged = sample.withColumn("dq", S.F.expr(
        "CASE WHEN product = 'Laptop' THEN array('flagged:negative_profit', 'flagged:duplicate') "
        "WHEN product = 'Phone' AND month(date) = 7 THEN array('flagged:duplicate') ELSE dq END"
    ))
    found = {r["category"]: r["dq_note"] for r in S.category_summary(tagged, JULY, JUNE).collect()}
    assert found == {
        "Electronics": "2 rows affected: duplicate row (2), negative profit on this row (1)", "Furniture": None, "Clothing": None,
    }
    one_row = {r["product"]: r["dq_note"] for r in S.discount_analysis(tagged, "product", JULY).collect()}
    assert one_row["Phone"] == "1 row affected: duplicate row (1)"
    named = {r["category"]: r["shown_name"] for r in S.with_name_note(S.category_summary(tagged, JULY, JUNE), "category").collect()}
    assert named["Furniture"] == "Furniture" and named["Electronics"].startswith("Electronics  ⚠ 2 rows")


def test_flat_tables(sample):
    tables = flat.analyze_items(sample)
    assert {r["region"]: round(r["revenue"], 2) for r in tables["by_region"].collect()}["West"] == 4450.0
    assert tables["weak_regions"].count() == 0
    few = sample.where("region <> 'West' OR product = 'Sofa'").where("region <> 'West' OR month(date) = 7")
    assert [r["region"] for r in flat.weak_regions(few).collect()] == ["West"]
    sofa = {r["product"]: r for r in tables["discount_impact"].collect()}["Sofa"]
    assert sofa["discount"] == pytest.approx(0.5) and sofa["profit_margin"] == 15.86


def test_report_sections(sample):
    sections = report_sections(sample, JULY, JUNE)
    assert sections["by_category"].first()["bar"] == 100.0
    kpi = {r["metric"]: r["value"] for r in sections["kpis"].collect()}
    assert kpi["Net Sales"] == "$13,350" and kpi["Sales Growth vs Prior Period"] == "-16.0%" and kpi["Sales Target"] == "Not available from source data"
    assert sections["change"].first()["revenue_change"] == pytest.approx(-16.04, abs=0.01)
