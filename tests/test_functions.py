"""Scalar functions on literal cells."""

import pytest
from pyspark.sql import functions as F

from tallyforge import functions as fn


def values(spark, cells, render, kind="string"):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r["v"] for r in rows.withColumn("v", F.expr(render("c"))).orderBy("i").collect()]


def check(spark, render, expected, kind="string"):
    assert values(spark, list(expected), render, kind) == list(expected.values())


def test_to_number(spark):
    check(spark, fn.to_number, {
        "12": 12.0, " 1.5 ": 1.5, "-3": -3.0, "+4": 4.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1E-2": 0.01,
        "1e300": 1e300, "1e999": None, "1d": None, "1f": None, "nan": None, "Infinity": None, "0x1p3": None,
        "abc": None, "": None, None: None, "1,000": None, "$5": None, "9" * 400: None,
    })


def test_clean_currency(spark):
    check(spark, fn.clean_currency, {
        "--$3,600.00": -3600.0, "$3,600.00": 3600.0, "80": 80.0, "-$5": -5.0, " $1 ": 1.0, "--5": -5.0,
        "n/a": None, None: None, "$": None, "$ 7": 7.0, "5--": None,
    })


def test_clean_percent(spark):
    check(spark, fn.clean_percent, {"10%": 0.1, "0%": 0.0, "0.1": 0.001, " 5 %": 0.05, "x%": None, None: None})


def test_title_case(spark):
    check(spark, fn.title_case, {
        "o'brien a-b 3rd": "O'Brien A-B 3Rd", "electronics": "Electronics", "  WEST  ": "West", None: "",
        "éCOLE n°5": "École N°5", "middle east": "Middle East", "日本abc": "日本Abc",
    })


def test_trim_text(spark):
    check(spark, fn.trim_text, {"\t a b ": "a b", "　x ": "x", None: "", "\x1cy\r\n": "y", "''\\": "''\\"})


def test_null_tokens(spark):
    check(spark, fn.null_tokens, {"NA": None, "n/a": None, "": None, "<NA>": None, "Nope": "Nope", "none": "none", None: None})


def test_cells_longer_than_any_null_token_are_not_looked_up(spark):
    from tallyforge.schema import NA_TOKENS

    texts = [*NA_TOKENS, "#N/A N/A ", "é" * 5, "0123456789", "é", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"{fn.null_tokens('t')} AS given")
    assert [r["given"] for r in rows.collect()] == [None if t in NA_TOKENS else t for t in texts]
    assert "octet_length" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_normalise_discount(spark):
    check(spark, fn.normalise_discount, {10.0: 0.1, 1.5: 0.015, 150.0: 1.5, 1.0: 1.0, -0.2: -0.2, 0.3: 0.3}, "double")


def test_discount_band(spark):
    check(spark, fn.discount_band, {
        None: "No discount", -0.1: "No discount", 0.0: "No discount", 0.05: "Above 0% through 5%",
        0.051: "Above 5% through 10%", 0.10: "Above 5% through 10%", 0.2: "Above 10% through 20%", 0.21: "Above 20%",
    }, "double")


def test_discount_percent(spark):
    check(spark, fn.discount_percent, {0.2: 20.0, 0.125: 12.5, 0.0125: 1.2, 0.0375: 3.8, None: None}, "double")


def test_text_formats_round_half_to_even(spark):
    check(spark, fn.fmt_money, {1234.5: "$1,234", 1235.5: "$1,236", -5.0: "$-5", None: "n/a"}, "double")
    check(spark, fn.fmt_pct, {1.25: "+1.2%", -53.26: "-53.3%", 0.0: "+0.0%", None: "n/a"}, "double")
    check(spark, lambda c: fn.fmt_pct(c, signed=False), {12.34: "12.3%", None: "n/a"}, "double")
    check(spark, fn.fmt_num, {1234567.0: "1,234,567", None: "n/a"}, "double")
    check(spark, fn.fmt_delta, {1.25: "▲ 1.2%", -1.25: "▼ 1.2%", None: "n/a"}, "double")


def test_label_text(spark):
    check(spark, fn.label_text, {"flagged:duplicate": "duplicate row", "other": "other"})


@pytest.mark.parametrize(
    "numerator, denominator, ratio", [(1.0, 4.0, 0.25), (1.0, 0.0, None), (None, 2.0, None), (0.0, 2.0, 0.0)]
)
def test_safe_ratio(spark, numerator, denominator, ratio):
    row = spark.createDataFrame([(numerator, denominator)], "a double, b double")
    assert row.select(F.expr(fn.safe_ratio("a", "b"))).first()[0] == ratio


def test_pct_change_uses_the_size_of_the_prior(spark):
    rows = spark.createDataFrame([(5.0, -10.0), (5.0, 0.0), (5.0, 10.0), (5.0, None)], "a double, b double")
    assert [r[0] for r in rows.select(F.expr(fn.pct_change("a", "b"))).collect()] == [150.0, None, -50.0, None]


def test_price_from_total(spark):
    rows = spark.createDataFrame(
        [(160.0, 2.0, 0.2), (160.0, 2.0, 1.0), (160.0, 0.0, 0.2), (160.0, 2.0, None), (160.0, 1.0, 20.0)],
        "s double, q double, d double",
    )
    price = [r[0] for r in rows.select(F.expr(fn.price_from_total("s", "q", "d"))).collect()]
    assert price[:4] == [100.0, 0.0, 0.0, 0.0] and price[4] < 0


def test_margin_risk(spark):
    rows = spark.createDataFrame([(0.15, 0.05), (0.15, 0.10), (0.14, 0.05), (0.2, None)], "d double, m double")
    assert [r[0] for r in rows.select(F.expr(fn.margin_risk("d", "m"))).collect()] == [True, False, False, False]


@pytest.mark.parametrize("sample, chosen", [
    ("2026-01-02", "yyyy-MM-dd"), ("1/3/2026", "M/d/yyyy"), ("13/02/2026", "d/M/yyyy"), ("1/2/26", "M/d/yy"),
    ("2-Jan-2026", "d-MMM-yyyy"), ("2026-01-04 10:00:00", "yyyy-MM-dd HH:mm:ss"), ("20260102", None), ("garbage", None),
    ("2026-01-02T03:04:05", "yyyy-MM-dd'T'HH:mm:ss"), ("Jan 2, 2026", "MMM d, yyyy"),
])
def test_guess_format(spark, sample, chosen):
    assert values(spark, [sample], fn.guess_format) == [chosen]


def test_to_date_uses_one_format_per_file(spark):
    rows = spark.createDataFrame(
        [("2026-01-02", "yyyy-MM-dd"), ("1/3/2026", "yyyy-MM-dd"), ("1/3/2026", None), ("x", None), (None, None)],
        "c string, f string",
    )
    days = [str(r[0])[:10] for r in rows.select(F.expr(fn.to_date("c", "f"))).collect()]
    assert days == ["2026-01-02", "None", "2026-01-03", "None", "None"]


def test_parse_us_date(spark):
    days = values(spark, ["07/15/2026", "7/5/2026", "13/02/2026", "1/2/26"], fn.parse_us_date)
    assert [str(d)[:10] for d in days] == ["2026-07-15", "2026-07-05", "None", "None"]


def test_bar_length(spark):
    check(spark, lambda c: fn.bar_length(c, "200D"), {200.0: 100.0, 1.0: 2.0, 50.0: 25.0}, "double")
    check(spark, lambda c: fn.bar_length(c, "0D"), {0.0: 0.0}, "double")


def test_usual_dates_with_a_time(spark):
    given = {
        "2026/7/5 14:03": "2026-07-05 14:03:00", "Jul 5, 2026 2:03 PM": "2026-07-05 14:03:00", "July 5, 2026 2:03:04 PM": "2026-07-05 14:03:04",
        "5 July 2026": "2026-07-05 00:00:00", "5 Jul 2026 14:03": "2026-07-05 14:03:00", "5-Jul-2026 14:03:04": "2026-07-05 14:03:04",
        "5.7.2026 14:03": "2026-07-05 14:03:00", "7/5/2026 2:03:04 PM": "2026-07-05 14:03:04", "Jul 5, 2026 14:03:04": "2026-07-05 14:03:04",
    }
    guessed = values(spark, list(given), fn.guess_format)
    assert all(guessed)
    rows = spark.createDataFrame(list(zip(given, guessed, strict=True)), "c string, f string")
    assert [str(r[0]) for r in rows.select(F.expr(fn.to_date("c", "f"))).collect()] == list(given.values())


def test_a_file_that_begins_in_may(spark):
    for first, others in (("May 1, 1995", ["July 4, 1996", "Jul 4, 1996"]), ("1 May 1995 1:02", ["4 July 1996 1:02", "4 Jul 1996 1:02"])):
        (guessed,) = values(spark, [first], fn.guess_format)
        rows = spark.createDataFrame([(c, guessed) for c in [first, *others]], "c string, f string")
        days = [str(r[0])[:10] for r in rows.select(F.expr(fn.to_date("c", "f"))).collect()]
        assert days == ["1995-05-01", "1996-07-04", "1996-07-04"]
