"""Row and file rules on the 25-row frame."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import duplicates, quality as Q
from tallyforge.operators.labels import dq_flag
from tallyforge.operators.layout import map_header, missing_message, missing_required
from tallyforge.schema import BUSINESS_COLUMNS, OPTIONAL_DEFAULTS

SCHEMA = (
    "date timestamp_ntz, customer string, product string, category string, region string, quantity double, "
    "price double, discount double, profit double, sales_target double, order_id string, source_file string, "
    "missing_optional array<string>, row_id bigint"
)


def frame(n=25):
    return [
        {
            "date": f"2024-01-{(i % 28) + 1:02d}", "customer": f"Cust{i}", "quantity": ((i % 5) + 1) * 2.0,
            "price": 50.0 + i, "discount": 0.1, "profit": 100.0 + i, "category": "AB"[i % 2],
            "region": ["West", "East"][i % 2], "product": ["P1", "P2"][i % 2], "sales_target": None,
            "order_id": f"O{i}", "source_file": "bad.csv", "missing_optional": [], "row_id": i,
        }
        for i in range(n)
    ]


def run(spark, rows, **kwargs):
    import datetime

    data = [
        {**r, "date": r["date"] and datetime.datetime.fromisoformat(r["date"]), "row_id": i} for i, r in enumerate(rows)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    checked = Q.validate(df, **kwargs)
    kept = {r["order_id"] + f"#{r['row_id']}": r for r in checked.rows.selectExpr("*", f"{dq_flag('dq')} AS flag").collect()}
    issues = {r["check"]: r for r in checked.issues.collect()}
    return kept, issues, checked.halts.collect()


def flags(kept):
    return {k: r["flag"] for k, r in kept.items() if r["flag"]}


def test_missing_price_column_halts():
    missing = missing_required(map_header(["date", "quantity"]).columns)
    assert missing == ["price"]
    assert "it's missing the column: price" in missing_message("f.csv", missing)


def test_clean_frame_has_nothing_to_report(spark):
    kept, issues, halts = run(spark, frame())
    assert len(kept) == 25 and not flags(kept) and not issues and not halts


def test_absent_optional_columns_are_not_noise(spark):
    rows = [{**r, **OPTIONAL_DEFAULTS, "region": "", "missing_optional": list(OPTIONAL_DEFAULTS)} for r in frame()]
    kept, issues, _ = run(spark, rows)
    assert len(kept) == 25 and not flags(kept) and not issues


def test_one_bad_date_is_skipped(spark):
    rows = frame()
    rows[0]["date"] = None
    kept, issues, halts = run(spark, rows)
    assert len(kept) == 24 and not flags(kept) and not halts
    assert issues["bad_date"]["level"] == "skip" and issues["bad_date"]["count"] == 1
    assert issues["bad_date"]["message"] == (
        "Skipped 1 row(s) in bad.csv — the 'date' column was blank or unreadable for those rows."
    )


def test_only_bad_dates_halt(spark):
    kept, issues, halts = run(spark, [{**r, "date": None} for r in frame()])
    assert not kept and not issues and len(halts) == 1
    assert "100% of its rows don't have a valid date" in halts[0]["message"]


@pytest.mark.parametrize("bad, rows, halted", [(1, 20, False), (2, 39, True), (0, 1, False)])
def test_halt_share_is_strict(spark, bad, rows, halted):
    data = frame(rows)
    for r in data[:bad]:
        r["date"] = None
    assert bool(run(spark, data)[2]) == halted


def test_no_rows_no_halt(spark):
    kept, issues, halts = run(spark, [])
    assert not kept and not issues and not halts


def test_bad_quantity_or_price_is_skipped(spark):
    rows = frame()
    rows[1]["quantity"] = -5.0
    rows[2]["quantity"] = 0.0
    rows[3]["price"] = -1.0
    rows[4]["price"] = 0.0
    kept, issues, _ = run(spark, rows)
    assert len(kept) == 22 and issues["invalid_qty_price"]["count"] == 3
    assert issues["invalid_qty_price"]["level"] == "skip"


def test_discount_is_clamped(spark):
    rows = frame()
    rows[0]["discount"] = 1.5
    rows[1]["discount"] = -0.2
    kept, issues, _ = run(spark, rows)
    assert kept["O0#0"]["discount"] == 1.0 and kept["O1#1"]["discount"] == 0.0
    assert flags(kept) == {"O0#0": "clamped:discount", "O1#1": "clamped:discount"}
    assert issues["discount"]["level"] == "warn" and issues["discount"]["count"] == 2


@pytest.mark.parametrize("column, value, label", [
    ("region", "  ", "flagged:invalid_region"), ("category", "", "flagged:invalid_category"),
    ("customer", "\t", "flagged:invalid_customer"), ("profit", -50.0, "flagged:negative_profit"),
])
def test_flagged_rows_are_kept(spark, column, value, label):
    rows = frame()
    rows[2][column] = value
    kept, issues, _ = run(spark, rows)
    assert len(kept) == 25 and flags(kept) == {"O2#2": label}
    assert issues[label.split(":")[1]]["count"] == 1


def test_duplicates_are_kept_and_tagged(spark):
    rows = frame()
    rows.append({**rows[0], "order_id": "other"})
    kept, issues, _ = run(spark, rows)
    assert flags(kept) == {"O0#0": "flagged:duplicate", "other#25": "flagged:duplicate"}
    assert issues["duplicate"]["count"] == 1 and issues["cross_file_duplicate"]["count"] == 1


def test_labels_keep_rule_order(spark):
    rows = frame()
    rows[0] |= {"discount": 1.5, "region": ""}
    kept, _, _ = run(spark, rows)
    assert flags(kept) == {"O0#0": "flagged:invalid_region;clamped:discount"}


def test_copies_in_another_file(spark):
    rows = frame(3) + [{**r, "source_file": "copy.csv"} for r in frame(2)]
    kept, issues, _ = run(spark, rows)
    assert len(flags(kept)) == 4 and "duplicate" not in issues
    assert issues["cross_file_duplicate"]["count"] == 2


def test_halted_file_leaves_the_others(spark):
    rows = frame() + [{**r, "source_file": "halt.csv", "date": None, "region": ""} for r in frame(3)]
    kept, issues, halts = run(spark, rows)
    assert len(kept) == 25 and not issues and [h["source_file"] for h in halts] == ["halt.csv"]


@pytest.mark.parametrize("hot_groups", [1, 3, 10_000])
def test_copies_of_a_hot_row(spark, monkeypatch, hot_groups):
    """A third of all rows are one row; both the hot and the cold way give exact counts."""
    monkeypatch.setattr(duplicates, "HOT_GROUPS", hot_groups)
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN int(id / 6) ELSE id + 100000 END AS k",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'x' END AS t", "id AS row_id",
    )
    counted = duplicates.with_copies(rows, ["k", "t"])
    found = {(r["t"], r["copies"]): r["count"] for r in counted.groupBy("t", "copies").count().collect()}
    assert found == {("hot", 1000): 1000, ("x", 2): 1000, ("x", 1): 1000}


def test_hot_rows_are_spread_over_the_shuffle(spark):
    rows = spark.range(100).selectExpr("'hot' AS k", "id AS row_id")
    counted = duplicates.with_copies(rows, ["k"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (join,) = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "spread" in join.split("], [")[0]


def test_copies_are_exact_where_keys_share_a_hash(spark, monkeypatch):
    """Few hashes: repeated keys and lone ones meet in all of them."""
    monkeypatch.setattr(duplicates, "_hash", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(7)))
    rows = spark.range(300).selectExpr("CASE WHEN id < 200 THEN int(id / 4) WHEN id < 210 THEN NULL ELSE id + 1000 END AS k", "id % 2 AS f", "id AS row_id")
    expected = {(None, 10): 10, ("few", 4): 200, ("alone", 1): 90}
    per_split = duplicates.repeated_rows(rows, ["k"], ["f"]).groupBy("k").agg(F.sum("copies").alias("copies"))
    for groups in (None, per_split):
        counted = duplicates.with_copies(rows, ["k"], groups=groups)
        kinds = counted.withColumn("kind", F.expr("CASE WHEN k < 1000 THEN 'few' WHEN k >= 1000 THEN 'alone' END"))
        assert {(r["kind"], r["copies"]): r["count"] for r in kinds.groupBy("kind", "copies").count().collect()} == expected


@pytest.mark.parametrize("bits", [1 << 28, 64, 1])
def test_a_bitmap_keeps_rows_out_of_the_shuffle(spark, monkeypatch, bits):
    monkeypatch.setattr(duplicates, "FILTER_FROM", 0)
    monkeypatch.setattr(duplicates, "_BIT", f"pmod(key_hash, {bits}L)")
    rows = spark.range(5000).selectExpr("CASE WHEN id < 900 THEN int(id / 3) WHEN id >= 4990 THEN NULL ELSE id END AS k", "id AS row_id")
    hashed = rows.select("k", duplicates._hash(["k"]).alias("key_hash"))
    suspects = duplicates.copy_groups(hashed, ["key_hash"]).where("copies > 1").selectExpr("key_hash", f"bitmap_bucket_number({duplicates._BIT}) AS bucket")
    left = duplicates._with_bit(hashed, suspects)
    assert left.where("k < 300 OR k IS NULL").count() == 910
    assert left.count() == 910 if bits == 1 << 28 else left.count() > 910
    found = duplicates.repeated_rows(rows, ["k"])
    assert {(r["copies"], r["count"]) for r in found.groupBy("copies").count().collect()} == {(3, 300), (10, 1)}
    per_split = duplicates.repeated_rows(rows.withColumn("f", F.expr("row_id % 2")), ["k"], ["f"])
    assert per_split.columns == ["k", "f", "copies"] and per_split.agg(F.sum("copies")).first()[0] == 910
    made = []
    with monkeypatch.context() as patch:
        patch.setattr(duplicates, "stored", lambda table: made.append(table) or table)
        duplicates.repeated_rows(rows, ["k"])
    plan = made[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("bits")  # the rows of the join are those with a bit
    counted = duplicates.with_copies(rows, ["k"])
    assert {(r["copies"], r["count"]) for r in counted.groupBy("copies").count().collect()} == {(1, 4090), (3, 900), (10, 10)}


def test_looking_up_copies_shuffles_no_key_columns(spark):
    rows = spark.range(100).selectExpr("concat('name ', id % 60) AS k", "double(id % 2) * -0D AS z", "id AS row_id")
    counted = duplicates.with_copies(rows, ["k", "z"])
    assert {(r["copies"], r["count"]) for r in counted.groupBy("copies").count().collect()} == {(1, 20), (2, 80)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = counted.select("copies")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (join,) = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "key_hash" in join and "k#" not in join.replace("key_hash#", "")


def test_every_reused_order_id_is_a_row(spark):
    rows = spark.range(500).selectExpr("'f.csv' AS source_file", "concat('S', lpad(int(id / 2), 3, '0')) AS order_id")
    reused = Q.order_id_reuse(rows)
    assert {r["order_id"] for r in reused.collect()} == {f"S{i:03}" for i in range(250)}
    (issue,) = Q.order_id_issues(reused).collect()
    assert issue["count"] == 250 and issue["message"].startswith("250 Order_ID(s) reused across different orders in f.csv -- likely")


def test_exact_counting_sees_suspects_only(spark, monkeypatch):
    """The semi-join stays when nothing may be broadcast."""
    made = []
    monkeypatch.setattr(duplicates, "stored", lambda table: made.append(table) or table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(100).selectExpr("id % 60 AS k", "id % 2 AS f", "id AS row_id")
        for split in ([], ["f"]):
            duplicates.repeated_rows(rows, ["k"], split)
            assert "LeftSemi" in made[-1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_missing_profile(spark):
    rows = spark.createDataFrame([(1, None), (None, None)], "`a b` int, c string")
    assert {r["column"]: r["missing"] for r in Q.missing_profile(rows).collect()} == {"a b": 1, "c": 2}


def test_banner(spark):
    rows = frame() + [{**r, "source_file": "halt.csv", "date": None} for r in frame(3)]
    rows[0]["date"], rows[1]["quantity"], rows[2]["region"] = None, 0.0, ""
    import datetime

    data = [{**r, "date": r["date"] and datetime.datetime.fromisoformat(r["date"])} for r in rows]
    checked = Q.validate(spark.createDataFrame(data, SCHEMA))
    assert Q.banner(checked.issues, checked.halts).first().asDict() == {"halts": 1, "warnings": 1, "skipped_rows": 2}


def test_business_columns_leave_out_the_order_id():
    assert "order_id" not in BUSINESS_COLUMNS
