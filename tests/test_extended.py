"""Line-total export: cleaning, the seven tables and their files."""

import datetime
import time

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import parse_date, parse_us_date
from tallyforge.operators import duplicates, extended as X
from tallyforge.plans.calculations import clean_to_csv, extended_tables, write_extended_tables
from tallyforge.session import shuffles_dropped
from tallyforge.sinks.tables import write_cleaned_csv
from tallyforge.sources import line_totals
from tallyforge.sources.line_totals import read_line_totals, scan_cleaned

TEXT = (
    "Order ID,Order Date,Ship Date,Segment,Region,Category,Product Name,Sales,Quantity,Discount,Profit\n"
    'A,07/01/2026,07/03/2026,Home,West,Tech,"Phone 5"" , black",160,2,0.2,-10\n'
    'A,07/01/2026,07/03/2026,Home,West,Tech,"Phone 5"" , black",160,2,0.2,-10\n'
    "A,06/30/2026,07/03/2026,Home,East,Tech,Case,50,1,0.125,5\n"
    "B,soon,07/03/2026,Corp,East,Office,Pen,3,1,0,\n"
    ",07/02/2026,07/03/2026,Corp,West,Office,Pen,4,1,0,1\n"
)


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("line_totals")
    (folder / "sales_data.csv").write_text(TEXT)
    missing = clean_to_csv(spark, str(folder / "sales_data.csv"), str(folder / "cleaned"))
    profile = {r["column"]: r["missing"] for r in missing.collect()}
    assert profile["Order Date"] == 1 and profile["Profit"] == 1 and profile["Order ID"] == 1 and profile["Sales"] == 0
    return scan_cleaned(spark, str(folder / "cleaned"))


def test_clean(cleaned):
    rows = {r["Product Name"]: r for r in cleaned.where("`Order ID` IS NOT NULL").collect()}
    assert cleaned.count() == 4
    phone = rows['Phone 5" , black']
    assert phone["Discount %"] == 20.0 and phone["Loss_Flag"] is True and phone["Order Date"] == datetime.datetime(2026, 7, 1)
    assert rows["Case"]["Discount %"] == 12.5 and rows["Pen"]["Loss_Flag"] is False and rows["Pen"]["Order Date"] is None


def test_clean_needs_its_columns(spark):
    with pytest.raises(ValueError, match="Ship Date, Profit"):
        X.clean_export(spark.createDataFrame([("x", 1.0)], "`Order Date` string, Discount double"))


def table(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_tables(cleaned):
    t = extended_tables(cleaned)
    assert table(t["Region_Category"], "Region", "Category")["West", "Tech"]["Sales"] == 160
    perf = table(t["Product_Performance"], "Product Name", "Month")
    assert perf["Pen", "NaT"]["Total_Profit"] == 0 and perf["Case", "2026-06"]["Total_Sales"] == 50
    assert [r["Month"] for r in t["Monthly_Trend"].collect()] == ["2026-06", "2026-07", "NaT"]
    assert [(r["Category"], r["Profit"]) for r in t["Underperformers"].collect()] == [("Tech", -10)]
    impact = table(t["Discount_Impact"], "Discount %")
    assert impact[0.0,]["Orders"] == 1 and impact[0.0,]["Avg_Profit"] == 1 and impact[20.0,]["Orders"] == 1
    pivot = table(t["Region_by_Category"], "Region")
    assert pivot["West",].asDict() == {"Region": "West", "Office": 4.0, "Tech": 160.0}
    assert [r["Sales"] for r in t["Top_Products"].collect()] == [160, 50, 7]


def test_pivot_reads_its_rows_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Region,Category,Sales\nWest,Tech,1\nWest,Office,2\nWest,Tech,3\nEast,,4\nNorth,Office,\n")
    pivot = X.region_category_pivot(read_line_totals(spark, str(tmp_path)))
    (tmp_path / "a.csv").unlink()
    assert {r["Region"]: (r["Office"], r["Tech"]) for r in pivot.collect()} == {"West": (2.0, 4.0), "North": (0.0, 0.0)}
    assert pivot.columns == ["Region", "Office", "Tech"]


def test_percentile_is_linear(spark):
    rows = spark.createDataFrame([("C", f"R{i}", float(i)) for i in range(1, 5)], "Category string, Region string, Profit double")
    assert [r["Profit"] for r in X.underperformers(rows).collect()] == [1.0]


def test_write_tables(spark, cleaned, tmp_path):
    path = str(tmp_path / "c")
    cleaned.write.option("header", True).option("escape", '"').csv(path)
    write_extended_tables(spark, path, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "Top_Products")).count() == 3
    assert read_line_totals(spark, path).columns == cleaned.columns


def test_several_tables_parse_only_their_columns(spark, cleaned, tmp_path, monkeypatch):
    from tallyforge.plans import calculations

    path, kept = str(tmp_path / "c"), []
    cleaned.write.option("header", True).option("escape", '"').csv(path)
    store = calculations.stored
    monkeypatch.setattr(calculations, "stored", lambda rows: kept.append(rows.columns) or store(rows))
    write_extended_tables(spark, path, str(tmp_path / "out"))
    assert len(kept) == 1 and not {"Ship Date", "Discount", "Quantity", "Loss_Flag"} & set(kept[0])
    for name, expected in extended_tables(cleaned).items():
        found = spark.read.parquet(str(tmp_path / "out" / name))
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())), name


def test_cleaned_files_are_looked_through_once(spark, tmp_path, monkeypatch):
    from tallyforge.sources import line_totals

    (tmp_path / "in.csv").write_text(
        "Order Date,Ship Date,Region,Category,Product Name,Segment,Sales,Discount,Profit,Order ID\n"
        '06/01/2026,06/02/2026,West,Tech,"Pen, blue",A, 5 ,0.1,NA,1\n06/01/2026,06/02/2026,East,Tech,Cap,A,1d,0.1,-2,2\n'
    )
    passes = []
    catalogue = line_totals.catalogue
    monkeypatch.setattr(line_totals, "catalogue", lambda spark, paths: passes.append(paths) or catalogue(spark, paths))
    out = str(tmp_path / "cleaned")
    clean_to_csv(spark, str(tmp_path / "in.csv"), out)
    write_extended_tables(spark, out, str(tmp_path / "tables"))
    assert len(passes) == 2  # the export and the cleaned files
    sales = spark.read.parquet(str(tmp_path / "tables" / "Region_Category"))
    assert {(r["Region"], r["Sales"]) for r in sales.collect()} == {("West", 5.0), ("East", 0.0)}
    # Another file beside them: what was kept is no longer of these files.
    (tmp_path / "cleaned" / "more.csv").write_text("Region;Sales\nNorth;7\n")
    rows = scan_cleaned(spark, out)
    assert len(passes) == 3
    assert {(r["Region"], r["Sales"], r["Product Name"]) for r in rows.collect()} == {
        ("West", 5.0, "Pen, blue"), ("East", None, "Cap"), ("North", 7.0, None),
    }


def test_tables_of_one_header_parse_only_their_cells(spark, tmp_path):
    from tallyforge.sources.line_totals import read_line_totals

    (tmp_path / "a.csv").write_text("Region,Sales,Note\nWest,1,x\n")
    (tmp_path / "b.csv").write_text("Region,Sales,Note\nEast,2,y\n")
    rows = read_line_totals(spark, str(tmp_path)).select("Sales")
    assert "ReadSchema: struct<c1:string>" in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["Sales"] for r in rows.collect()) == [1.0, 2.0]


def test_of_written_files_one_is_looked_through(spark, tmp_path, monkeypatch):
    rows = spark.range(40).selectExpr("concat('p \"', id, '\", x') AS `Product Name`", "double(id) AS Sales", "string(NULL) AS Region").repartition(4)
    for kind, table in (("plain", rows), ("empty", rows.where("Sales < 0")), ("broken", rows.withColumn("Region", F.lit("a\nb"))), ("other", rows.withColumnRenamed("Region", "a;b;c;d"))):
        out = str(tmp_path / kind)
        write_cleaned_csv(table, out)
        known = line_totals._stored_catalogue(spark, out).orderBy("path").collect()
        line_totals.store_catalogue(spark, out)
        assert known == line_totals._stored_catalogue(spark, out).orderBy("path").collect(), kind
    looked_at = []
    look = line_totals.catalogue
    monkeypatch.setattr(line_totals, "catalogue", lambda spark, paths: looked_at.append(len(paths)) or look(spark, paths))
    write_cleaned_csv(rows, str(tmp_path / "again"))
    assert scan_cleaned(spark, str(tmp_path / "again")).count() == 40 and looked_at == [1]


def test_plain_us_dates_are_read_as_by_the_format(spark):
    texts = [f"{m:02d}/{d:02d}/{y}" for y in ("0000", "0001", "1900", "1999", "2000", "2024") for m in range(14) for d in (0, 1, 9, 28, 29, 30, 31, 32)]
    texts += ["1/2/2001", " 01/02/2001 ", "01/02/2001\n", "01/02/2001 ", "01/2 /2001", "01/02/201", "+1/02/2001", "01-02-2001", "01/02/20011", "", None, "١١/١١/٢٠٠١"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.selectExpr("t", f"string({parse_us_date('t')}) AS fast", f"string({parse_date('t', 'M/d/yyyy')}) AS slow").collect()
    assert [r["t"] for r in both if r["fast"] != r["slow"]] == []
    plan = rows.selectExpr(parse_us_date("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "substr" in plan


# ------------------------------------------------------------ copies of scanned rows

_COPIES = [("a", 0.0, "x"), ("a", -0.0, "x"), ("a", 0.0, None), (None, None, "x"), (None, None, "x"), ("x", None, None), (None, None, None), ("b", 1.0, "y")]


@pytest.mark.parametrize("filter_from", [duplicates.FILTER_FROM, 0])
def test_distinct_rows_are_those_of_drop_duplicates(spark, monkeypatch, filter_from):
    monkeypatch.setattr(duplicates, "FILTER_FROM", filter_from)
    rows = spark.createDataFrame(_COPIES, "`Order ID` string, Sales double, Region string")
    found = duplicates.distinct_rows(rows)
    assert found.schema == rows.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.dropDuplicates().collect()))
    assert len(found.collect()) == 6
    assert duplicates.distinct_rows(rows.limit(0)).collect() == []


def test_rows_without_copies_are_not_shuffled(spark):
    """Cleaning a scanned export shuffled every row with all its columns."""
    rows = spark.range(100).selectExpr("'a' AS `Order Date`", "'b' AS `Ship Date`", "double(id) AS Discount", "1D AS Profit")
    plan = X.clean_export(rows, scanned=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def left():
        return str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")).count("shuffle_")

    before = left()
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3).write.parquet(str(tmp_path / "table"))
    for _ in range(50):
        if left() <= before:
            break
        time.sleep(0.1)
    assert left() <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
