"""Export files: delimiters, charsets, layouts, halts, workbooks, sinks."""

import datetime
import random

import pytest

from tallyforge.catalog.exports import _sheet, file_splits
from tallyforge.operators.derive import with_measures
from tallyforge.operators.labels import dq_flag
from tallyforge.operators.periods import latest_two, latest_two_stored, stored_periods
from tallyforge.operators.layout import detect_layout, map_header
from tallyforge.plans.report import curated_rows, write_report
from tallyforge.sinks.tables import commits, dates_fall, drop_superseded, read_section, section_paths, write_curated, write_section, write_sections
from tallyforge.sources.files import catalogue, list_files, sniff_delimiter
from tallyforge.sources.exports import read_exports, scan_exports
from tallyforge.streaming import incremental
from tallyforge.streaming.incremental import ingest_new_files, review_rows, stored_issues, stored_rows

import pandas as pd


def put(folder, name, text, charset="utf-8"):
    (folder / name).write_bytes(text.encode(charset) if isinstance(text, str) else text)


def rows_of(checked, *order):
    return [r.asDict() for r in checked.rows.withColumn("flag", _flag()).orderBy(*(order or ("order_id",))).collect()]


def _flag():
    from pyspark.sql import functions as F

    return F.expr(dq_flag("dq"))


def halts_of(checked):
    return {r["source_file"]: r["reason"] for r in checked.halts.collect()}


UNDERSCORE = (
    "Order_ID\tOrder_Date\tCustomer_Name\tProduct\tProduct_Category\tRegion\tUnits_Sold\tUnit_Price\tDiscount_Pct\tProfit\n"
    "SO-1\t2026-07-01\tAnn\tLaptop\telectronics\tnorth\t1\t$3,600.00\t10%\t$400.00\n"
    "SO-2\t2026-07-02\tBob\tDesk\tFurniture\tWEST\t2\t$150.00\t0%\t--$3,600.00\n"
    "SO-2\t2026-07-03\tCy\tChair\tfurniture\to'brien\t0\t80\t5%\t\n"
)


def test_underscore_layout(spark, tmp_path):
    put(tmp_path, "raw.tsv", UNDERSCORE)
    checked = read_exports(spark, str(tmp_path))
    first, second = rows_of(checked)
    assert (first["price"], first["discount"], first["profit"], first["category"], first["region"]) == (3600, 0.1, 400, "Electronics", "North")
    assert (second["price"], second["profit"], second["region"], second["flag"]) == (150, -3600, "West", "flagged:negative_profit")
    issues = {r["check"]: r for r in checked.issues.collect()}
    assert issues["order_id_reuse"]["count"] == 1 and [r["order_id"] for r in checked.reused_ids.collect()] == ["SO-2"]
    assert issues["invalid_qty_price"]["count"] == 1 and not halts_of(checked)


def test_line_total_layout(spark, tmp_path):
    put(tmp_path, "store.csv", (
        "Order ID,Order Date,Ship Date,Customer Name,Segment,Region,Category,Product Name,Sales,Quantity,Discount,Profit\n"
        "A,07/01/2026,07/03/2026,Ann,Home,west,tech,Phone,160,2,0.2,10\n"
        "A,07/02/2026,07/03/2026,Ann,Home,west,tech,Case,50,1,1,\n"
        "B,07/02/2026,07/03/2026,Bob,Home,west,tech,Case,50,1,20,1\n"
    ))
    checked = read_exports(spark, str(tmp_path))
    phone, case = sorted(rows_of(checked), key=lambda r: -r["price"])
    assert phone["price"] == 100.0 and phone["order_id"] == "A" and phone["category"] == "Tech"
    assert case["price"] == 0.0 and case["profit"] == 0.0 and case["sales_target"] is None
    checks = {r["check"] for r in checked.issues.collect()}
    assert checks == {"invalid_qty_price"}


def test_clean_layout_aliases_defaults_and_unparseable_cells(spark, tmp_path):
    put(tmp_path, "a.csv", (
        "Date,Product Name,Unit Price,Invoice Number,Target,Discount,Region\n"
        "2026-07-01,Lamp,\"$3,600\", 17 ,500,10,NA\n"
        "2026-07-02,Lamp,20,,x,1.5,  \n"
        "2026-07-03,\"a;b,c\",30,nan,,abc,West\n"
    ))
    first, *others = rows_of(read_exports(spark, str(tmp_path)), "date")
    assert (first["price"], first["quantity"], first["discount"], first["order_id"]) == (0.0, 1.0, 0.1, "17")
    assert (first["sales_target"], first["profit"], first["customer"], first["region"]) == (500.0, None, "Unknown", "")
    assert first["flag"] == "flagged:invalid_region"
    assert [r["discount"] for r in others] == [0.015, 0.0] and others[1]["product"] == "a;b,c"
    assert all("/a.csv-row" in r["order_id"] for r in others)
    assert others[0]["order_id"] != others[1]["order_id"]


def test_files_of_many_shapes_in_one_folder(spark, tmp_path):
    put(tmp_path, "semi.csv", "date;price;customer\n13/02/2026;10;Zoë\n01/02/2026;11;Al\n")
    put(tmp_path, "old.csv", "date,price,customer\n2026-02-01,10,Zoë €5 \n", "cp1252")
    put(tmp_path, "bom.csv", "﻿date,price\n2026-02-01,1\n", "utf-8")
    put(tmp_path, "pipe [1] {a}%20.csv", "price|date\n5|2026-02-03\n")
    put(tmp_path, "~$lock.xlsx", b"")
    put(tmp_path, "noprice.csv", "date,qty\n2026-02-01,1\n")
    put(tmp_path, "long.csv", "date,price\n2026-02-01,1\n2026-02-01,1,2\n")
    put(tmp_path, "short.csv", "date,price,customer\n2026-02-01,7\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "late.csv", "date,price\nsoon,1\n")
    put(tmp_path, "broken.xlsx", b"not a zip")
    put(tmp_path, "notes.txt", "date,price\n2026-02-01,1\n")
    checked = read_exports(spark, str(tmp_path))
    found = {(r["source_file"], str(r["date"])[:10]): (r["price"], r["customer"]) for r in checked.rows.collect()}
    assert found == {
        ("semi.csv", "2026-02-13"): (10.0, "Zoë"), ("semi.csv", "2026-02-01"): (11.0, "Al"),
        ("old.csv", "2026-02-01"): (10.0, "Zoë €5"), ("bom.csv", "2026-02-01"): (1.0, "Unknown"),
        ("pipe [1] {a}%20.csv", "2026-02-03"): (5.0, "Unknown"), ("short.csv", "2026-02-01"): (7.0, ""),
    }
    assert halts_of(checked) == {
        "noprice.csv": "missing_columns", "long.csv": "unreadable", "empty.csv": "unreadable",
        "late.csv": "bad_dates", "broken.xlsx": "unreadable",
    }


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path, "multi.csv", 'date,price,customer\n2026-02-01,1,"A\nB"\n2026-02-02,2,"C ""D"" , E"\n')
    put(tmp_path, "bad.csv", 'date,price,customer\n2026-02-01,1,"A\nB"\n2026-02-02,2,x,y\n')
    checked = read_exports(spark, str(tmp_path))
    assert {r["customer"] for r in checked.rows.collect()} == {"A\nB", 'C "D" , E'}
    assert halts_of(checked) == {"bad.csv": "unreadable"}


def test_undefined_bytes_make_a_file_unreadable(spark, tmp_path):
    put(tmp_path, "x.csv", b"date,price,customer\n2026-02-01,1,\x81\xe9\n")
    put(tmp_path, "ok.csv", "date,price,customer\n2026-02-01,1,Á\n")
    assert halts_of(read_exports(spark, str(tmp_path))) == {"x.csv": "unreadable"}


def test_same_export_under_two_names(spark, tmp_path):
    text = "date,price,product\n2026-02-01,1,A\n2026-02-02,2,B\n"
    put(tmp_path, "one.csv", text)
    put(tmp_path, "two.csv", text)
    checked = read_exports(spark, str(tmp_path))
    assert {r["flag"] for r in rows_of(checked)} == {"flagged:duplicate"}
    assert {r["check"]: r["count"] for r in checked.issues.collect()} == {"cross_file_duplicate": 2}


def test_two_headers_for_one_column(spark, tmp_path):
    put(tmp_path, "a.csv", "date,Unit Price,price,Item Name,Product Name\n2026-02-01,9,1,A,B\n")
    checked = read_exports(spark, str(tmp_path))
    (row,) = rows_of(checked)
    assert row["price"] == 1.0 and row["product"] == "A"
    assert [r["check"] for r in checked.issues.collect()] == ["repeated_header"]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path))


def test_only_rejected_files(spark, tmp_path):
    put(tmp_path, "a.csv", "x,y\n1,2\n")
    checked = read_exports(spark, str(tmp_path))
    assert checked.rows.count() == 0 and halts_of(checked) == {"a.csv": "missing_columns"}


def test_headers():
    assert sniff_delimiter("a;b;c,d") == ";" and sniff_delimiter("price") == "," and sniff_delimiter('"a,b"\tc') == "\t"
    assert detect_layout(["Date", "Price"]) == "clean"
    mapped = map_header([" Order No ", "Service", "target", "sales_target"])
    assert mapped.columns == {"order_id": 0, "product": 1, "target": 2, "sales_target": 3}


def test_catalogue_has_a_row_for_each_file(spark, tmp_path):
    put(tmp_path, "a.csv", "date,price\n2026-02-01,1\n")
    put(tmp_path, "c.csv", 'date;"price;"\n2026-02-01;"1\n"\n')
    put(tmp_path, "e.csv", "\n \n")
    found = {r["path"][-5:]: (r["delimiter"], r["multiline"], r["header"], r["error"]) for r in catalogue(spark, list_files(spark, str(tmp_path))).collect()}
    assert found == {
        "a.csv": (",", False, ["date", "price"], None), "c.csv": (";", True, ["date", "price;"], None),
        "e.csv": (None, None, None, "no columns to parse from file"),
    }


def test_lines_are_looked_through_by_their_files_delimiter(spark, tmp_path):
    from pyspark.sql import functions as F
    from tallyforge.sources.files import read_lines, widest_lines

    put(tmp_path, "a.csv", 'date,price\n2026-02-01,"1;;;\n;"\n')
    put(tmp_path, "b.csv", 'date;price\n2026-02-01;1,2,3\n')
    put(tmp_path, "c.csv", "date;price\n2026-02-01;1;2\n")
    put(tmp_path, "d.csv", b"date,price\n2026-02-01,\x81\xe9\n")
    put(tmp_path, "e.csv", "date,pr\u00e9\n2026-02-01,1,2,3\n", "cp1252")
    paths = list_files(spark, str(tmp_path))
    found = {r["path"][-5:]: (r["delimiter"], r["charset"], r["multiline"], r["error"]) for r in catalogue(spark, paths).collect()}
    assert found == {
        "a.csv": (",", "UTF-8", True, None), "b.csv": (";", "UTF-8", False, None),
        "c.csv": (";", "UTF-8", False, "expected 2 fields in every line, saw 3"),
        "d.csv": (None, None, None, "it is neither UTF-8 nor windows-1252 text"),
        "e.csv": (",", "windows-1252", False, "expected 2 fields in every line, saw 4"),
    }
    lines = read_lines(spark, paths)
    own = lines.select("file_path").distinct().where("file_path NOT LIKE '%d.csv'").withColumn(
        "delimiter", F.expr("CASE WHEN file_path RLIKE '[bc].csv' THEN ';' ELSE ',' END")
    )
    assert {r["file_path"][-5:]: (r["widest"], r["opened"]) for r in widest_lines(lines, own).collect()} == {
        "a.csv": (2, True), "b.csv": (2, False), "c.csv": (3, False), "e.csv": (4, False),
    }


def test_records_over_several_lines_are_gathered_once(spark, tmp_path):
    from tallyforge.session import stored
    from tallyforge.sources.records import quoted_records

    put(tmp_path, "a.csv", 'a,b\n1,"x\n\ny"\n2,z\n')
    paths = list_files(spark, str(tmp_path))
    records, unclosed = quoted_records(spark, stored(catalogue(spark, paths)), paths)
    assert "collect_list" not in records._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["number"], r["record"]) for r in records.collect()) == [(1, "a,b"), (2, '1,"x\n\ny"'), (3, "2,z")]
    assert unclosed.isEmpty()


def messy_table(rnd, n):
    """Records whose cells have line breaks, blank lines, quotes, delimiters, and quotes that open nothing."""
    parts = ["a", "b c", '"', '""', ",", "\n", "\n\n", ",x", '",', "é", '\n"', " "]
    return [[f"2026-02-{i % 28 + 1:02}", str(i), "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))).strip() or "-"] for i in range(n)]


def as_csv(table, rnd):
    lines = []
    for cells in table:
        out = []
        for c in cells:
            needed = c[:1] == '"' or any(x in c for x in ",\n")
            out.append('"' + c.replace('"', '""') + '"' if needed or rnd.random() < 0.2 else c)
        lines.append(",".join(out))
        if rnd.random() < 0.1:
            lines.append(rnd.choice(["", "  "]))
    return "date,price,customer\n" + "\n".join(lines) + "\n"


@pytest.mark.parametrize(("seed", "size"), [(0, 37), (1, 200), (2, 1000), (3, 10**7)])
def test_quoted_files_in_blocks_of_any_size(spark, tmp_path, seed, size):
    rnd = random.Random(seed)
    tables = {name: messy_table(rnd, 120) for name in ("a.csv", "b.csv")}
    for name, table in tables.items():
        put(tmp_path, name, as_csv(table, rnd).replace("\n", "\r\n" if name == "b.csv" else "\n"))
    put(tmp_path, "open.csv", 'date,price,customer\n2026-02-01,1,"A\n2026-02-01,2,b\n')
    put(tmp_path, "wide.csv", 'date,price,customer\n2026-02-01,1,"A\n"\n2026-02-01,2,"b\n",c\n')
    with file_splits(spark, size):
        scan = scan_exports(spark, str(tmp_path))
        found = {(r["source_file"], r["date_text"], r["price"], r["customer"]) for r in scan.rows.collect()}
        halts = {r["source_file"]: r["message"] for r in scan.halts.collect()}
    assert found == {(name, d, float(p), c.strip()) for name, table in tables.items() for d, p, c in table}
    assert halts == {
        "open.csv": "'open.csv' couldn't be read: a quoted cell is not closed at the end of the file",
        "wide.csv": "'wide.csv' couldn't be read: expected 3 fields in every line, saw 4",
    }


def test_a_quote_within_a_cell_opens_nothing(spark, tmp_path):
    put(tmp_path, "pipes.csv", 'date,price,product,customer\n2026-02-01,1,5" pipe,A\n2026-02-01,2,6" pipe,"B ""b"""\n')
    checked = read_exports(spark, str(tmp_path))
    assert {(r["product"], r["customer"]) for r in checked.rows.collect()} == {('5" pipe', "A"), ('6" pipe', 'B "b"')}


def test_long_quoted_cells(spark, tmp_path):
    long = 'x ""y"", ' * 20_000
    put(tmp_path, "one.csv", f'date,price,customer\n2026-02-01,1,"{long}"\n')
    put(tmp_path, "two.csv", f'date,price,customer\n2026-02-01,1,"{long}\n{long}"\n')
    got = {r["source_file"]: len(r["customer"]) for r in read_exports(spark, str(tmp_path)).rows.collect()}
    cell = long.replace('""', '"')
    assert got == {"one.csv": len(cell.strip()), "two.csv": len(f"{cell}\n{cell}".strip())}


def test_the_plan_does_not_grow_with_the_headers(spark, tmp_path):
    sizes, rows = [], []
    for n in (3, 300):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            names = ["date", ("price", "Unit Price")[i % 2], "customer", f"extra {i}"]
            at = [(k + i) % 4 for k in range(4)]
            cells = ["2026-02-01", str(i), f"c{i}", "-"]
            put(folder, f"f{i}.csv", ",".join(names[k] for k in at) + "\n" + ",".join(cells[k] for k in at) + "\n")
        scan = scan_exports(spark, str(folder))
        sizes.append(sum(c.isalpha() for c in scan.rows._jdf.queryExecution().optimizedPlan().toString() if c not in "0123456789"))
        rows.append({(r["price"], r["customer"]) for r in scan.rows.collect()})
        assert rows[-1] == {(float(i), f"c{i}") for i in range(n)}
    assert abs(sizes[1] - sizes[0]) < 0.05 * sizes[0]


def book(*rows):
    return _sheet([tuple(pd.Timestamp(v) if isinstance(v, datetime.date) else v for v in r) for r in rows])


def test_workbook(spark, tmp_path):
    put(tmp_path, "book.xlsx", book(
        ("Date", "Price", "Customer", "Order ID", "Quantity"),
        (datetime.date(2026, 7, 1), 12.5, "A & B", 17, 2), (None,) * 5, (datetime.date(2026, 7, 2), 3, None, "x", 1),
    ))
    put(tmp_path, "other.xlsx", book(("date", "qty"), (datetime.date(2026, 7, 1), 1)))
    checked = read_exports(spark, str(tmp_path))
    first, second = rows_of(checked, "date")
    assert (first["price"], first["customer"], first["order_id"], first["quantity"]) == (12.5, "A & B", "17", 2.0)
    assert first["date"] == datetime.datetime(2026, 7, 1) 
    assert (second["source_file"], second["customer"], second["flag"]) == ("book.xlsx", "", "flagged:invalid_customer")
    assert halts_of(checked) == {"other.xlsx": "missing_columns"}


def lines_text(month, n=20):
    lines = [f"2026-{month:02d}-{i % 28 + 1:02d},{10 + i},P{i % 3},C{i % 2},R{i % 2},{i % 4 + 1}" for i in range(n)]
    return "date,price,product,category,region,quantity\n" + "\n".join(lines) + "\n"


def two_folders(tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
    return [str(tmp_path / "a"), str(tmp_path / "b")]


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    folders = two_folders(tmp_path)
    good = book(("date", "price"), (datetime.date(2026, 7, 1), 1), (datetime.date(2026, 7, 2), 2))
    put(tmp_path / "a", "export.xlsx", b"no workbook")
    put(tmp_path / "b", "export.xlsx", good)
    checked = read_exports(spark, folders)
    assert checked.rows.count() == 2
    (halt,) = checked.halts.collect()
    assert halt["source_file"] == "export.xlsx" and halt["file_path"].endswith("/a/export.xlsx")


def test_bad_dates_halt_one_of_two_equal_names(spark, tmp_path):
    folders = two_folders(tmp_path)
    put(tmp_path / "a", "e.csv", "date,price,order no\n" + "soon,1,\n" * 10)
    put(tmp_path / "b", "e.csv", "date,price,order no\n" + "".join(f"2026-07-{i % 28 + 1:02},{i},\n" for i in range(30)))
    checked = read_exports(spark, folders)
    assert checked.rows.count() == 30 and checked.rows.select("order_id").distinct().count() == 30
    assert [h["file_path"][-8:] for h in checked.halts.collect()] == ["/a/e.csv"]


def test_synthetic_ids_of_equal_names_differ(spark, tmp_path):
    folders = two_folders(tmp_path)
    put(tmp_path / "a", "e.csv", "date,price\n2026-07-01,1\n")
    put(tmp_path / "b", "e.csv", "date;price\n2026-07-02;1\n")
    assert read_exports(spark, folders).rows.select("order_id").distinct().count() == 2


def test_dates_with_an_offset(spark, tmp_path):
    put(tmp_path, "z.csv", "date,price\n" + "".join(f"2026-07-{i + 1:02}T23:30:00Z,{i}\n" for i in range(28)))
    put(tmp_path, "offset.csv", "date,price\n2026-07-01T23:30:00+02:00,1\n2026-07-02T00:10:00+02:00,1\n")
    checked = read_exports(spark, str(tmp_path))
    assert not halts_of(checked) and checked.rows.count() == 30
    assert {str(r["date"]) for r in checked.rows.where("source_file = 'offset.csv'").collect()} == {"2026-07-01 23:30:00", "2026-07-02 00:10:00"}


def test_runs_replace_what_they_wrote(spark, tmp_path):
    out = str(tmp_path)
    halts = spark.createDataFrame([("a.csv", "bad_dates")], "source_file string, reason string")
    write_section(halts, out, "halts", "2026-07")
    write_section(halts.limit(0), out, "halts", "2026-07")
    for found in (read_section(spark, out, "halts"), read_section(spark, out, "halts", "2026-07")):
        assert found.columns == ["source_file", "reason", "report_period"] and found.count() == 0
    write_section(halts, out, "halts", "2026-06")
    assert [r["report_period"] for r in read_section(spark, out, "halts").collect()] == ["2026-06"]


def test_curated_table_loses_months_that_are_gone(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "june.csv", lines_text(6))
    put(tmp_path / "in", "july.csv", lines_text(7))
    out, curated = str(tmp_path / "out"), str(tmp_path / "curated")
    assert write_report(spark, str(tmp_path / "in"), curated, out) == "2026-07"
    assert write_report(spark, str(tmp_path / "in" / "june.csv"), curated, out) == "2026-06"
    assert {r["period"] for r in curated_rows(spark, curated).select("period").distinct().collect()} == {"2026-06"}
    assert {r["report_period"] for r in read_section(spark, out, "summary").collect()} == {"2026-06"}


def test_whole_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "june.csv", lines_text(6))
    put(tmp_path / "in", "july.csv", lines_text(7))
    out, curated = str(tmp_path / "out"), str(tmp_path / "curated")
    assert write_report(spark, str(tmp_path / "in"), curated, out) == "2026-07"
    category = read_section(spark, out, "by_category")
    assert {r["category"] for r in category.collect()} == {"C0", "C1"}
    assert read_section(spark, out, "by_month", "2026-07").count() == 2
    assert read_section(spark, out, "banner").first()["halts"] == 0
    # A later month replaces nothing of the earlier one.
    put(tmp_path / "in", "august.csv", lines_text(8))
    assert write_report(spark, str(tmp_path / "in"), curated, out) == "2026-08"
    assert read_section(spark, out, "by_category", "2026-07").count() == 2
    assert {r["report_period"] for r in read_section(spark, out, "summary").collect()} == {"2026-08"}


def test_curated_table_is_pruned_by_month(spark, tmp_path):
    from tallyforge.operators.summaries import category_summary

    put(tmp_path, "june.csv", lines_text(6))
    put(tmp_path, "july.csv", lines_text(7))
    out = write_curated(with_measures(read_exports(spark, str(tmp_path)).rows), str(tmp_path / "curated"))
    table = category_summary(curated_rows(spark, out), "2026-07", "2026-06")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [period" in plan and "customer" not in plan.split("ReadSchema")[1]


def test_new_files_only(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    folder.mkdir()
    put(folder, "june.csv", lines_text(6))
    put(folder, "bad.csv", "a,b\n1,2\n")
    ingest_new_files(spark, str(folder), table, state)
    assert stored_rows(spark, table).count() == 20
    put(folder, "july.csv", lines_text(7))
    put(folder, "june copy.csv", lines_text(6))
    ingest_new_files(spark, str(folder), table, state)
    rows = stored_rows(spark, table)
    assert rows.count() == 60 and rows.select("source_file").distinct().count() == 3
    july = review_rows(spark, table, "2026-07", None)
    assert july.count() == 20 and july.where("size(dq) > 0").count() == 0
    assert review_rows(spark, table, "2026-07", "2026-06").where("array_contains(dq, 'flagged:duplicate')").count() == 40
    issues = {r["check"]: r["count"] for r in stored_issues(spark, table).collect()}
    assert issues == {"cross_file_duplicate": 20}
    ingest_new_files(spark, str(folder), table, state)
    assert stored_rows(spark, table).count() == 60


def test_a_second_batch_reads_only_its_own_months(spark, tmp_path):
    folder, table, state = tmp_path / "in", tmp_path / "table", str(tmp_path / "state")
    folder.mkdir()
    put(folder, "june.csv", lines_text(6))
    put(folder, "july.csv", lines_text(7) + lines_text(7, 3).split("\n", 1)[1])
    ingest_new_files(spark, str(folder), str(table), state)
    assert {r["check"]: r["count"] for r in stored_issues(spark, str(table)).collect()} == {"duplicate": 3, "cross_file_duplicate": 3}
    # Nothing can read June any more: its rows and counts are no Parquet files.
    june = [p for kind in ("rows", "keys") for p in (table / kind / "period=2026-06").rglob("*.parquet")]
    kept = {p: p.read_bytes() for p in june}
    for p in june:
        p.write_bytes(b"gone")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    put(folder, "july copy.csv", lines_text(7, 5))
    ingest_new_files(spark, str(folder), str(table), state)
    for p, content in kept.items():
        p.write_bytes(content)
    issues = {(r["source_file"], r["check"]): r["count"] for r in stored_issues(spark, str(table)).collect()}
    assert issues == {("july.csv", "duplicate"): 3, (None, "cross_file_duplicate"): 8}
    whole = {(r["source_file"], r["check"]): r["count"] for r in read_exports(spark, str(folder)).issues.collect()}
    assert issues == whole


def test_months_of_a_stored_table_without_a_scan(spark, tmp_path):
    put(tmp_path, "june.csv", lines_text(6))
    put(tmp_path, "july.csv", lines_text(7))
    out = write_curated(with_measures(read_exports(spark, str(tmp_path)).rows), str(tmp_path / "curated"))
    rows = curated_rows(spark, out)
    assert stored_periods(rows) == ["2026-07", "2026-06"] and latest_two_stored(rows) == latest_two(rows)
    for p in (tmp_path / "curated").rglob("*.parquet"):
        p.write_bytes(b"gone")
    assert latest_two_stored(rows) == ("2026-07", "2026-06")
    assert latest_two_stored(spark.read.schema("date timestamp_ntz, period string").parquet(str(tmp_path / "curated" / "period=2026-07"))) == ("2026-07", None)


def test_file_order_is_noticed(spark, tmp_path):
    put(tmp_path, "june.csv", lines_text(6, 60))
    rows = with_measures(read_exports(spark, str(tmp_path)).rows)
    assert dates_fall(spark, write_curated(rows, str(tmp_path / "a"))).agg({"falls": "sum"}).first()[0] == 0
    rows.coalesce(1).write.partitionBy("period").parquet(str(tmp_path / "b"))
    assert dates_fall(spark, str(tmp_path / "b")).agg({"falls": "sum"}).first()[0] > 0


def test_readers_see_whole_runs_only(spark, tmp_path):
    from pyspark.sql import functions as F

    out = str(tmp_path / "report")
    table = spark.range(3).withColumnRenamed("id", "n")
    write_sections({"a": table, "b": table}, out, "2026-06")
    broken = table.withColumn("n", F.expr("CASE WHEN n = 2 THEN raise_error('stopped') ELSE n END"))
    open_before = read_section(spark, out, "a")
    with pytest.raises(Exception, match="stopped"):
        write_sections({"a": table.limit(1), "b": broken}, out, "2026-06")
    assert len(commits(spark, out)) == 1
    for section in ("a", "b"):
        assert read_section(spark, out, section).count() == read_section(spark, out, section, "2026-06").count() == 3
    write_sections({"a": table.limit(2)}, out, "2026-07")
    write_sections({"a": table.limit(1)}, out, "2026-06")
    assert read_section(spark, out, "a").count() == 1 and read_section(spark, out, "a", "2026-07").count() == 2
    assert read_section(spark, out, "b").count() == 3 and open_before.count() == 3
    # The failed run's two directories, if it began both, and the replaced one of June.
    assert drop_superseded(spark, out) >= 2 and drop_superseded(spark, out) == 0
    assert set(section_paths(spark, out)) == {"a", "b"} and read_section(spark, out, "b").count() == 3
    with pytest.raises(KeyError):
        read_section(spark, out, "c")


def test_old_charset_in_quoted_files(spark, tmp_path):
    put(tmp_path, "old.csv", 'date;price;customer\r\n2026-02-01;1;"Zoë €5\r\nx"\r\n2026-02-02;2;"Ÿ"\r\n', "cp1252")
    checked = read_exports(spark, str(tmp_path))
    assert {r["customer"] for r in checked.rows.collect()} == {"Zoë €5\nx", "Ÿ"} and not halts_of(checked)


def test_header_lines_once_more_and_header_alone(spark, tmp_path):
    header = "date,price,customer\n"
    put(tmp_path, "twice.csv", header + "".join(f"2026-02-{i % 28 + 1:02},{i},c\n" for i in range(40)) + header)
    put(tmp_path, "quoted.csv", header + "".join(f'2026-02-{i % 28 + 1:02},{i},"c\n"\n' for i in range(40)) + header)
    put(tmp_path, "alone.csv", header)
    checked = read_exports(spark, str(tmp_path))
    assert not halts_of(checked) and checked.rows.count() == 80
    assert {(r["source_file"], r["check"]): r["count"] for r in checked.issues.where("check = 'bad_date'").collect()} == {
        ("twice.csv", "bad_date"): 1, ("quoted.csv", "bad_date"): 1,
    }


def test_line_totals_of_files_with_different_headers(spark, tmp_path):
    from tallyforge.sources.line_totals import read_line_totals

    put(tmp_path, "a.csv", "Order ID,Sales,Region\nA,1.5,West\nB,NA,\n")
    put(tmp_path, "b.csv", 'Region;Order ID;Note\nEast;C;"two\nlines"\n')
    rows = read_line_totals(spark, str(tmp_path))
    assert sorted(rows.columns) == ["Note", "Order ID", "Region", "Sales"]
    assert {(r["Order ID"], r["Sales"], r["Region"], r["Note"]) for r in rows.collect()} == {
        ("A", 1.5, "West", None), ("B", None, None, None), ("C", None, "East", "two\nlines"),
    }
    put(tmp_path, "c.csv", "Order ID,Sales\nA,1,2\n")
    with pytest.raises(ValueError, match="saw 3"):
        read_line_totals(spark, str(tmp_path))


def test_the_plan_has_only_the_layouts_and_date_formats_that_occur(spark, tmp_path):
    from tallyforge.sources.exports import with_dates

    put(tmp_path, "a.csv", "date,price,product,note\n2026-02-01,5,Pen,x\n2026-02-03,6,Cap,y\n")
    put(tmp_path, "b.csv", "date,price,product,note\n3/1/2026,7,Pen,x\n")
    rows = scan_exports(spark, str(tmp_path)).rows
    dated = with_dates(rows)
    plan = dated._jdf.queryExecution().executedPlan().toString()
    assert "d-MMM-yyyy" not in plan and "line_total" not in plan and "c3:string" not in plan and "c2:string" in plan
    assert {(r["date"].isoformat()[:10], r["price"]) for r in dated.collect()} == {("2026-02-01", 5.0), ("2026-02-03", 6.0), ("2026-03-01", 7.0)}
    # A file whose first date is in no known format is read value by value, with all formats.
    put(tmp_path, "c.csv", "date,price\nsoon,8\n5-Feb-2026,9\n")
    mixed = with_dates(scan_exports(spark, str(tmp_path)).rows)
    assert {(str(r["date"])[:10], r["price"]) for r in mixed.collect()} == {
        ("2026-02-01", 5.0), ("2026-02-03", 6.0), ("2026-03-01", 7.0), ("None", 8.0), ("2026-02-05", 9.0),
    }


def test_layouts_with_other_places_of_columns_in_one_folder(spark, tmp_path):
    put(tmp_path, "a.csv", "date,price,region\n2026-02-01,5,West\n")
    put(tmp_path, "b.csv", "region,date,price\nEast,2026-02-02,6\n")
    put(tmp_path, "c.csv", "Order ID;Order Date;Customer Name;Product Name;Category;Region;Quantity;Discount;Profit;Sales\n1;02/03/2026;Ann;Pen;o'brien;MIDDLE EAST;2;0;1;14\n")
    checked = read_exports(spark, str(tmp_path))
    assert {(r["region"], r["price"], r["category"], r["date"].day) for r in checked.rows.collect()} == {
        ("West", 5.0, "Unknown", 1), ("East", 6.0, "Unknown", 2), ("Middle East", 7.0, "O'Brien", 3),
    }


def test_counting_copies_writes_no_rows(spark, tmp_path, monkeypatch):
    from tallyforge.schema import BUSINESS_COLUMNS
    from tallyforge.streaming import incremental

    kept = []
    store = incremental.stored
    monkeypatch.setattr(incremental, "stored", lambda table: kept.append(table.columns) or store(table))
    folder = tmp_path / "in"
    folder.mkdir()
    for name, rows in (("a", ["2026-01-01,1,Pen", "2026-01-01,1,Pen", "2026-02-01,1,Pen", "2026-02-01,2,"]), ("b", ["2026-01-01,1,Pen", "2026-02-01,2,", "2026-02-02,2,Pen"])):
        put(folder, f"{name}.csv", "\n".join(["date,price,product", *rows, ""]))
        ingest_new_files(spark, str(folder), str(tmp_path / "table"), str(tmp_path / "state"))
    assert kept and not any(set(BUSINESS_COLUMNS) & set(columns) for columns in kept)
    found = stored_issues(spark, str(tmp_path / "table")).where("check IN ('duplicate', 'cross_file_duplicate')")
    assert {(r["source_file"], r["count"]) for r in found.collect()} == {("a.csv", 1), (None, 3)}


def test_each_date_of_a_workbook_is_formatted_once(monkeypatch):
    from tallyforge.sources import workbook

    made = []
    monkeypatch.setattr(workbook, "timedelta", lambda **parts: made.append(parts) or datetime.timedelta(**parts))
    days = [pd.Timestamp("2026-02-01 23:00"), pd.Timestamp("1899-12-29 01:00"), pd.Timestamp("2026-02-01")] * 3
    rows = list(workbook.sheet_rows(_sheet([("date", "price"), *[(d, 1.5) for d in days]])))
    assert rows[1:] == [["2026-02-01 00:00:00", "1.5"], ["1899-12-29 00:00:00", "1.5"], ["2026-02-01 00:00:00", "1.5"]] * 3
    assert len(made) == 2


def test_rows_are_shuffled_by_month_without_their_measures(spark):
    """What is made of a row's columns need not be sent along with them."""
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2026-07-01' AS date, id * 1D AS quantity, 2D AS price, 0D AS discount, 1D AS profit FROM range(10)")
    found = incremental._by_month(rows)
    assert found.columns == [*rows.columns, "gross_sales", "discount_amount", "revenue", "margin", "period"]
    above, sent, below = found._jdf.queryExecution().optimizedPlan().toString().partition("RebalancePartitions")
    assert sent and "gross_sales" in above and "gross_sales" not in below
