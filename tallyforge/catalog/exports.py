"""Export files that Spark writes from the tables, for the queries on sources and sinks."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir, shuffles_dropped
from ..sources.star import star_items, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_csv(rows: DataFrame, out: str, sep: str = ",", charset: str = "UTF-8") -> str:
    writer = rows.write.option("header", True).option("sep", sep).option("encoding", charset).option("escape", '"')
    with shuffles_dropped(rows.sparkSession):
        writer.csv(out)
    return out


def write_lines(rows: DataFrame, header: str, line: str, out: str) -> str:
    """Lines as they are, under a header as it is."""
    rows.selectExpr(f"{line} AS `{header}`").write.option("header", True).option("sep", "\x01").option(
        "quote", ""
    ).csv(out)
    return out


def raw_cells(rows: DataFrame, columns: dict[str, str], file: str) -> DataFrame:
    """Text cells ``c0..cN`` under the given headers, as a file scan would give them."""
    return rows.selectExpr(
        *[f"string({c}) AS c{i}" for i, c in enumerate(columns.values())],
        f"'{file}' AS file_path", "0L AS block_start",
        "monotonically_increasing_id() AS row_id",
    )


# Header -> cell of the raw layouts.  Underscore: currency and percent text, mixed case.
UNDERSCORE_CELLS = {
    "Order_ID": "order_id",
    "Order_Date": "date_format(date, 'M/d/yyyy')",
    "Customer_Name": "' Ann '",
    "Product": "product",
    "Product_Category": "lower(category)",
    "Region": "lower(region)",
    "Units_Sold": "int(quantity)",
    "Unit_Price": "concat('$', format_number(price, 2))",
    "Discount_Pct": "concat(int(rint(discount * 100)), '%')",
    "Profit": "concat(CASE WHEN profit < 0 THEN '--$' ELSE '$' END, format_number(abs(profit), 2))",
}

# Line totals instead of a price.
LINE_TOTAL_CELLS = {
    "Order ID": "order_id",
    "Order Date": "date_format(date, 'MM/dd/yyyy')",
    "Customer Name": "'Ann'",
    "Product Name": "product",
    "Category": "category",
    "Region": "region",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
    "Sales": "quantity * price * (1 - discount)",
}

CLEAN_CELLS = {
    " Date": "date", "PRICE": "price", "Product Name": "product", "category": "category", "Region ": "region",
    "quantity": "quantity", "discount": "discount", "profit": "profit", "Invoice Number": "order_id",
}

_ITEM_CELLS = ("date", "order_id", "product", "category", "region", "quantity", "price", "discount", "profit")


def mixed_exports(spark: SparkSession, d: str) -> str:
    """One folder of exports in all layouts: the line items split by return flag.

    A: clean layout, ``;``; N: underscore layout, tabs; R: line-total layout,
    commas.  Part files of the three writes end up in one folder.
    """
    rows = star_items(spark, d, *_ITEM_CELLS, "return_flag", labels=False)
    out = shared_dir(spark)
    for flag, cells, sep in (("A", CLEAN_CELLS, ";"), ("N", UNDERSCORE_CELLS, "\t"), ("R", LINE_TOTAL_CELLS, ",")):
        part = rows.where(f"return_flag = '{flag}'").selectExpr(*[f"{c} AS `{h}`" for h, c in cells.items()])
        part.write.mode("append").option("header", True).option("sep", sep).option("escape", '"').csv(out)
    return out


def undated_export(spark: SparkSession, d: str, out: str) -> None:
    """A further export whose dates cannot be read, and one without a price."""
    rows = table(spark, d, "customer")
    for cells in (["'soon' AS date", "'5' AS price", "c_name AS product"], ["'2001-01-01' AS date", "c_name AS product"]):
        rows.selectExpr(*cells).write.mode("append").option("header", True).csv(out)


# --------------------------------------------------------------- workbooks

def _sheet(rows: Iterator[tuple]) -> bytes:
    """A minimal workbook: inline text, numbers, and dates as styled serials."""

    epoch = pd.Timestamp(1899, 12, 30).toordinal()

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, pd.Timestamp):
            return f'<c s="1"><v>{v.toordinal() - epoch}</v></c>'
        if isinstance(v, str):
            return f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>'
        return f"<c><v>{v!r}</v></c>"

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{link}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def write_workbooks(rows: DataFrame, out: str, broken: bool = False) -> str:
    """The rows as ``.xlsx`` files, written by Spark: each a text file of one record, the book's bytes, and then named.

    The line feed that ends the record is no part of the book; zip readers skip it.
    """
    content = "substr(content, 40)" if broken else "content"
    books = workbooks_of(rows).selectExpr(f"CAST({content} AS STRING) AS value")
    books.write.option("maxRecordsPerFile", 1).text(out)
    name_files(rows.sparkSession, out, ".xlsx")
    return out


def name_files(spark: SparkSession, out: str, suffix: str) -> None:
    """Give the files that Spark wrote another suffix."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(out)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in files.listStatus(folder):
        own = found.getPath().getName()
        if own.startswith("part-"):
            files.rename(found.getPath(), hadoop.Path(folder, own.rsplit(".", 1)[0] + suffix))


def number_files(spark: SparkSession, out: str, name: str, suffix: str) -> None:
    """Name the files that Spark wrote by their place in the folder: ``name_0``, ``name_1`` and so on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(out)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(f.getPath().getName() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        files.rename(hadoop.Path(folder, part), hadoop.Path(folder, f"{name}_{i}{suffix}"))


@contextmanager
def file_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """Scans planned meanwhile split files into blocks of at most ``size`` bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(size))
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def workbooks_of(rows: DataFrame) -> DataFrame:
    """The rows as workbooks ``(path, content)``, one per Arrow batch."""
    names = rows.columns

    def pack(batches):
        for pdf in batches:
            values = pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)
            content = _sheet([tuple(names), *values])
            yield pd.DataFrame({"path": [f"book-{pd.util.hash_pandas_object(pdf).sum()}.xlsx"], "content": [content]})

    return rows.mapInPandas(pack, "path string, content binary")

