"""Exported workbooks rendered from the order and part tables, as raw sheet rows.

Cells are text and spelled the way exports spell them: blanks, nan words, several date
shapes, padded numbers, differing headers per file.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator
from itertools import islice
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyshelf import session
from tallyshelf.operators import align
from tallyshelf.registry.tables import spread, table


def _header(*names: str) -> str:
    return "array({})".format(", ".join(f"'{n}'" for n in names))


def _sheet(
    rows: DataFrame, path: str, sheet: str, header: str, cells: list[str], kinds: list[str], *extra: str, land: bool = True
) -> DataFrame:
    """Raw sheet rows from SQL expressions; an empty cell is missing.

    They are landed as a table; ``land=False`` is for a job that reads them once and lands them itself.
    """
    shown = rows.selectExpr(
        *extra,
        f"{path} AS path",
        f"{sheet} AS sheet",
        "0 AS sheet_pos",
        "1 AS row_idx",
        f"{header} AS header",
        "array({}) AS cells".format(", ".join(f"CAST({c} AS STRING)" for c in cells)),
        "array({}) AS said".format(", ".join(kinds)),
        "CAST(NULL AS STRING) AS error",
    )
    missing = "IF(coalesce(cells[{0}], '') = '', 'e', said[{0}])".format
    kinds_col = F.expr("array({})".format(", ".join(missing(i) for i in range(len(cells)))))
    raw = shown.withColumns({"kinds": kinds_col, "layout": align.layout_key()}).drop("said")
    return session.written(raw, "sheet") if land else raw


def order_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Thirteen columns by position; the last is surplus."""
    lines = spread(spark, sf, "lineitem")
    rows = lines.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    cells = [
        "concat('SO', l_orderkey)",
        "CASE l_linenumber WHEN 7 THEN 'NaT' WHEN 6 THEN 'nan' ELSE CAST(l_orderkey AS STRING) END",
        "lpad(CAST(l_partkey AS STRING), 8, '0')",
        "concat(' ', p_name)",
        "CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN CAST(l_quantity AS STRING) ELSE concat(CAST(l_quantity AS BIGINT), '.9') END",
        "l_extendedprice",
        "IF(l_linestatus = 'F', 'N/A', ' Flash ')",
        "IF(l_discount = 0, NULL, CAST(l_discount AS STRING))",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')",
        "date_format(l_shipdate, 'yyyy/MM/dd')",
        "CASE l_returnflag WHEN 'R' THEN 'not a date' WHEN 'A' THEN date_format(l_shipdate, 'yyyy-MM-dd') ELSE date_format(l_shipdate, 'MM/dd/yyyy HH:mm') END",
        "o_orderstatus",
        "'surplus'",
    ]
    names = [f"Column {i}" for i in range(len(cells))]
    return _sheet(rows, "'/in/completed_orders.xlsx'", "'Sheet1'", _header(*names), cells, ["'s'"] * len(cells))


STOCK_NAMES = (
    "ListingId",
    "SkuId",
    "Extra",
    "Vendor Product Id",
    "Title",
    "Currency",
    "Market Reference Price",
    "Selling Price",
    "FBK Inventory",
    "Non-FBK Inventory",
    "Status",
)


def stock_sheet(spark: SparkSession, sf: str) -> DataFrame:
    sold = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("sold"))
    rows = table(spark, sf, "part").join(sold, F.col("p_partkey") == F.col("l_partkey"), "left")
    cells = [
        "concat('0', p_partkey)",
        "12345678901234567 + p_partkey",
        "'x'",
        "IF(p_size % 9 = 0, 'N/A', concat('V', p_partkey))",
        "p_name",
        "'KES'",
        "CASE p_size % 6 WHEN 0 THEN '5d' WHEN 1 THEN '1,200' WHEN 2 THEN ' 5 ' WHEN 3 THEN '1e3' WHEN 4 THEN '' ELSE CAST(p_retailprice AS STRING) END",
        "p_retailprice",
        "sold",
        "CASE p_size % 3 WHEN 0 THEN 'none' WHEN 1 THEN concat(p_size, '.0') ELSE CAST(p_size AS STRING) END",
        "lower(p_type)",
    ]
    return _sheet(rows, "'/in/stock.xlsx'", "'Sheet1'", _header(*STOCK_NAMES), cells, ["'s'"] * len(cells))


# --- weekly statements -------------------------------------------------------------------

# One file per month and store. Odd and even months head their columns differently, February
# names an impossible day, and April leaves the store out of the name.
_STORE = "concat('s', {store} % 4)"
_PATH = """concat('/in/weekly/', CASE month({day})
    WHEN 2 THEN concat(date_format({day}, 'yyyyMM'), '31_', date_format({day}, 'yyyyMM'), '28_', {name})
    WHEN 4 THEN concat(date_format({day}, 'yyyyMM'), '01_', date_format({day}, 'yyyyMM'), '28')
    ELSE concat(date_format({day}, 'yyyyMM'), '01_', date_format({day}, 'yyyyMM'), '28_', {name}) END, '.xlsx')"""


def _path(day: str, store: str) -> str:
    return _PATH.format(day=day, name=_STORE.format(store=store))


DETAIL_ODD = (
    "Store ID",
    "Store Name",
    "Order SN",
    "Payment Time",
    "Finnshed Time",
    "Goods ID",
    "Goods Name",
    "Goods Price",
    "Goods Num",
    "Rate",
    "Complete Amount",
    "Fine",
    "Weight (kg)",
    "Lot",
    "Checked",
    "Scan Date",
    "Note",
    "Score",
    "Mixed",
    "Blank",
)
DETAIL_EVEN = (
    "store id",
    "Store Name",
    "Order SN",
    "Payment Time",
    "Finnshed Time",
    "Goods ID",
    "Goods Name",
    "Goods Price",
    "Goods Num",
    "Rate",
    "Complete Amount",
    "Settlement",
    "Weight（kg）",
    "Weight (kg)",
    "Checked",
    "Scan Date",
    "Note",
    "Score",
    "Mixed",
    "Blank",
)


def detail_sheets(spark: SparkSession, sf: str, land: bool = True) -> DataFrame:
    """The ``bill details`` tab, one row per order line.

    The join deals the lines to all cores, so they are moved once, and looks names up without sorting the lines.
    """
    names = table(spark, sf, "part").select("p_partkey", "p_name").hint("shuffle_hash")
    rows = table(spark, sf, "lineitem").join(names, F.col("l_partkey") == F.col("p_partkey"))
    odd = "month(l_shipdate) % 2 = 1"
    cells = [
        "concat(' S', l_suppkey % 4, ' ')",
        "CASE l_linestatus WHEN 'O' THEN 'nan' ELSE concat('Store ', l_suppkey % 4) END",
        "concat(repeat(',', CAST(l_linenumber % 3 AS INT)), 'SN', l_orderkey)",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')",
        "IF(l_returnflag = 'N', '', date_format(l_shipdate, 'yyyy/MM/dd HH:mm'))",
        "lpad(CAST(l_partkey AS STRING), 6, '0')",
        "p_name",
        "IF(l_returnflag = 'R', '1,200', CAST(l_extendedprice AS STRING))",
        "IF(l_returnflag = 'A', concat(' ', CAST(l_quantity AS BIGINT)), CAST(l_quantity AS STRING))",
        "IF(l_tax = 0, 'NULL', CAST(l_tax AS STRING))",
        "l_extendedprice",
        "l_discount",
        "l_linenumber",
        "l_suppkey",
        "IF(l_linestatus = 'O', 'True', 'False')",
        "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')",
        "concat(' ', l_returnflag, ' ')",
        "l_quantity / 4",
        "IF(l_returnflag = 'A', CAST(l_linenumber AS STRING), concat('m', l_linenumber))",
        "''",
    ]
    kinds = ["'s'"] * 12 + ["'n'", "'n'", "'b'", "'d'", "'s'", "'n'", "IF(l_returnflag = 'A', 'n', 's')", "'s'"]
    header = f"IF({odd}, {_header(*DETAIL_ODD)}, {_header(*DETAIL_EVEN)})"
    return _sheet(
        rows, _path("l_shipdate", "l_suppkey"), f"IF({odd}, 'bill details', ' Bill Details ')", header, cells, kinds, land=land
    )


BILL_ODD = ("Store ID", "Total Valume", "Goods Number", "Settlement Payable(1)", "Settlement Payable (2)", "Remark")
BILL_EVEN = ("store id", "Total Valume", "Goods Number", "Settlement Payable (1)", "Settlement Payable（2）", "Remark")


def bill_sheets(spark: SparkSession, sf: str, land: bool = True) -> DataFrame:
    """The ``bill`` tab, one row per order."""
    odd = "month(o_orderdate) % 2 = 1"
    cells = [
        "concat('S', o_custkey % 4)",
        "o_totalprice",
        "concat(o_custkey, '.0')",
        "o_totalprice / 2",
        "IF(o_orderstatus = 'P', 'pending', CAST(o_totalprice / 4 AS STRING))",
        "CASE o_orderstatus WHEN 'O' THEN 'None' WHEN 'F' THEN ' NaT ' ELSE concat('\t', o_orderpriority, ' ') END",
    ]
    header = f"IF({odd}, {_header(*BILL_ODD)}, {_header(*BILL_EVEN)})"
    return _sheet(
        spread(spark, sf, "orders"), _path("o_orderdate", "o_custkey"), "'Bill'", header, cells, ["'s'"] * len(cells), "o_orderkey", land=land
    )


def storage_sheets(spark: SparkSession, sf: str, land: bool = True) -> DataFrame:
    """The ``storage fee`` tab: no declared columns beyond the lineage."""
    cells = ["event_id", "user_id", "value", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "event_type"]
    return _sheet(
        spread(spark, sf, "events"),
        _path("ts", "user_id"),
        "'STORAGE FEE'",
        _header("Row", "Shelf No.", "Fee (KES)", "Stored Since", "Kind"),
        cells,
        ["'n'", "'n'", "'n'", "'d'", "'s'"],
        land=land,
    )


#: Statement tabs that declare no columns of their own.
FEE_TABS = (
    "operation fee", "ds processing fee", "fine", "other deductions", "customer service discount", "billing appeal", "compensation"
)


def fee_sheets(spark: SparkSession, sf: str, land: bool = True) -> DataFrame:
    """The other tabs, one row per order; some rows are blank, and sheets of June have no data."""
    names = _header(*(f" {t.title()}" for t in FEE_TABS))
    blank = "IF(o_orderkey % 11 = 0, '', {})".format
    cells = [blank("concat('T', o_custkey % 5)"), blank("CAST(o_totalprice AS STRING)"), blank("o_orderpriority")]
    rows = _sheet(
        spread(spark, sf, "orders"),
        _path("o_orderdate", "o_custkey"),
        f"element_at({names}, CAST(1 + o_orderkey % {len(FEE_TABS)} AS INT))",
        _header("Store", "Amount (KES)", "Reason"),
        cells,
        ["'s'"] * len(cells),
        "month(o_orderdate) = 6 AS no_data",
        land=land,
    )
    return rows.withColumn("row_idx", F.when(F.col("no_data"), 0).otherwise(1)).drop("no_data")


def day_first_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """The ``bill details`` tab with slashed dates: one column puts the day first, one the month, one neither."""
    cells = [
        "concat('SN', l_orderkey)",
        "date_format(l_shipdate, 'dd/MM/yyyy HH:mm')",
        "date_format(l_shipdate, 'MM/dd/yyyy')",
    ]
    return _sheet(
        spread(spark, sf, "lineitem"),
        _path("l_shipdate", "l_suppkey"),
        "'Bill Details'",
        _header("Order SN", "Payment Time", "Finnshed Time"),
        cells,
        ["'s'"] * len(cells),
    )


# --- real workbooks ----------------------------------------------------------------------


_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_extendedprice", "serial", "l_linestatus", "l_returnflag")


def _xlsx(rows: Iterable[tuple]) -> bytes:
    """A workbook with the given lines (``_LINE_COLUMNS``) on its second sheet: shared strings, a date style,
    booleans, numbers, an inline string and a missing cell."""
    strings: dict[str, int] = {}

    def shared(value: str) -> str:
        return f'<c t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'

    lines = ["<row>" + "".join(shared(h) for h in ("Order", "Line", "Price", "Shipped", "Open", "Flag", "Empty")) + "</row>"]
    for order, line, price, serial, status, flag in rows:
        missing = "<c/>" if line == 7 else f"<c><v>{line}</v></c>"
        lines.append(
            f"<row>{shared(f'00{order}')}{missing}<c><v>{price!r}</v></c>"
            f'<c s="1"><v>{serial}</v></c><c t="b"><v>{int(status == "O")}</v></c>'
            f'<c t="inlineStr"><is><t>{escape("<" + flag + "&")}</t></is></c><c t="e"><v>#N/A</v></c></row>'
        )
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    members = {
        "xl/workbook.xml": f'<workbook {ns} {rel}><sheets><sheet name="Cover" r:id="rId1"/><sheet name=" Lines " r:id="rId2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/a.xml"/><Relationship Id="rId2" Target="worksheets/b.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/a.xml": f"<worksheet {ns}><sheetData/></worksheet>",
        "xl/worksheets/b.xml": f"<worksheet {ns}><sheetData>{''.join(lines)}</sheetData></worksheet>",
    }
    members["xl/sharedStrings.xml"] = f"<sst {ns}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        for name, body in members.items():
            book.writestr(name, body)
    return out.getvalue()


def workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """``path, content``: the order lines of each order-number range as one real workbook.

    A range holds a few hundred lines, so a workbook is small whatever the table's size.
    """
    lines = table(spark, sf, "lineitem").selectExpr(
        "concat('/in/lines-', l_orderkey div 100, '.xlsx') AS path",
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "datediff(CAST(l_shipdate AS DATE), DATE '1899-12-30') AS serial",
        "l_linestatus",
        "l_returnflag",
    )
    books = lines.groupBy("path").agg(F.collect_list(F.struct(*_LINE_COLUMNS)).alias("rows"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, rows = batch.column("path"), batch.column("rows")
            lines = zip(*[c.to_pylist() for c in rows.flatten().flatten()])
            books = [_xlsx(islice(lines, n)) for n in pc.list_value_length(rows).to_pylist()]
            yield pa.RecordBatch.from_arrays([paths, pa.array(books, pa.binary())], ["path", "content"])

    return books.mapInArrow(pack, "path STRING, content BINARY")


def cell_text(name: str) -> Column:
    return F.get("cells", F.array_position("header", F.lit(name)).cast("int") - 1)
