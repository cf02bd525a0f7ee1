"""Registered queries over exported workbooks and over the ledger's sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf import session
from tallyshelf.functions.text import NA_TOKENS
from tallyshelf.operators import align, metrics, sinks
from tallyshelf.plans import ledger
from tallyshelf.plans.schemas import CATALOGUE, COMPLETED_ORDERS, STATEMENT_SCHEMAS, STATEMENT_TABS, STOCK
from tallyshelf.registry import rendered_sheets as rs
from tallyshelf.registry.tables import RUN_TS, table
from tallyshelf.sources import exports, workbook

SHOP = "Example Store"


def completed_orders(spark, sf):
    return ledger.completed_orders(rs.order_sheet(spark, sf), SHOP, land=False)


def stock(spark, sf):
    return ledger.stock(rs.stock_sheet(spark, sf), SHOP, RUN_TS)


def _statement(spark: SparkSession, raw: DataFrame, tab: str, mode: str = "first") -> DataFrame:
    return ledger.weekly_statements(ledger.statement_rows(raw), STATEMENT_SCHEMAS, mode, land=False)[tab]


def weekly_bill_details(spark, sf):
    return _statement(spark, rs.detail_sheets(spark, sf), "bill details")


def weekly_bill(spark, sf):
    return _statement(spark, rs.bill_sheets(spark, sf), "bill")


def weekly_bill_coalesced(spark, sf):
    """Loss-free mode: values under either spelling of a header are kept."""
    return _statement(spark, rs.bill_sheets(spark, sf), "bill", "coalesce").select(
        "source_filename", "store_id", "settlement_payable_1", "settlement_payable__1", "settlement_payable_2"
    )


def weekly_storage_fee(spark, sf):
    return _statement(spark, rs.storage_sheets(spark, sf), "storage fee")


def weekly_day_first(spark, sf):
    """Each time column follows its own order of day and month."""
    return _statement(spark, rs.day_first_sheets(spark, sf), "bill details").select(
        "source_filename", "order_sn", "payment_time", "finnshed_time"
    )


def _every_tab(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets of all tabs, not landed: the statements land them, by tab, in the one pass that reads them."""
    made = [f(spark, sf, land=False) for f in (rs.detail_sheets, rs.bill_sheets, rs.storage_sheets, rs.fee_sheets)]
    sheets = [made[0], made[1].drop("o_orderkey"), *made[2:]]
    return reduce(DataFrame.unionByName, sheets)


def all_statement_tabs(spark, sf):
    """Rows per file of all ten tabs read in one go."""
    raw = _every_tab(spark, sf)
    frames = ledger.weekly_statements(ledger.statement_rows(raw))
    counts = None
    for tab, frame in frames.items():
        one = metrics.counts_by(frame.withColumn("tab", F.lit(tab)), ["tab", "source_filename", "statement_start_date"])
        counts = one if counts is None else counts.unionByName(one)
    return counts


def statement_tables(spark, sf):
    """Every tab into its own table; rows and columns read back from the tables."""
    prefix = _fresh("weekly") + "_"
    with session.scratch_scope(spark):
        raw = _every_tab(spark, sf)
        outcome = sinks.write_tabs(ledger.weekly_statements(ledger.statement_rows(raw)), STATEMENT_TABS, prefix)
    stored = [
        spark.table(prefix + STATEMENT_TABS[tab]).agg(
            F.lit(tab).alias("tab"), F.lit(said).alias("outcome"), F.count("*").alias("rows"),
            F.count("statement_start_date").alias("dated"), F.count_distinct("source_filename").alias("files"),
        )
        for tab, said in outcome.items()
    ]
    return reduce(DataFrame.unionByName, stored)


def tab_failures(spark, sf):
    """Four tabs, of which one fails while it is written: the others are stored, the failure is reported."""
    prefix = _fresh("tabs") + "_"
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    broken = rows.withColumn("bad", F.when(F.col("o_orderkey") % 2 == 1, F.raise_error(F.lit("no such fee")).cast("int")))
    frames = {"bill": rows, "fine": broken, "storage fee": rows.filter("o_orderstatus = 'F'"), "compensation": rows.filter("false")}
    outcome = sinks.write_tabs(frames, STATEMENT_TABS, prefix)
    found = []
    for tab, said in outcome.items():
        stored = spark.table(prefix + STATEMENT_TABS[tab]) if said == "ok" else rows.filter("false")
        failed = F.lit(said).contains("no such fee")
        found.append(stored.agg(F.lit(tab).alias("tab"), failed.alias("failed"), F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, found)


def csv_export(spark, sf):
    """The stock list as a CSV export: the same job from another file format."""
    spot = f"{session.scratch_root(spark)}/{_fresh('stock_csv')}"
    cells = F.col("cells")
    named = [F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(rs.STOCK_NAMES)]
    rs.stock_sheet(spark, sf).select(*named).write.option("header", True).csv(spot)
    return ledger.stock(exports.csv_rows(spark, spot), SHOP, RUN_TS)


def csv_mixed_headers(spark, sf):
    """The stock list in two exports, one with its columns the other way round."""
    spots = [f"{session.scratch_root(spark)}/{_fresh('stock_csv')}" for _ in range(2)]
    named = [F.get(F.col("cells"), F.lit(i)).alias(n) for i, n in enumerate(rs.STOCK_NAMES)]
    rows = ledger.data_rows(rs.stock_sheet(spark, sf)).withColumn("half", F.pmod(F.xxhash64("cells"), F.lit(2)))
    for half, (spot, columns) in enumerate(zip(spots, (named, named[::-1]))):
        rows.filter(F.col("half") == half).select(*columns).write.option("header", True).csv(spot)
    return ledger.stock(exports.csv_rows(spark, spots), SHOP, RUN_TS)


def csv_texts(spark, sf):
    """Whole texts, line breaks and quotes among them, through a CSV export that Spark splits anywhere."""
    spot = f"{session.scratch_root(spark)}/{_fresh('texts_csv')}"
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(**plain).csv(spot)
    cell = lambda i: F.get("cells", F.lit(i))
    found = exports.csv_rows(spark, spot)
    return found.select(cell(0).cast("long").alias("doc_id"), cell(1).alias("source"), cell(2).alias("text"))


def create_if_missing(spark, sf):
    """A table created from its schema, then created again after rows arrived."""
    name = _fresh("stock_first")
    sinks.create_if_missing(spark, name, STOCK)
    ledger.stock(rs.stock_sheet(spark, sf), SHOP, RUN_TS).write.insertInto(name)
    sinks.create_if_missing(spark, name, STOCK)
    return spark.table(name).groupBy("status", "shop_name").agg(F.count("*").alias("rows"))


def extra_type_inference(spark, sf):
    rows = ledger.statement_rows(rs.detail_sheets(spark, sf))
    layouts = align.tab_layouts(rows)
    declared = STATEMENT_SCHEMAS["bill details"].names
    extras = {tab: [s for n, s in found.sources().items() if n not in declared] for tab, found in layouts.tabs.items()}
    found = [(name, kind) for told in align.findings(rows, layouts, extras, {}).values() for name, kind in told.types.items()]
    return spark.createDataFrame(found, "name STRING, type STRING")


def header_inventory(spark, sf):
    """Raw headers and cleaned names of every statement file."""
    rows = ledger.statement_rows(rs.bill_sheets(spark, sf))
    heads = rows.select("path", F.explode("header").alias("raw")).distinct()
    named = heads.withColumn("column_name", align.clean_header_column(F.col("raw")))
    return named.groupBy("raw", "column_name").agg(F.count("*").alias("files"))


def positional_orders(spark, sf):
    """First twelve columns by position, as text."""
    raw = ledger.data_rows(rs.order_sheet(spark, sf))
    names = [n for n in COMPLETED_ORDERS.names if n != "shop_name"]
    return raw.select(*[align.positional_cell(i, len(names)).alias(n) for i, n in enumerate(names)])


def workbook_decode(spark, sf):
    """Real workbooks made from order lines, decoded again."""
    raw = workbook.decoded(rs.workbooks(spark, sf), tabs=["lines"])
    rows = ledger.data_rows(raw)
    return rows.select(
        F.col("path"),
        "sheet",
        align.cell("Order").alias("order_text"),
        align.cell("Line").cast("bigint").alias("line"),
        align.cell("Price").cast("double").alias("price"),
        align.cell("Shipped").alias("shipped"),
        align.cell("Open").alias("open"),
        align.cell("Flag").alias("flag"),
        F.array_join("kinds", "").alias("kinds"),
    )


def first_sheet_rows(spark, sf):
    """The first sheet of these workbooks is an empty cover: no rows and no error."""
    books = session.written(rs.workbooks(spark, sf), "books")
    raw = workbook.decoded(books)
    lines = workbook.decoded(books, tabs=["lines", "no such tab"])
    return raw.select("path", "error").unionByName(lines.filter("row_idx = 0").select("path", "error"))


def sheet_choice(spark, sf):
    """Two sheets of one file answer to the same tab; the first in workbook order counts."""
    bill = rs.bill_sheets(spark, sf).withColumn(
        "sheet_pos", F.when(F.col("o_orderkey") % 2 == 0, 3).otherwise(1)
    ).withColumn("sheet", F.when(F.col("o_orderkey") % 2 == 0, " BILL").otherwise("Bill "))
    picked = workbook.pick_sheets(bill, list(STATEMENT_SCHEMAS))
    return picked.select("o_orderkey", "path", "sheet", "tab")


def broken_workbooks(spark, sf):
    """Workbooks cut in half: each is reported, none stops the others."""
    books = rs.workbooks(spark, sf).withColumn("nth", F.regexp_extract("path", r"-(\d+)\.", 1).cast("int"))
    halved = F.expr("IF(nth % 2 = 0, substring(content, 1, length(content) div 2), content)")
    raw = session.written(workbook.decoded(books.select("path", halved.alias("content")), ["lines"]), "broken-books")
    errors = workbook.read_errors(raw).select("path", F.lit(True).alias("failed"), F.lit(0).cast("bigint").alias("rows"))
    read = ledger.data_rows(raw).groupBy("path").agg(F.count("*").alias("rows"))
    return errors.unionByName(read.select("path", F.lit(False).alias("failed"), "rows"))


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:10]}"


def overwrite_table(spark, sf):
    name = _fresh("stock_now")
    sinks.replace_table(rs.stock_sheet(spark, sf).select(F.lit("old").alias("listing_id")), name)
    sinks.replace_table(ledger.stock(rs.stock_sheet(spark, sf), SHOP, RUN_TS), name, STOCK)
    return spark.table(name).select("listing_id", "selling_price", "updated_at_ts")


def guarded_overwrite(spark, sf):
    """An empty run leaves the previous snapshot; a second run replaces it."""
    name = _fresh("orders_now")
    found = ledger.completed_orders(rs.order_sheet(spark, sf), SHOP)
    sinks.guarded_overwrite(found, name, COMPLETED_ORDERS)
    sinks.guarded_overwrite(found.filter("sold_qty < 0"), name, COMPLETED_ORDERS)
    return spark.table(name).groupBy("status").agg(F.count("*").alias("rows"), F.sum("sold_qty").alias("sold"))


def append_snapshot(spark, sf):
    """Two runs of a catalogue-shaped frame and an empty one; both stay, one partition per day."""
    name = _fresh("catalogue_history")
    part = table(spark, sf, "part").selectExpr("p_name AS title", "p_type AS category", "CAST(p_partkey AS STRING) AS model")
    runs = [("2024-05-01 06:30:00", part), ("2024-05-03 06:30:00", part.filter("false"))]
    for day, rows in [*runs, ("2024-05-02 06:30:00", part.filter("category = 'PROMO'"))]:
        blank = [F.lit("").alias(c) for c in CATALOGUE.names if c not in ("ts", "category", "title", "model")]
        run = rows.select(F.lit(day).cast("timestamp").alias("ts"), "category", "title", "model", *blank)
        sinks.append_snapshot(run, name, CATALOGUE)
    return spark.table(name).groupBy("ts", "ts_date", "category").agg(F.count("*").alias("rows"))


def header_append(spark, sf):
    """A text sheet: header written once, a renamed header appended by position."""
    spot = f"{session.scratch_root(spark)}/{_fresh('sheet')}"
    part = table(spark, sf, "part").selectExpr("CAST(p_partkey AS STRING) AS sku", "p_name AS title", "p_type AS kind")
    sinks.append_under_header(part, spot, ["sku", "title", "kind"])
    renamed = part.filter("kind = 'PROMO'").toDF("code", "name", "kind")
    sinks.append_under_header(renamed, spot, ["code", "name", "kind"])
    return spark.read.option("header", True).csv(spot).groupBy("kind").agg(
        F.count("sku").alias("rows"), F.count_distinct("title").alias("titles")
    )


def schema_enforced(spark, sf):
    """Frame with unknown, missing and reordered columns fitted to the declared schema."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderstatus AS status", "CAST(o_custkey AS INT) AS sold_qty", "CAST(o_orderkey AS STRING) AS order_id", "1 AS unknown"
    )
    return align.fit(rows, COMPLETED_ORDERS).select("order_id", "order_number", "sold_qty", "deal_price", "order_time", "status")


def rows_written(spark, sf):
    """Row counts observed during the write, per sink table."""
    name = _fresh("orders_counted")
    rows, seen = metrics.observed(ledger.completed_orders(rs.order_sheet(spark, sf), SHOP), "written")
    sinks.replace_table(rows, name, COMPLETED_ORDERS)
    stored = spark.table(name).agg(F.count("*").alias("stored"))
    return stored.select(F.lit(seen.get["rows"]).cast("bigint").alias("observed"), "stored")


QUERIES = {
    "completed_orders": completed_orders,
    "stock": stock,
    "weekly_bill_details": weekly_bill_details,
    "weekly_bill": weekly_bill,
    "weekly_bill_coalesced": weekly_bill_coalesced,
    "weekly_storage_fee": weekly_storage_fee,
    "weekly_day_first": weekly_day_first,
    "all_statement_tabs": all_statement_tabs,
    "statement_tables": statement_tables,
    "tab_failures": tab_failures,
    "csv_export": csv_export,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_texts": csv_texts,
    "create_if_missing": create_if_missing,
    "extra_type_inference": extra_type_inference,
    "header_inventory": header_inventory,
    "positional_orders": positional_orders,
    "workbook_decode": workbook_decode,
    "first_sheet_rows": first_sheet_rows,
    "sheet_choice": sheet_choice,
    "broken_workbooks": broken_workbooks,
    "overwrite_table": overwrite_table,
    "guarded_overwrite": guarded_overwrite,
    "append_snapshot": append_snapshot,
    "header_append": header_append,
    "schema_enforced": schema_enforced,
    "rows_written": rows_written,
}


def _file(day: str, store: str) -> str:
    return f"""CASE month({day}) WHEN 2 THEN strftime({day}, '%Y%m') || '31_' || strftime({day}, '%Y%m') || '28_s' || ({store} % 4)
      WHEN 4 THEN strftime({day}, '%Y%m') || '01_' || strftime({day}, '%Y%m') || '28'
      ELSE strftime({day}, '%Y%m') || '01_' || strftime({day}, '%Y%m') || '28_s' || ({store} % 4) END || '.xlsx'"""


def _lineage(day: str, store: str) -> str:
    dated = f"month({day}) NOT IN (2, 4)"
    return f"""{_file(day, store)} AS source_filename,
      CASE WHEN {dated} THEN CAST(date_trunc('month', {day}) AS DATE) END AS statement_start_date,
      CASE WHEN {dated} THEN CAST(date_trunc('month', {day}) AS DATE) + 27 END AS statement_end_date"""


def _nulls(schema: str, *given: str) -> str:
    """Declared columns that no file has."""
    kinds = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "timestamp": "TIMESTAMP", "date": "DATE"}
    fields = [f for f in STATEMENT_SCHEMAS[schema].fields if f.name not in given]
    return ", ".join(f"CAST(NULL AS {kinds[f.dataType.simpleString()]}) AS {f.name}" for f in fields)


_LINEAGE = ("source_filename", "statement_start_date", "statement_end_date")
_DETAIL_GIVEN = (
    *_LINEAGE, "store_id", "store_name", "order_sn", "payment_time", "finnshed_time", "goods_id", "goods_name",
    "goods_price", "goods_num", "rate", "complete_amount", "fine", "settlement",
)
_BILL_GIVEN = (*_LINEAGE, "store_id", "total_valume", "goods_number", "settlement_payable_1", "settlement_payable_2", "remark")

# Whether the first file by name has odd-month headers decides which spelling is kept.
_DETAILS = f"""
  d AS (SELECT *, {_lineage("l_shipdate", "l_suppkey")}, month(l_shipdate) % 2 = 1 AS odd
        FROM lineitem JOIN part ON l_partkey = p_partkey),
  lead AS (SELECT arg_min(odd, source_filename) AS odd_first FROM d)"""
_BILLS = f"""
  d AS (SELECT *, {_lineage("o_orderdate", "o_custkey")}, month(o_orderdate) % 2 = 1 AS odd FROM orders),
  lead AS (SELECT arg_min(odd, source_filename) AS odd_first FROM d)"""
_FEES = "SELECT CASE o_orderkey % {} {} END, {} FROM orders WHERE month(o_orderdate) <> 6".format(
    len(rs.FEE_TABS), " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(rs.FEE_TABS)), _lineage("o_orderdate", "o_custkey")
)
_REMARK = "CASE o_orderstatus WHEN 'P' THEN o_orderpriority END"
_BOOKS = "'/in/lines-' || (l_orderkey // 100) || '.xlsx'"

SQL = {
    "completed_orders": f"""
        SELECT 'SO' || l_orderkey AS order_number, CASE WHEN l_linenumber < 6 THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
          lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS sku_id, ' ' || p_name AS sku_title,
          CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS sold_qty, l_extendedprice AS deal_price,
          CASE WHEN l_linestatus <> 'F' THEN ' Flash ' END AS promotion_type, l_discount AS discount,
          date_trunc('second', o_orderdate) AS order_time, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS payment_time,
          CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) WHEN 'N' THEN date_trunc('minute', l_shipdate) END AS complete_time,
          o_orderstatus AS status, '{SHOP}' AS shop_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "stock": f"""
        SELECT '0' || p_partkey AS listing_id, CAST(12345678901234567 + p_partkey AS VARCHAR) AS sku_id,
          CASE WHEN p_size % 9 <> 0 THEN 'V' || p_partkey END AS vendor_product_id, p_name AS title, 'KES' AS currency,
          CASE p_size % 6 WHEN 2 THEN 5.0 WHEN 3 THEN 1000.0 WHEN 5 THEN p_retailprice END AS market_reference_price,
          p_retailprice AS selling_price, sold AS fbk_inventory,
          CASE WHEN p_size % 3 > 0 THEN CAST(p_size AS BIGINT) END AS non_fbk_inventory, lower(p_type) AS status,
          TIMESTAMP '{RUN_TS}' AS updated_at_ts, '{SHOP}' AS shop_name
        FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS sold FROM lineitem GROUP BY ALL) ON l_partkey = p_partkey""",
    "weekly_bill_details": f"""WITH {_DETAILS}
        SELECT source_filename, statement_start_date, statement_end_date,
          CASE WHEN odd = odd_first THEN 'S' || (l_suppkey % 4) END AS store_id,
          CASE WHEN l_linestatus <> 'O' THEN 'Store ' || (l_suppkey % 4) END AS store_name,
          'SN' || l_orderkey AS order_sn, date_trunc('second', l_shipdate) AS payment_time,
          CASE WHEN l_returnflag <> 'N' THEN date_trunc('minute', l_shipdate) END AS finnshed_time,
          lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS goods_id, p_name AS goods_name,
          CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS goods_price, CAST(l_quantity AS BIGINT) AS goods_num,
          CASE WHEN l_tax <> 0 THEN l_tax END AS rate, l_extendedprice AS complete_amount,
          CASE WHEN odd THEN l_discount END AS fine, CASE WHEN NOT odd THEN l_discount END AS settlement,
          CASE WHEN odd THEN CAST(l_linenumber AS BIGINT) ELSE l_suppkey END AS weight__kg,
          CASE WHEN odd THEN CAST(l_suppkey AS DOUBLE) END AS lot, CASE WHEN NOT odd THEN CAST(l_linenumber AS DOUBLE) END AS weight_kg,
          l_linestatus = 'O' AS checked, date_trunc('second', l_shipdate) AS scan_date, l_returnflag AS note,
          l_quantity / 4 AS score, CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS VARCHAR) ELSE 'm' || l_linenumber END AS mixed,
          CAST(NULL AS DOUBLE) AS blank, {_nulls("bill details", *_DETAIL_GIVEN)}
        FROM d, lead""",
    "weekly_bill": f"""WITH {_BILLS}
        SELECT source_filename, statement_start_date, statement_end_date,
          CASE WHEN odd = odd_first THEN 'S' || (o_custkey % 4) END AS store_id, o_totalprice AS total_valume,
          o_custkey AS goods_number, CASE WHEN odd THEN o_totalprice / 2 END AS settlement_payable_1,
          CASE WHEN NOT odd THEN o_totalprice / 2 END AS settlement_payable__1,
          CASE WHEN NOT odd AND o_orderstatus <> 'P' THEN o_totalprice / 4 END AS settlement_payable_2,
          CASE WHEN odd THEN CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(o_totalprice / 4 AS VARCHAR) END END AS settlement_payable__2,
          {_REMARK} AS remark, {_nulls("bill", *_BILL_GIVEN)}
        FROM d, lead""",
    "weekly_bill_coalesced": f"""WITH {_BILLS}
        SELECT source_filename, 'S' || (o_custkey % 4) AS store_id, CASE WHEN odd THEN o_totalprice / 2 END AS settlement_payable_1,
          CASE WHEN NOT odd THEN o_totalprice / 2 END AS settlement_payable__1,
          CASE WHEN NOT odd AND o_orderstatus <> 'P' THEN o_totalprice / 4 END AS settlement_payable_2
        FROM d""",
    "weekly_storage_fee": f"""
        SELECT {_lineage("ts", "user_id")}, event_id AS "row", user_id AS shelf_no, value AS fee__kes, ts AS stored_since, event_type AS kind
        FROM events""",
    "all_statement_tabs": f"""
        SELECT tab, source_filename, statement_start_date, count(*) AS rows FROM (
          SELECT 'bill details' AS tab, {_lineage("l_shipdate", "l_suppkey")} FROM lineitem JOIN part ON l_partkey = p_partkey
          UNION ALL SELECT 'bill', {_lineage("o_orderdate", "o_custkey")} FROM orders
          UNION ALL SELECT 'storage fee', {_lineage("ts", "user_id")} FROM events UNION ALL {_FEES}) GROUP BY ALL""",
    "statement_tables": f"""
        SELECT tab, 'ok' AS outcome, count(*) AS rows, count(statement_start_date) AS dated, count(DISTINCT source_filename) AS files FROM (
          SELECT 'bill details' AS tab, {_lineage("l_shipdate", "l_suppkey")} FROM lineitem JOIN part ON l_partkey = p_partkey
          UNION ALL SELECT 'bill', {_lineage("o_orderdate", "o_custkey")} FROM orders
          UNION ALL SELECT 'storage fee', {_lineage("ts", "user_id")} FROM events UNION ALL {_FEES}) GROUP BY tab""",
    "weekly_day_first": f"""
        SELECT {_file("l_shipdate", "l_suppkey")} AS source_filename, 'SN' || l_orderkey AS order_sn, date_trunc('minute', l_shipdate) AS payment_time,
          CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS finnshed_time FROM lineitem""",
    "create_if_missing": f"""
        SELECT lower(p_type) AS status, '{SHOP}' AS shop_name, count(*) AS rows FROM part GROUP BY ALL""",
    "extra_type_inference": """
        WITH f AS (
          SELECT bool_or(month(l_shipdate) % 2 = 1) AS odd, bool_or(month(l_shipdate) % 2 = 0) AS even,
            bool_or(l_returnflag <> 'A') AS lettered, bool_or(l_quantity / 4 <> floor(l_quantity / 4)) AS fractions FROM lineitem)
        SELECT 'lot' AS name, CASE WHEN even THEN 'DOUBLE' ELSE 'BIGINT' END AS type FROM f WHERE odd
        UNION ALL SELECT 'weight_kg', CASE WHEN odd THEN 'DOUBLE' ELSE 'BIGINT' END FROM f WHERE even
        UNION ALL SELECT 'weight__kg', 'BIGINT' FROM f
        UNION ALL SELECT 'checked', 'BOOLEAN' FROM f
        UNION ALL SELECT 'scan_date', 'TIMESTAMP' FROM f
        UNION ALL SELECT 'note', 'STRING' FROM f
        UNION ALL SELECT 'score', CASE WHEN fractions THEN 'DOUBLE' ELSE 'BIGINT' END FROM f
        UNION ALL SELECT 'mixed', CASE WHEN lettered THEN 'STRING' ELSE 'BIGINT' END FROM f
        UNION ALL SELECT 'blank', 'DOUBLE' FROM f""",
    "header_inventory": f"""
        WITH f AS (SELECT DISTINCT {_file("o_orderdate", "o_custkey")} AS file, month(o_orderdate) % 2 = 1 AS odd FROM orders)
        SELECT raw, column_name, count(*) AS files FROM f JOIN (VALUES
          (true, 'Store ID', 'store_id'), (true, 'Total Valume', 'total_valume'), (true, 'Goods Number', 'goods_number'),
          (true, 'Settlement Payable(1)', 'settlement_payable_1'), (true, 'Settlement Payable (2)', 'settlement_payable__2'),
          (true, 'Remark', 'remark'), (false, 'store id', 'store_id'), (false, 'Total Valume', 'total_valume'),
          (false, 'Goods Number', 'goods_number'), (false, 'Settlement Payable (1)', 'settlement_payable__1'),
          (false, 'Settlement Payable（2）', 'settlement_payable_2'), (false, 'Remark', 'remark')) h(odd, raw, column_name) USING (odd)
        GROUP BY ALL""",
    "workbook_decode": f"""
        SELECT {_BOOKS} AS path, ' Lines ' AS sheet, '00' || l_orderkey AS order_text,
          CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS BIGINT) END AS line, l_extendedprice AS price,
          strftime(l_shipdate, '%Y-%m-%d 00:00:00') AS shipped, CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'False' END AS open,
          '<' || l_returnflag || '&' AS flag, CASE WHEN l_linenumber <> 7 THEN 'snndbse' ELSE 'sendbse' END AS kinds FROM lineitem""",
    "first_sheet_rows": f"SELECT DISTINCT {_BOOKS} AS path, CAST(NULL AS VARCHAR) AS error FROM lineitem",
    "sheet_choice": f"""
        WITH b AS (SELECT o_orderkey, '/in/weekly/' || {_file("o_orderdate", "o_custkey")} AS path, o_orderkey % 2 = 1 AS first_sheet FROM orders),
        n AS (SELECT path, bool_or(first_sheet) AS has_first FROM b GROUP BY ALL)
        SELECT o_orderkey, path, CASE WHEN first_sheet THEN 'Bill ' ELSE ' BILL' END AS sheet, 'bill' AS tab
        FROM b JOIN n USING (path) WHERE first_sheet OR NOT has_first""",
    "broken_workbooks": f"""
        SELECT path, nth % 2 = 0 AS failed, CASE WHEN nth % 2 = 0 THEN 0 ELSE count(*) END AS rows
        FROM (SELECT {_BOOKS} AS path, l_orderkey // 100 AS nth FROM lineitem) GROUP BY path, nth""",
    "overwrite_table": f"""
        SELECT '0' || p_partkey AS listing_id, p_retailprice AS selling_price, TIMESTAMP '{RUN_TS}' AS updated_at_ts FROM part""",
    "guarded_overwrite": """
        SELECT o_orderstatus AS status, count(*) AS rows,
          CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS BIGINT) END) AS BIGINT) AS sold
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
    "tab_failures": """
        SELECT t.tab, t.tab = 'fine' AS failed, (SELECT count(*) FROM orders WHERE t.tab = 'bill' OR (t.tab = 'storage fee' AND o_orderstatus = 'F')) AS rows
        FROM (VALUES ('bill'), ('fine'), ('storage fee'), ('compensation')) t(tab)""",
    "append_snapshot": """
        SELECT TIMESTAMP '2024-05-01 06:30:00' AS ts, DATE '2024-05-01' AS ts_date, p_type AS category, count(*) AS rows FROM part GROUP BY ALL
        UNION ALL SELECT TIMESTAMP '2024-05-02 06:30:00', DATE '2024-05-02', p_type, count(*) FROM part WHERE p_type = 'PROMO' GROUP BY ALL""",
    "header_append": """
        SELECT p_type AS kind, CASE WHEN p_type = 'PROMO' THEN 2 ELSE 1 END * count(*) AS rows, count(DISTINCT p_name) AS titles FROM part GROUP BY p_type""",
    "schema_enforced": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS order_number, o_custkey AS sold_qty,
          CAST(NULL AS DOUBLE) AS deal_price, CAST(NULL AS TIMESTAMP) AS order_time, o_orderstatus AS status FROM orders""",
    "rows_written": """
        SELECT count(*) AS observed, count(*) AS stored FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "positional_orders": """
        SELECT 'SO' || l_orderkey AS order_number, CASE l_linenumber WHEN 7 THEN 'NaT' WHEN 6 THEN 'nan' ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
          lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS sku_id, ' ' || p_name AS sku_title,
          CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN CAST(l_quantity AS VARCHAR) ELSE CAST(l_quantity AS BIGINT) || '.9' END AS sold_qty,
          CAST(l_extendedprice AS VARCHAR) AS deal_price, CASE WHEN l_linestatus = 'F' THEN 'N/A' ELSE ' Flash ' END AS promotion_type,
          CASE WHEN l_discount <> 0 THEN CAST(l_discount AS VARCHAR) END AS discount,
          strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time, strftime(l_shipdate, '%Y/%m/%d') AS payment_time,
          CASE l_returnflag WHEN 'R' THEN 'not a date' WHEN 'A' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%m/%d/%Y %H:%M') END AS complete_time,
          o_orderstatus AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
}

SQL["csv_export"] = SQL["stock"]
SQL["csv_mixed_headers"] = SQL["csv_export"]
_MISSING = ", ".join(f"'{token}'" for token in NA_TOKENS)
SQL["csv_texts"] = f"""
SELECT doc_id, CASE WHEN source NOT IN ({_MISSING}) THEN source END AS source,
  CASE WHEN text NOT IN ({_MISSING}) THEN regexp_replace(text, '\\r\\n?', chr(10), 'g') END AS text FROM documents
"""
