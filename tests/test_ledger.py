"""Raw sheets to typed tables, workbook files, and the writers."""

from __future__ import annotations

import datetime as dt
import itertools
import threading
import uuid
import warnings

import pandas as pd
import pytest
from pandas.io.parsers import TextParser
from pyspark.sql import functions as F

from tallyshelf.functions import typed
from tallyshelf.operators import align, metrics, sinks
from tallyshelf.plans import ledger
from tallyshelf.plans.schemas import CATALOGUE, COMPLETED_ORDERS, STATEMENT_SCHEMAS, STATEMENT_TABS, STOCK, STOCK_HEADERS
from tallyshelf.sources import exports, workbook
from tallyshelf.sources.workbook import RAW_TYPE, unique_names

STAMP = dt.datetime(2024, 4, 1, 10, 0)


def kind_of(value) -> tuple[str | None, str]:
    match value:
        case None | "":
            return None, "e"
        case bool():
            return str(value), "b"
        case int() | float():
            return str(value), "n"
        case dt.datetime():
            return str(value), "d"
    return value, "s"


def raw(spark, *sheets):
    """Each sheet: (path, tab, header, rows of Python values)."""
    rows = []
    for path, tab, header, lines in sheets:
        for i, line in enumerate(lines, start=1):
            cells = [kind_of(v) for v in line]
            rows.append((path, tab, 0, i, header, [c for c, _ in cells], [k for _, k in cells], None))
    return spark.createDataFrame(rows, RAW_TYPE)


def load(spark, *sheets, **options):
    return ledger.weekly_statements(ledger.statement_rows(raw(spark, *sheets)), **options)


# --- completed orders and stock ----------------------------------------------------------

ORDER = ["1", "2", "3", "t", "1.9", "5", "p", "", "2024-01-02", "bad", "", "done", "surplus"]


def test_orders(spark):
    header = [f"h{i}" for i in range(13)]
    row = ledger.completed_orders(raw(spark, ("o", "s", header, [ORDER])), "shop").first()
    assert row.asDict() == {
        "order_number": "1", "order_id": "2", "sku_id": "3", "sku_title": "t", "sold_qty": 1, "deal_price": 5.0,
        "promotion_type": "p", "discount": 0.0, "order_time": dt.datetime(2024, 1, 2), "payment_time": None,
        "complete_time": None, "status": "done", "shop_name": "shop",
    }


def test_orders_need_twelve_columns(spark):
    with pytest.raises(Exception, match="too few columns"):
        ledger.completed_orders(raw(spark, ("o", "s", ["a"] * 11, [ORDER[:11]])), "shop").collect()


def test_one_bad_number_fails_the_order_job(spark):
    bad = [*ORDER[:4], "many", *ORDER[5:]]
    with pytest.raises(Exception, match="not a number"):
        ledger.completed_orders(raw(spark, ("o", "s", ["a"] * 13, [ORDER, bad])), "shop").collect()


def test_stock(spark):
    header = ["Extra", *STOCK_HEADERS]
    line = ["x", "001", "12345678901234567", "nan", "T", "KES", "1,200", " 5 ", "7", "8.0", "on"]
    row = ledger.stock(raw(spark, ("s", "s", header, [line])), "shop", "2024-05-01 00:00:00").first()
    assert (row["listing_id"], row["sku_id"], row["vendor_product_id"]) == ("001", "12345678901234567", None)
    assert (row["market_reference_price"], row["selling_price"], row["fbk_inventory"], row["non_fbk_inventory"]) == (None, 5.0, 7, 8)
    assert row["updated_at_ts"] == dt.datetime(2024, 5, 1)


def test_stock_names_missing_columns(spark):
    header = [h if h != "Status" else "status" for h in STOCK_HEADERS]
    with pytest.raises(Exception, match="missing columns in .*Status"):
        ledger.stock(raw(spark, ("s", "s", header, [["1"] * 10])), "shop").collect()
    with pytest.raises(ValueError, match="Status"):
        align.require_columns(spark.range(1), ["Status"])


# --- weekly statements -------------------------------------------------------------------


def test_later_spelling_of_a_header_is_dropped_not_merged(spark):
    sheets = (
        ("/w/20240401_20240407_b.xlsx", "bill", ["store id", "Store Name"], [["B", "n"]]),
        ("/w/20240325_20240331_a.xlsx", "bill", ["Store ID"], [["A"]]),
    )
    found = {r["source_filename"][-6]: r["store_id"] for r in load(spark, *sheets)["bill"].collect()}
    assert found == {"a": "A", "b": None}
    merged = {r["source_filename"][-6]: r["store_id"] for r in load(spark, *sheets, mode="coalesce")["bill"].collect()}
    assert merged == {"a": "A", "b": "B"}
    with pytest.raises(ValueError):
        load(spark, *sheets, mode="last")


def test_declared_columns_come_first_and_extras_in_order_of_appearance(spark):
    frames = load(
        spark,
        ("/w/b.xlsx", "bill", ["Zeta", "Alpha", "Fine"], [[1, "x", "2"]]),
        ("/w/a.xlsx", "bill", ["Later", "Alpha"], [["y", "z"]]),
    )
    names = frames["bill"].columns
    assert names[: len(STATEMENT_SCHEMAS["bill"].names)] == STATEMENT_SCHEMAS["bill"].names
    assert names[len(STATEMENT_SCHEMAS["bill"].names) :] == ["later", "alpha", "zeta"]


def test_text_rules_of_statements(spark):
    lines = [[", 1", "NaT", "\t x "], [" ,,2 ", " nan ", None]]
    rows = load(spark, ("/w/a.xlsx", "bill details", ["Order SN", "Store Name", "Goods Name"], lines))["bill details"].orderBy("order_sn")
    assert [(r["order_sn"], r["store_name"], r["goods_name"]) for r in rows.collect()] == [("1", None, "x"), ("2", None, None)]


def test_a_fraction_fails_its_own_tab_only(spark):
    sheets = (
        ("/w/a.xlsx", "bill", ["Goods Number"], [["3.7"]]),
        ("/w/a.xlsx", "fine", ["Note"], [["x"]]),
    )
    prefix = f"t{uuid.uuid4().hex[:6]}_"
    outcome = sinks.write_tabs(load(spark, *sheets), STATEMENT_TABS, prefix)
    assert outcome["fine"] == "ok" and "not a whole number" in outcome["bill"]
    assert spark.table(prefix + "finance_fines").count() == 1
    assert not spark.catalog.tableExists(prefix + "finance_bill")
    assert load(spark, *sheets, on_fraction="null")["bill"].first()["goods_number"] is None


def test_blank_rows_stay_and_unknown_tabs_go(spark):
    frames = load(spark, ("/w/a.xlsx", " FINE ", ["Note"], [["x"], [None]]), ("/w/a.xlsx", "other", ["Note"], [["x"]]))
    assert list(frames) == ["fine"]
    assert frames["fine"].count() == 2


def test_time_cells(spark):
    lines = [[STAMP, "2024/04/02"], [1_712_000_000_000_000_000, "soon"]]
    rows = load(spark, ("/w/a.xlsx", "bill details", ["Payment Time", "Finnshed Time"], lines))["bill details"].orderBy("payment_time").collect()
    assert rows[0]["payment_time"] == STAMP and rows[0]["finnshed_time"] == dt.datetime(2024, 4, 2)
    assert rows[1]["payment_time"] == dt.datetime(2024, 4, 1, 19, 33, 20) and rows[1]["finnshed_time"] is None


def test_time_columns_follow_their_own_order(spark):
    lines = [["05/02/2024 10:00", "05/02/2024", "13/02/2024"], ["13/02/2024 10:00", "02/13/2024", "02/13/2024"], [None, "x/y", "2024/05/02"]]
    header = ["Payment Time", "Finnshed Time", "Note"]
    frame = load(spark, ("/w/a.xlsx", "bill details", header, lines[:2]), ("/w/b.xlsx", "bill details", header, lines[2:]))["bill details"]
    rows = frame.orderBy("source_filename", "payment_time").collect()
    assert [r["payment_time"] and (r["payment_time"].month, r["payment_time"].day) for r in rows] == [(2, 5), (2, 13), None]
    assert [r["finnshed_time"] and (r["finnshed_time"].month, r["finnshed_time"].day) for r in rows] == [(5, 2), (2, 13), None]
    both = spark.createDataFrame([("13/02/2024",), ("02/13/2024",), ("14/14/2024",), ("99/1",)], "c STRING")
    assert typed.day_first_columns(both, {"c": F.col("c")}) == {"c": False}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statement_rows_are_not_moved(spark):
    """Places of cells are broadcast, types come from sums: no row of a statement is shuffled or exploded."""
    sheets = [(f"/w/{i}.xlsx", "bill details", [f"H{i}", "Order SN", "Payment Time", "Extra"], [["a", "b", "2024-01-02", i]] * 3) for i in range(40)]
    rows = ledger.statement_rows(raw(spark, *sheets))
    assert {c for c in rows.columns} >= {"tab", "layout"}
    frame = ledger.weekly_statements(rows)["bill details"]
    plan = plan_of(frame)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "header" not in plan.split("BroadcastExchange")[0]
    layouts = align.tab_layouts(rows)
    classes = align.file_classes(rows, "bill details", layouts, [align.Source("extra", ("Extra",))], [align.Source("payment_time", ("Payment Time",))], (1, 1))
    assert "Generate" not in plan_of(classes) and "SortAggregate" not in plan_of(classes)
    assert frame.count() == 120 and frame.schema["extra"].dataType.simpleString() == "bigint"


def test_many_layouts_meet_without_a_broadcast(spark):
    sheets = [(f"/w/{i}.xlsx", "fine", [f"H{i}", "Note"], [["a", f"n{i}"]]) for i in range(30)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = load(spark, *sheets)["fine"]
        assert {r["note"] for r in frame.collect()} == {f"n{i}" for i in range(30)}
        assert "BroadcastHashJoin" not in plan_of(frame)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


VALUES = {"whole": 3, "real": 2.5, "flag": True, "stamp": STAMP, "text": "x", "gap": "", "digits": "7", "point": "1.0", "word": "True"}


def read_one(values):
    return TextParser([["a"], *[[v] for v in values]], header=0, skip_blank_lines=False).read()


def test_class_of_one_file_follows_the_spreadsheet_reader(spark):
    combos = [c for n in (1, 2, 3) for c in itertools.combinations(VALUES, n)]
    sheets = [(f"/w/{'-'.join(c)}.xlsx", "fine", ["A"], [[VALUES[k]] for k in c]) for c in combos]
    rows = ledger.statement_rows(raw(spark, *sheets))
    layouts = align.tab_layouts(rows)
    classes = align.file_classes(rows, "fine", layouts, [align.Source("a", ("A",))], [], (1, 0))
    found = {r["path"]: align.CLASSES[r["x0"].bit_length() - 1] for r in classes.collect()}
    kinds = {"i": "whole", "f": "real", "b": "flag", "M": "stamp", "O": "text"}
    for combo, (path, *_) in zip(combos, sheets):
        frame = read_one([VALUES[k] for k in combo])
        expected = "empty" if combo == ("gap",) else kinds[frame["a"].dtype.kind]
        assert found[path] == expected, combo


@pytest.mark.parametrize(
    "files, expected",
    [
        ([[1]], "bigint"), ([[1, None]], "double"), ([[1], None], "double"), ([[1], [2.5]], "double"), ([[1], ["x"]], "string"),
        ([[True, False]], "boolean"), ([[True], None], "string"), ([[True, False], [1]], "bigint"), ([[STAMP], None], "timestamp"),
        ([[STAMP, None]], "timestamp"), ([[STAMP], [1]], "string"), ([[None, None]], "double"), ([["7"], [8]], "bigint"),
        ([["x"], [None]], "string"),
    ],
)
def test_type_of_an_undeclared_column(spark, files, expected):
    sheets = [
        (f"/w/{i}.xlsx", "fine", ["Keep"] if values is None else ["Keep", "Extra"], [["k"]] if values is None else [["k", v] for v in values])
        for i, values in enumerate(files)
    ]
    frame = load(spark, *sheets)["fine"]
    assert frame.schema["extra"].dataType.simpleString() == expected
    frame.collect()
    if expected in ("bigint", "double", "string") and files != [[True], None] and files != [[True, False], [1]]:
        merged = pd.concat([read_one(["" if v is None else v for v in f]) if f else pd.DataFrame({"b": [0]}) for f in files])
        kinds = {"i": "bigint", "f": "double", "O": "string"}
        assert kinds[merged["a"].dtype.kind] == expected


# --- workbook files ----------------------------------------------------------------------


def book(path, *sheets, shared=(), styles=""):
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    listed = "".join(f'<sheet name="{name}" r:id="r{i}"/>' for i, (name, _) in enumerate(sheets))
    targets = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets)))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns} {rel}><sheets>{listed}</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{targets}</Relationships>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(f'<si>{s}</si>' for s in shared)}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {ns}>{styles}</styleSheet>")
        for i, (_, body) in enumerate(sheets):
            z.writestr(f"xl/worksheets/s{i}.xml", body if body.startswith("!") else f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


STYLES = (
    '<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm"/><numFmt numFmtId="165" formatCode="[Red]0.00&quot;d&quot;"/></numFmts>'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="14"/></cellXfs>'
)


def text_cell(value):
    return f'<c t="inlineStr"><is><t>{value}</t></is></c>'


def test_workbook_cells(spark, tmp_path):
    body = (
        f'<row r="1"><c r="A1" t="s"><v>0</v></c>{text_cell("When")}<c r="D1" t="s"><v>0</v></c></row>'
        '<row r="3"><c r="A3"><v>12.0</v></c><c r="B3" s="1"><v>45383.4375</v></c><c r="C3" s="2"><v>1.50</v></c><c r="D3" t="b"><v>1</v></c></row>'
        f'<row r="4"><c r="A4" t="e"><v>#REF!</v></c><c r="B4" t="str"><v>N/A</v></c>{text_cell("keep")}<c r="D4" s="3"><v>45383</v></c></row>'
        '<row r="6"><c r="E6" t="inlineStr"><is><t></t></is></c></row>'
    )
    book(tmp_path / "a.xlsx", ("S", body), shared=["<r><t>No</t></r><r><t>. 1</t></r><rPh><t>x</t></rPh>"], styles=STYLES)
    rows = workbook.workbook_rows(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert rows[0]["header"] == ["No. 1", "When", "Unnamed: 2", "No. 1.1"]
    assert [r["row_idx"] for r in rows] == [0, 1, 2, 3]
    assert rows[1]["kinds"] == ["e"] * 4
    assert (rows[2]["cells"], rows[2]["kinds"]) == (["12", "2024-04-01 10:30:00", "1.5", "True"], ["n", "d", "n", "b"])
    assert (rows[3]["cells"], rows[3]["kinds"]) == ([None, None, "keep", "2024-04-01 00:00:00"], ["e", "e", "s", "d"])


def test_sheets_are_read_as_a_stream(tmp_path):
    lines = "".join(f'<row>{text_cell("a" if i == 0 else i)}</row>' for i in range(50))
    # Rows of the data only; the other sheet's XML breaks off behind them.
    book(tmp_path / "a.xlsx", ("S", f"{lines}</sheetData><controls><anchor><row>7</row></anchor></controls><sheetData>"))
    rows = list(workbook._book_rows("p", (tmp_path / "a.xlsx").read_bytes(), None))
    assert [r["cells"] for r in rows] == [["a"], *([str(i)] for i in range(1, 50))]
    book(tmp_path / "b.xlsx", ("S", f"{lines}</sheetData><controls>"))
    broken = list(workbook._book_rows("p", (tmp_path / "b.xlsx").read_bytes(), None))
    assert len(broken) == 1 and "ParseError" in broken[0]["error"]


def test_repeated_names():
    assert unique_names(["A", "A", "", "A.1", None]) == ["A", "A.1", "Unnamed: 2", "A.1.1", "Unnamed: 4"]


def test_folder_of_workbooks(spark, tmp_path):
    line = lambda *v: f"<row>{''.join(map(text_cell, v))}</row>"
    good = line("Store ID", "Fine") + line("s1", "2")
    book(tmp_path / "20240401_20240407_a.xlsx", ("Cover", ""), (" Bill ", good), ("BILL", line("Store ID") + line("no")), ("Fine", line("Note")))
    book(tmp_path / "20240408_20240414_b.xlsx", ("bill", good), ("bill details", "!<worksheet><sheetData><row>"))
    (tmp_path / "c.xlsx").write_bytes(b"not a workbook")
    (tmp_path / "deep").mkdir()
    book(tmp_path / "deep" / "d.xlsx", ("bill", good))
    read = workbook.workbook_rows(spark, str(tmp_path), list(STATEMENT_TABS))
    assert {r["path"].rsplit("/", 1)[1] for r in workbook.read_errors(read).collect()} == {"20240408_20240414_b.xlsx", "c.xlsx"}
    frames = ledger.weekly_statements(ledger.statement_rows(read))
    assert list(frames) == ["bill"]
    rows = frames["bill"].orderBy("source_filename").collect()
    assert [(r["source_filename"], r["store_id"], r["fine"], str(r["statement_end_date"])) for r in rows] == [
        ("20240401_20240407_a.xlsx", "s1", 2.0, "2024-04-07"),
        ("20240408_20240414_b.xlsx", "s1", 2.0, "2024-04-14"),
    ]


def test_csv_export(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Store ID,Fine\ns1,2\nN/A,\n")
    rows = exports.csv_rows(spark, str(tmp_path / "s.csv")).select("header", "cells", "kinds").collect()
    assert rows[0]["cells"] == ["s1", "2"] and rows[1]["cells"] == [None, None] and rows[1]["kinds"] == ["e", "e"]


# --- writers -----------------------------------------------------------------------------


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def orders(spark, *ids):
    return spark.createDataFrame([(i, 1, "u") for i in ids], "order_id STRING, sold_qty INT, unknown STRING")


def test_replace_keeps_the_old_table_when_the_load_fails(spark, table):
    sinks.replace_table(orders(spark, "a"), table, COMPLETED_ORDERS)
    failing = orders(spark, "b").withColumn("order_id", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_table(failing, table, COMPLETED_ORDERS)
    assert [r["order_id"] for r in spark.table(table).collect()] == ["a"]
    sinks.replace_table(spark.range(2), table)
    assert spark.table(table).columns == ["id"]


def test_guarded_overwrite(spark, table):
    assert sinks.guarded_overwrite(orders(spark, "a", "b"), table, COMPLETED_ORDERS) == 2
    with pytest.warns(UserWarning, match="keeps its previous"):
        assert sinks.guarded_overwrite(orders(spark, "a").limit(0), table, COMPLETED_ORDERS) == 0
    assert spark.table(table).count() == 2
    assert spark.table(table).schema["sold_qty"].dataType.simpleString() == "bigint"


def versions(spark, table):
    files, folder = sinks._file_system(spark, sinks._versions(spark, table))
    return {f.getPath().getName() for f in files.listStatus(folder)}


def test_a_load_is_one_write_and_keeps_one_version_before_it(spark, table):
    for n in (1, 2, 3):
        sinks.replace_table(spark.range(n), table)
        assert spark.table(table).count() == n
    assert len(versions(spark, table)) == 2
    sinks.replace_table(spark.table(table).where("id > 0"), table)
    assert sorted(r["id"] for r in spark.table(table).collect()) == [1, 2]
    assert len(versions(spark, table)) == 2


def test_a_killed_load_leaves_the_old_rows(spark, table, monkeypatch):
    sinks.replace_table(spark.range(2), table)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(sinks, "_install", die)
        sinks.replace_table(spark.range(9), table)
    assert spark.table(table).count() == 2 and len(versions(spark, table)) == 2
    sinks.replace_table(spark.range(5), table)
    assert spark.table(table).count() == 5
    left = {sinks._stored_at(spark, table).rsplit("/", 1)[-1]}
    assert left < versions(spark, table) and len(versions(spark, table)) == 2


def test_readers_always_see_one_whole_version(spark, table):
    sinks.replace_table(spark.range(100).selectExpr("0 AS version"), table)
    begun, seen, stop = spark.table(table), [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(table).groupBy("version").count().collect())

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        sinks.replace_table(spark.range(100).selectExpr(f"{n} AS version"), table)
        if n == 1:
            # A query that was defined on the version before still reads it.
            assert [tuple(r) for r in begun.distinct().collect()] == [(0,)]
    stop.set()
    reader.join()
    assert seen and all(len(rows) == 1 and rows[0]["count"] == 100 for rows in seen)


def test_partitioned_and_other_tables_are_replaced(spark, table):
    spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").saveAsTable(table)
    sinks.replace_table(spark.range(9).selectExpr("id % 3 AS part", "id"), table)
    assert spark.table(table).where("part = 2").count() == 3 and spark.table(table).count() == 9
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["part"]


def test_tabs_are_written_side_by_side(spark):
    prefix = f"side_{uuid.uuid4().hex[:8]}_"
    # Each tab waits until all have begun, which a writer of one tab after another would never see.
    met = threading.Barrier(4, timeout=60)
    store = sinks.replace_table

    def meet(df, table, schema=None):
        met.wait()
        if table.endswith("c"):
            raise ValueError("no such fee")
        store(df, table, schema)

    frames = {t: spark.range(n) for n, t in enumerate("abcd")}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sinks, "replace_table", meet)
        said = sinks.write_tabs(frames, {t: t for t in "abcd"}, prefix)
    assert list(said.items()) == [("a", "ok"), ("b", "ok"), ("c", "ValueError: no such fee"), ("d", "ok")]
    assert spark.table(f"{prefix}d").count() == 3 and not spark.catalog.tableExists(f"{prefix}c")
    assert sinks.write_tabs({}, {}) == {}


def test_append_accumulates_by_run(spark, table):
    row = lambda ts: spark.createDataFrame([(ts, "t")], "ts STRING, title STRING").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.append_snapshot(row("2024-05-01 01:00:00"), table, CATALOGUE)
    sinks.append_snapshot(row("2024-05-01 02:00:00"), table, CATALOGUE)
    sinks.append_snapshot(row("2024-05-02 02:00:00").limit(0), table, CATALOGUE)
    assert spark.table(table).count() == 2
    assert {str(r["ts_date"]) for r in spark.table(table).collect()} == {"2024-05-01"}


def test_create_if_missing(spark, table):
    sinks.create_if_missing(spark, f"tallyshelf_db.{table}", STOCK)
    sinks.create_if_missing(spark, f"tallyshelf_db.{table}", COMPLETED_ORDERS)
    assert spark.table(f"tallyshelf_db.{table}").columns == STOCK.names
    spark.sql(f"DROP TABLE tallyshelf_db.{table}")


def test_append_under_header(spark, tmp_path):
    spot = str(tmp_path / "sheet")
    rows = spark.createDataFrame([("007", "x,y")], "a STRING, b STRING")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert sinks.append_under_header(rows, spot, ["a", "b"]) == ["a", "b"]
        sinks.append_under_header(rows, spot, ["a", "b"])
    with pytest.warns(UserWarning, match="header differs"):
        assert sinks.append_under_header(rows.toDF("b", "c"), spot, ["b", "c"]) == ["a", "b"]
    found = spark.read.option("header", True).csv(spot)
    assert found.columns == ["a", "b"] and {tuple(r) for r in found.collect()} == {("007", "x,y")} and found.count() == 3
    odd = spark.createDataFrame([("two\nlines\\n", None)], "a STRING, b STRING")
    with pytest.warns(UserWarning):
        sinks.append_under_header(odd, spot, ["a"])
    stored = sinks.read_sheet(spark, spot)
    assert stored.count() == 4 and ("two\nlines\\n", None) in {tuple(r) for r in stored.collect()}


def test_a_step_is_counted_once(spark):
    tally = metrics.Tally()
    rows = tally.watch("write", spark.range(6), even=F.count_if(F.col("id") % 2 == 0), none=F.sum(F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="counted already"):
        tally.watch("write", spark.range(1))
    rows.write.format("noop").mode("overwrite").save()
    found = {(r["run"], r["step"], r["counter"]): r["value"] for r in tally.frame(spark, "r").collect()}
    assert found == {("r", "write", "even"): 3, ("r", "write", "none"): 0}


def test_observed_rows(spark, table):
    rows, seen = metrics.observed(spark.range(7), "n")
    sinks.replace_table(rows, table)
    assert seen.get["rows"] == 7
