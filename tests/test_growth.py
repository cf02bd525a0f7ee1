"""Jobs that must keep their results and their shape when the tables grow."""

from __future__ import annotations

import io
import time
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyshelf import session
from tallyshelf.functions import text, typed
from tallyshelf.operators import align
from tallyshelf.plans import ledger
from tallyshelf.registry import ledger_queries, rendered_pages, rendered_sheets, tables, text_queries
from tallyshelf.sources import workbook


def test_epoch_numbers_beyond_bigint(spark, tmp_path):
    ids = [1, 106_751, 106_752, 6_000_000]
    events = {"event_id": pa.array(ids, pa.int64()), "user_id": pa.array([7, 99, 1, 89_999], pa.int64())}
    pq.write_table(pa.table(events), tmp_path / "events.parquet")
    found = text_queries.epoch_numbers(spark, str(tmp_path)).select("event_id", F.unix_micros("stamp")).collect()
    users = dict(zip(ids, [7, 99, 1, 89_999]))
    assert {r[0]: r[1] for r in found} == {i: (i * 86_400 + users[i]) * 1_000_000 for i in ids}


def test_long_nanoseconds_are_exact(spark):
    cells = ["518400000000000123456", " +9223372036854775808 ", "-10000000000000000001", "9223372036854775807", "-1", "1e3", "9" * 30]
    cell = F.col("cell")
    rows = spark.createDataFrame([(c,) for c in cells], "cell STRING").select(
        cell, F.unix_micros(typed.stamp_or_null(cell, F.lit("n"))).alias("micros")
    )
    found = {r["cell"]: r["micros"] for r in rows.collect()}
    assert found.pop("1e3") == 1 and found.pop("9" * 30) is None
    assert found == {c: int(c) // 1000 for c in found}


def test_strip_of_plain_and_odd_texts(spark):
    cells = ["a", " a", "a ", "", " ", "a b", "\xa0a", "a ", "é", "é ", "\n", "x\n", "\x1fx", "~", "!", "\x7f"]
    rows = spark.createDataFrame([(c,) for c in [*cells, None]], "c STRING").select("c", text.strip(F.col("c")).alias("s"))
    for r in rows.collect():
        assert r["s"] == (None if r["c"] is None else r["c"].strip()), repr(r["c"])


def test_product_pages_are_read_by_all_cores(spark, tmp_path):
    part = {
        "p_partkey": pa.array(range(100), pa.int64()), "p_name": ["red box"] * 100, "p_brand": ["Brand#1"] * 100,
        "p_type": ["PROMO"] * 100, "p_size": pa.array([1] * 100, pa.int32()), "p_retailprice": [1.5] * 100,
    }
    pq.write_table(pa.table(part), tmp_path / "part.parquet")
    pages = rendered_pages.product_pages(spark, str(tmp_path))
    counts = pages.groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) == spark.sparkContext.defaultParallelism and max(r["count"] for r in counts) <= 50
    assert pages.count() == 100


def sheet(body: str) -> bytes:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rel}><sheets><sheet name="S" r:id="r0"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r0" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


REGULAR = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>a &amp; b</t></is></c><c r="C1" t="str"><v>x&#x41;</v></c></row>'
    '<row><c><v>12</v></c><c/><c t="b"><v>1</v></c></row><row/><row r="5"><c r="B5"><v>1.50</v></c></row>'
)


def test_regular_sheets_are_parsed_once(monkeypatch):
    opened = []
    read = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, **k: opened.append(name) or read(self, name, *a, **k))
    rows = list(workbook._book_rows("p", sheet(REGULAR), None))
    assert opened.count("xl/worksheets/s.xml") == 1
    assert [r["row_idx"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0]["header"] == ["a & b", "Unnamed: 1", "xA"]
    assert rows[1]["cells"] == ["12", None, "True"] and rows[4]["kinds"] == ["e", "n", "e"]


def test_sheets_spelled_otherwise_give_the_same_rows():
    expected = list(workbook._book_rows("p", sheet(REGULAR), None))
    others = [
        REGULAR.replace("<v>12</v>", "<v><![CDATA[12]]></v>"),
        REGULAR.replace("<row/>", "<row/>\n<!-- note -->"),
        REGULAR.replace("<is><t>a &amp; b</t></is>", "<is><r><t>a </t></r><rPh><t>no</t></rPh><r><t>&amp; b</t></r></is>"),
        REGULAR.replace('<c r="A1" t="inlineStr">', "<c t='inlineStr' r='A1'>"),
    ]
    for body in others:
        assert list(workbook._book_rows("p", sheet(body), None)) == expected
    assert "ParseError" in list(workbook._book_rows("p", sheet(REGULAR + "<row>"), None))[0]["error"]


def test_a_spool_on_disk_gives_the_same_rows(monkeypatch):
    body = "".join(f"<row><c><v>{i}</v></c></row>" for i in range(9_000))
    expected = list(workbook._book_rows("p", sheet(body), None))
    monkeypatch.setattr(workbook, "_SPOOL", 1000)
    assert list(workbook._book_rows("p", sheet(body), None)) == expected and len(expected) == 9_000


def test_landed_sheets_carry_their_layout(spark, tmp_path):
    orders = {
        "o_orderkey": pa.array([1, 2], pa.int64()), "o_custkey": pa.array([1, 2], pa.int64()), "o_orderstatus": ["O", None],
        "o_totalprice": [1.0, None], "o_orderdate": pa.array([0, 40 * 86_400_000_000], pa.timestamp("us")), "o_orderpriority": ["LOW", "LOW"],
    }
    pq.write_table(pa.table(orders), tmp_path / "orders.parquet")
    raw = rendered_sheets.bill_sheets(spark, str(tmp_path))
    rows = ledger.statement_rows(raw)
    assert rows.filter(F.col("layout") == align.layout_key()).count() == 2
    assert "md5" not in rows._jdf.queryExecution().optimizedPlan().toString()
    kinds = {r["o_orderkey"]: r["kinds"] for r in raw.collect()}
    assert kinds == {1: ["s"] * 6, 2: ["s", "e", "s", "e", "e", "s"]}


def test_dates_of_file_names_are_made_in_steps(spark):
    days = ["20240101_20240128", "20240231_20240228", "20240101", "2024010_20240128", "00000101_20240128", "20240101_20240128x", "_", "20240301_20240328\n"]
    rows = [(f"/in/{d}_s1.xlsx", "Bill", 0, 1, ["Store ID", "Extra"], ["S1", "7"], ["s", "n"], None) for d in days]
    raw = spark.createDataFrame(
        rows, "path STRING, sheet STRING, sheet_pos INT, row_idx INT, header ARRAY<STRING>, cells ARRAY<STRING>, kinds ARRAY<STRING>, error STRING"
    )
    found = ledger.weekly_statements(ledger.statement_rows(raw))["bill"]
    assert "named_struct(start" not in found._jdf.queryExecution().optimizedPlan().toString()
    dates = F.struct(F.col("statement_start_date").alias("start"), F.col("statement_end_date").alias("end"))
    names = raw.select(text.file_name(F.col("path")).alias("name"), text.file_dates(F.col("path")).alias("d"))
    expected = {r["name"]: tuple(r["d"] or (None, None)) for r in names.collect()}
    assert {r["source_filename"]: tuple(r["d"]) for r in found.select("source_filename", dates.alias("d")).collect()} == expected
    assert sum(d[0] is not None for d in expected.values()) == 2


def statement_inputs(home) -> str:
    """Ten orders with three lines each, parts and events, as the statement queries read them."""
    months = pa.array([i * 31 * 86_400_000_000 for i in range(10)], pa.timestamp("us"))
    keys, thrice = pa.array(range(10), pa.int64()), pa.array([i for i in range(10) for _ in range(3)], pa.int64())
    given = {
        "orders": {
            "o_orderkey": keys, "o_custkey": keys, "o_orderstatus": ["O", "F"] * 5, "o_totalprice": [1.5] * 10, "o_orderdate": months,
            "o_orderpriority": ["LOW"] * 10,
        },
        "lineitem": {
            "l_orderkey": thrice, "l_partkey": thrice, "l_suppkey": thrice, "l_linenumber": pa.array([1, 2, 3] * 10, pa.int32()),
            "l_quantity": [2.0] * 30, "l_extendedprice": [9.5] * 30, "l_discount": [0.1] * 30, "l_tax": [0.0] * 30,
            "l_returnflag": ["A", "N", "R"] * 10, "l_linestatus": ["O", "F"] * 15, "l_shipdate": months.take(thrice),
        },
        "part": {"p_partkey": pa.array(range(9), pa.int64()), "p_name": ["red box"] * 9},
        "events": {"event_id": keys, "ts": months, "user_id": keys, "event_type": ["view"] * 10, "value": [0.5] * 10},
    }
    for name, columns in given.items():
        pq.write_table(pa.table(columns), home / f"{name}.parquet")
    return str(home)


def test_statement_rows_are_landed_once_and_go_when_stored(spark, tmp_path, monkeypatch):
    landed, write = [], session.written
    monkeypatch.setattr(session, "written", lambda df, name, *a, **k: landed.append((name, out := write(df, name, *a, **k))) or out)
    found = ledger_queries.statement_tables(spark, statement_inputs(tmp_path))
    assert [name for name, _ in landed] == ["statement-rows", "layouts"]
    assert not any(Path(f.removeprefix("file://")).exists() for _, df in landed for f in df.inputFiles())
    counts = {r["tab"]: (r["outcome"], r["rows"]) for r in found.collect()}
    assert counts["bill details"] == ("ok", 27) and counts["bill"] == ("ok", 10) and counts["storage fee"] == ("ok", 10)


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_what_a_landing_by_folder_shuffled_goes_with_its_end(spark):
    before = shuffle_files(spark)
    rows = spark.range(0, 4000, 1, 4).repartition(3).selectExpr("id", "concat('t', id % 5) AS tab")
    seen = session.written(rows, "by-folder", ["tab"])
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert seen.count() == 4000


@pytest.mark.parametrize("folders", [5, 40])  # 40: more than writers are open
def test_rows_landed_by_folder(spark, folders):
    settings = {key: spark.conf.get(key) for key in session._BY_FOLDER}
    rows = spark.range(0, 4000, 1, 4).repartition(2).selectExpr("id", f"concat('t', id % {folders}) AS tab")
    seen = session.written(rows, "by-folder", ["tab"], codec="zstd")
    assert sorted(map(tuple, seen.select("id", "tab").collect())) == sorted(map(tuple, rows.collect()))
    assert all(f.endswith(".zstd.parquet") for f in seen.inputFiles()) and len(seen.inputFiles()) >= folders
    assert {key: spark.conf.get(key) for key in session._BY_FOLDER} == settings


def test_lines_are_moved_once_for_their_names(spark, tmp_path):
    sheets = rendered_sheets.detail_sheets(spark, statement_inputs(tmp_path), land=False)
    plan = sheets._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "RoundRobinPartitioning" not in plan and "Sort [" not in plan


def test_tables_of_many_row_groups_are_not_dealt(spark, tmp_path):
    home = tmp_path / "a b"
    (home / "events.parquet").mkdir(parents=True)
    for i in range(8):
        pq.write_table(pa.table({"event_id": pa.array(range(i * 10, i * 10 + 10), pa.int64())}), home / f"events.parquet/{i}.parquet")
    pq.write_table(pa.table({"o_orderkey": pa.array(range(80), pa.int64())}), home / "orders.parquet", row_group_size=5)
    dealt = lambda df: "RoundRobinPartitioning" in df._jdf.queryExecution().executedPlan().toString()
    # Eight files are read by all four cores, two each; sixteen row groups of one small file are read by one.
    events, orders = tables.spread(spark, str(home), "events"), tables.spread(spark, str(home), "orders")
    assert not dealt(events) and dealt(orders)
    assert sorted(r[0] for r in events.collect()) == sorted(r[0] for r in orders.collect()) == list(range(80))
