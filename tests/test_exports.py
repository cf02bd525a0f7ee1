"""CSV exports: records over split files, headers, one scan for many files."""

import csv
import io
import random

import pytest

from tallyshelf.functions.text import NA_TOKENS
from tallyshelf.sources import exports

CELLS = ["", "a", "b c", 'say "x"', "two\nlines", "x,y", '"', '""', "\n", 'q",\n"r', "N/A", "5' 3", "ünï", "\n\n,\"\n"]


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "48", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def key(row):
    return row[0], row[1], tuple((c is not None, c or "") for c in row[2])


def as_sorted(rows):
    return sorted(rows, key=key)


def table(spark, spot, **options):
    found = exports.csv_rows(spark, str(spot), **options).collect()
    return as_sorted([(r["path"].rsplit("/", 1)[-1], tuple(r["header"]), tuple(r["cells"])) for r in found])


def test_records_of_split_files_as_the_csv_module_reads_them(spark, tmp_path, small_splits):
    rng = random.Random(5)
    expected = []
    for n in range(4):
        width = rng.randint(2, 4)
        header = [f"h{n}{i}" for i in range(width)]
        rows = [[rng.choice(CELLS) for _ in range(width - 1)] + ["end"] for _ in range(25)]
        if n == 3:  # no cell with a line break: lines are records
            rows = [[c.replace("\n", " ") for c in row] for row in rows]
        shown = io.StringIO()
        csv.writer(shown, lineterminator="\r\n" if n == 1 else "\n").writerows([header, *rows])
        (tmp_path / f"f{n}.csv").write_bytes(shown.getvalue().encode())
        expected += [(f"f{n}.csv", tuple(header), tuple(None if c in NA_TOKENS or c == "" else c for c in row)) for row in rows]
    assert table(spark, tmp_path) == as_sorted(expected)


def test_headers_short_and_long_rows_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,,id,id.1,\n\n1,2\n   \n1,2,3,4,5,6\n")
    (tmp_path / "b.csv").write_text('"first\nname",b\nx,5" screen\ny,"5"" screen"\n')
    (tmp_path / "c.csv").write_text("only,header\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "e.csv").write_text("k,v\nk,v\n")  # a row that repeats the header is a row
    a = ("id", "Unnamed: 1", "id.1", "id.1.1", "Unnamed: 4")
    b = ("first\nname", "b")
    assert table(spark, tmp_path) == as_sorted([
        ("a.csv", a, ("1", "2", None, None, None)),
        ("a.csv", a, ("1", "2", "3", "4", "5")),
        ("b.csv", b, ("x", '5" screen')),
        ("b.csv", b, ("y", '5" screen')),
        ("e.csv", ("k", "v"), ("k", "v")),
    ])


def test_lines_are_records_where_asked(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\n2,y\n')
    assert [r[2][0] for r in table(spark, tmp_path, line_breaks=False)] == ["1", "2"]


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n")
    assert exports.csv_rows(spark, str(tmp_path)).count() == 0


def test_many_headers_are_one_scan(spark, tmp_path):
    for n in range(200):
        (tmp_path / f"f{n}.csv").write_text(f"a,h{n}\n{n},x\n")
    rows = exports.csv_rows(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Union" not in plan  # the lines and the headers
    assert sorted(int(r["cells"][0]) for r in rows.filter("header[1] = concat('h', cells[0])").collect()) == list(range(200))
