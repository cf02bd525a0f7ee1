"""Scalar rules against the standard library and pandas."""

from __future__ import annotations

import random
from urllib.parse import parse_qs, urljoin, urlparse

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyshelf.functions import text, typed, urls
from tallyshelf.operators import align
from tallyshelf.plans import catalogue

ATOMS = ["/", "//", "a", "b", "..", ".", "?", "#", ";", "x=1", "h.com", "https:", "http:", "mailto:", "[", "]", " ", "é",
         "%20", "&", "ean=", "ean=7", "+", "product/", "\t", ":", "@"]
BASES = ["https://shop.example", "https://s.example/category/b/", "https://s.example/c/d?q=1", "http://s.example/c/../d;p?q#f"]


def strings(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ATOMS) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def test_absolute_url_equals_urljoin(spark):
    fixed = ["", "/", "//", "?", "#", ";", "/a;b/c;d", "a;b", "//[::1]/x", "//[bad/x", "HTTPS://H/x", "/a/..", "data:x,y"]
    cases = [(h, b) for h in {*fixed, *strings(1500, 1)} for b in BASES]
    df = spark.createDataFrame(cases, "h STRING, b STRING").select("h", "b", urls.absolute_url(F.col("h"), F.col("b")).alias("u"))
    for r in df.collect():
        try:
            expected = urljoin(r["b"], r["h"]) if r["h"] else ""
        except ValueError:
            expected = None
        assert r["u"] == expected, (r["b"], r["h"])


def test_slug_and_query_value(spark):
    def slug(u):
        path = urlparse(u).path
        return path.split("/product/", 1)[1].strip("/").split("/")[0] if "/product/" in path else path.strip("/")

    hosts = [f"https://h.example/{s.replace('[', '').replace(']', '')}" for s in strings(1500, 2)]
    df = spark.createDataFrame([(u,) for u in hosts], "u STRING")
    for r in df.select("u", urls.product_slug(F.col("u")).alias("s"), urls.query_value(F.col("u"), "ean").alias("e")).collect():
        assert r["s"] == slug(r["u"]), r["u"]
        assert r["e"] == (parse_qs(urlparse(r["u"]).query).get("ean") or [""])[0], r["u"]


@pytest.mark.parametrize(
    "query, value",
    [("ean=a%2Bb+c", "a+b c"), ("EAN=1", ""), ("ean=&ean=2", "2"), ("x=1;ean=2", ""), ("seen=1&ean=3", "3"), ("ean=%C3%A9", "é")],
)
def test_query_value_cases(spark, query, value):
    assert spark.range(1).select(urls.query_value(F.lit(f"/product/x?{query}#ean=9"), "ean")).first()[0] == value


def test_numbers_follow_pandas(spark):
    cells = [" 5 ", "1e3", "+7", ".5", "5.", "inf", "-inf", "Infinity", "1,200", "5d", "0x10", "1_000", "true", "5f", "1e", "e5",
             "--1", "+-1", ".", "", " ", "1 2", "1e400", "12345678901234567", "0x1p3", "NaN", "5D", "٣"]
    df = spark.createDataFrame([(c,) for c in cells], "c STRING").select("c", typed.number_or_null(F.col("c")).alias("n"))
    for r in df.collect():
        expected = pd.to_numeric(pd.Series([r["c"]]), errors="coerce").iloc[0]
        assert (None if pd.isna(expected) else float(expected)) == r["n"], r["c"]


def value_of(spark, c, cell):
    return spark.createDataFrame([(cell,)], "c STRING").select(c(F.col("c"))).first()[0]


def test_strict_numbers(spark):
    assert value_of(spark, typed.whole_or_fail, None) == 0
    assert value_of(spark, typed.whole_or_fail, "1.9") == 1
    assert value_of(spark, typed.whole_or_fail, "-1.9") == -1
    assert value_of(spark, typed.number_or_fail, " 2.5 ") == 2.5
    for bad in ("5d", "abc", "inf"):
        with pytest.raises(Exception):
            value_of(spark, typed.whole_or_fail, bad)


def test_whole_numbers(spark):
    null = lambda c: typed.whole_or_null(c, "null")
    assert value_of(spark, null, "9007199254740993") == 9007199254740993
    assert value_of(spark, null, "3.0") == 3
    assert value_of(spark, null, "3.7") is None
    assert value_of(spark, null, "inf") is None
    assert value_of(spark, typed.whole_or_null, "x") is None
    with pytest.raises(Exception, match="not a whole number"):
        value_of(spark, typed.whole_or_null, "3.7")
    with pytest.raises(ValueError):
        typed.whole_or_null(F.lit("1"), "drop")


@pytest.mark.parametrize(
    "cell, shown",
    [
        ("2024-04-01", "2024-04-01 00:00:00"),
        ("2024-04-01 10:11", "2024-04-01 10:11:00"),
        ("2024-04-01T10:11:12.5", "2024-04-01 10:11:12.500000"),
        ("2024/04/02 01:02:03", "2024-04-02 01:02:03"),
        ("04/02/2024", "2024-04-02 00:00:00"),
        ("13/02/2024", None),
        ("2024-02-31", None),
        ("2024", None),
        ("2024-04", None),
        ("12:30", None),
        ("", None),
    ],
)
def test_timestamps_do_not_depend_on_other_rows(spark, cell, shown):
    found = value_of(spark, typed.stamp_or_null, cell)
    assert (None if found is None else str(found)) == shown


def test_strip_equals_python(spark):
    cells = [f"{a}x{chr(c)}y{chr(c)}" for c in (*range(0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF) for a in ("", chr(c))]
    df = spark.createDataFrame([(c,) for c in cells], "c STRING")
    for r in df.select("c", text.strip(F.col("c")).alias("s"), text.collapse_space(F.col("c")).alias("o")).collect():
        assert r["s"] == r["c"].strip()
        assert r["o"] == " ".join(r["c"].split())


def test_text_rules(spark):
    assert value_of(spark, text.null_text, "nan") is None
    assert value_of(spark, text.null_text, "None") == "None"
    assert value_of(spark, text.na_to_null, "None") is None
    assert value_of(spark, text.na_to_null, " ") == " "
    assert value_of(spark, text.strip_leading_commas, ",, 1,") == " 1,"
    assert value_of(spark, text.category_label, "smart-office") == "Smart Office"
    assert value_of(spark, text.collapse_space, None) == ""


def test_na_tokens_are_the_readers_own():
    from pandas._libs.parsers import STR_NA_VALUES

    assert set(text.NA_TOKENS) == set(STR_NA_VALUES)


@pytest.mark.parametrize(
    "name, ok",
    [("20240401_20240427_x.xlsx", True), ("/a/b/20240401_20240427_.xlsx", True), ("20240401_20240427.xlsx", False),
     ("20240231_20240301_x.xlsx", False), ("20240401_2024427_x.xlsx", False), ("20240401.xlsx", False), ("x_20240401_20240427_.xlsx", False)],
)
def test_file_dates(spark, name, ok):
    dates = value_of(spark, text.file_dates, name)
    assert (dates is not None) == ok
    if ok:
        assert [str(d) for d in dates] == ["2024-04-01", "2024-04-27"]


@pytest.mark.parametrize(
    "raw, name",
    [("X (1)", "x__1"), ("X(1)", "x_1"), (" Order No. ", "order_no"), ("Fee（KES）", "fee_kes"), ("A  B", "a__b"), ("Unnamed: 3", "unnamed:_3")],
)
def test_finance_headers(spark, raw, name):
    assert align.clean_header(raw) == name
    assert value_of(spark, align.clean_header_column, raw) == name


def test_snake_headers():
    assert align.snake_header("Non-FBK Inventory", {"Non-FBK Inventory": "non_fbk_inventory"}) == "non_fbk_inventory"
    assert align.snake_header("Non-FBK  Inventory (x)") == "non_fbk_inventory_x"
    assert align.snake_header("  Été 2 ") == "été_2"


def test_local_run_stamp(spark):
    row = spark.range(1).select(catalogue.local_stamp_text("2024-05-01 22:30:15.9"), catalogue.run_stamp("2024-05-01 22:30:15.9"))
    assert row.first()[0] == "2024-05-02 01:30:15"
    assert str(row.first()[1]) == "2024-05-01 22:30:15"
