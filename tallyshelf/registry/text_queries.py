"""Registered queries for text, URL, number and time rules over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf.functions import text, typed, urls
from tallyshelf.operators import align, products, tiles
from tallyshelf.registry.tables import table
from tallyshelf.sources.page_facts import outline_facts

BASE = "https://shop.example/category/list/"


def _outline(spark: SparkSession, sf: str, added: str = "''") -> DataFrame:
    """Outlines of the given pages, with ``added`` markup at their end."""
    pages = table(spark, sf, "pages").select("page_id", F.concat("html", F.expr(added)).alias("html"))
    return pages.select("page_id", outline_facts(F.col("html")).alias("f"))


def strip_query(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.without_query(F.col("url")).alias("clean_url"))


def url_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.product_slug(F.col("url")).alias("slug"))


def url_param(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        urls.query_value(u, "utm_source").alias("utm_source"),
        urls.query_value(u, "page").alias("page"),
        urls.query_value(u, "ref").alias("ref"),
    )


def absolute_url(spark, sf):
    """Every link of every page, resolved against the page's own address."""
    pages = table(spark, sf, "pages")
    hrefs = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    return pages.select("page_id", "url", hrefs.alias("href")).select(
        "page_id", "href", urls.absolute_url(F.col("href"), F.col("url")).alias("absolute")
    )


def product_links(spark, sf):
    """Part addresses in several spellings; which of them count as product links."""
    parts = table(spark, sf, "part").selectExpr(
        "p_partkey",
        """CASE p_size % 5 WHEN 0 THEN concat('/product/', p_partkey, '?add-to-cart=1')
             WHEN 1 THEN concat('/product/add-to-cart/', p_partkey) WHEN 2 THEN concat('/shop?u=/product/', p_partkey)
             WHEN 3 THEN concat('//cdn.example/product/', p_partkey) ELSE concat('../product/', p_partkey, '#top') END AS href""",
    )
    url = urls.without_query(urls.absolute_url(F.col("href"), BASE))
    return parts.select("p_partkey", url.alias("url")).filter(urls.is_product_link(F.col("url")))


def page_links_max(spark, sf):
    """Page count from links alone, 1 where no link carries a page number; every third page has a pager."""
    hrefs = F.col("f.hrefs")
    numbers = F.transform(hrefs, lambda h: F.regexp_extract(h, r"page=(\d+)", 1).try_cast("int"))
    pager = """IF(page_id % 3 = 0, concat('<p><a href="/list?page=2">2</a> <a href="/list?page=', page_id % 40 + 3, '">last</a></p>'), '')"""
    rows = _outline(spark, sf, pager).select("page_id", F.array_max(numbers).alias("top"), F.size(hrefs).alias("links"))
    return rows.select("page_id", tiles.total_pages(F.lit(None).cast("int"), F.col("top")).alias("total_pages"), "links")


def page_heading(spark, sf):
    return _outline(spark, sf).select("page_id", text.collapse_space(F.col("f.heading")).alias("heading"))


def page_feature_lists(spark, sf):
    """Densest list of every given page: its navigation, and on every second page a list of features."""
    lists = F.col("f.lists")
    features = "IF(page_id % 2 = 0, concat('<ul><li>Size: ', page_id, '</li><li>plain</li><li>Type: b</li></ul>'), '')"
    return _outline(spark, sf, features).select(
        "page_id", F.size(lists).alias("lists"), F.to_json(products.fullest_list(lists)).alias("features")
    )


def document_stock_state(spark, sf):
    """Document texts with a stock phrase behind them by id, spread over two lines."""
    phrase = F.expr(
        "CASE doc_id % 5 WHEN 0 THEN ' Sold\n OUT' WHEN 1 THEN ' now In\tStock.' WHEN 2 THEN ' reinstock' WHEN 3 THEN ' in stock, out of  stock' ELSE '' END"
    )
    state = products.stock_state_of(text.collapse_space(F.concat("text", phrase)))
    return table(spark, sf, "documents").select("doc_id", state.alias("in_stock"))


def conversation_stock_state(spark, sf):
    """Wording planted by row values: the table's own text with a stock phrase around it."""
    rows = table(spark, sf, "conversations").selectExpr(
        "conv_id",
        "turn",
        """concat(CASE (conv_id + turn) % 4 WHEN 0 THEN 'Sold OUT. ' WHEN 1 THEN 'now In Stock! ' WHEN 2 THEN 'reinstock ' ELSE '' END, text,
             CASE WHEN conv_id % 5 = 0 THEN ' Out of stock' ELSE '' END) AS said""",
    )
    return rows.select("conv_id", "turn", products.stock_state_of(F.col("said")).alias("in_stock"))


def collapse_space(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.collapse_space(F.col("text")).alias("line"))


def strip_text(spark, sf):
    padded = F.concat(F.lit(" \t  "), F.coalesce("text", F.lit("")), F.lit("\n　 "))
    return table(spark, sf, "documents").select("doc_id", text.strip(padded).alias("stripped"))


def null_text(spark, sf):
    cell = F.expr(
        """CASE event_type WHEN 'error' THEN 'nan' WHEN 'signup' THEN 'NaT' WHEN 'view' THEN 'None'
             WHEN 'click' THEN 'NAN' ELSE props END"""
    )
    return table(spark, sf, "events").select("event_id", text.null_text(cell).alias("cell"))


def na_tokens(spark, sf):
    tokens = F.array(*[F.lit(t) for t in (*text.NA_TOKENS, "na", "Nan", " ", "-", "0")])
    cell = F.element_at(tokens, (F.col("event_id") % 24 + 1).cast("int"))
    rows = table(spark, sf, "events").select("event_type", cell.alias("cell"))
    kept = rows.select("event_type", text.na_to_null(F.col("cell")).alias("kept"))
    return kept.groupBy("event_type", "kept").agg(F.count("*").alias("cells"))


def comma_strip(spark, sf):
    rows = table(spark, sf, "orders")
    sn = F.concat(F.expr("repeat(',', CAST(o_custkey % 4 AS INT))"), F.expr("IF(o_custkey % 3 = 0, ' ', '')"), "o_orderkey", F.lit(","))
    return rows.select("o_orderkey", text.strip_leading_commas(sn).alias("order_sn"))


def category_labels(spark, sf):
    slug = F.expr("concat(replace(p_name, ' ', '-'), '-', lower(p_type))")
    return table(spark, sf, "part").select("p_partkey", text.category_label(slug).alias("category"))


def price_text(spark, sf):
    """Price blocks as raw facts: sale, range with repeats, single, none."""
    c = F.expr("CAST(round(p_retailprice * 100) AS BIGINT)")
    amount = lambda extra: F.concat(F.lit("KSh "), (c + extra).cast("string"))
    kind = F.col("p_size") % 5
    price = F.when(
        kind != 4,
        F.struct(
            F.when(kind == 0, amount(500)).alias("was"),
            F.when((kind == 0) | (kind == 1), amount(0)).alias("now"),
            F.when(kind == 2, F.array(amount(0), F.lit(""), amount(900), amount(0), amount(100)))
            .otherwise(F.array(amount(0), amount(0)))
            .alias("amounts"),
            F.concat(F.lit("from "), amount(0)).alias("full"),
        ),
    )
    return table(spark, sf, "part").select("p_partkey", products.price_text(price).alias("price_raw"))


def distinct_join(spark, sf):
    """Brands of every type in name order, first seen first."""
    rows = table(spark, sf, "events").select(
        "event_id",
        F.array("event_type", F.expr("CAST(user_id AS STRING)"), "event_type", F.lit("view"), F.expr("CAST(user_id AS STRING)")).alias("items"),
    )
    return rows.select("event_id", text.distinct_join(F.col("items")).alias("joined"))


def _spelled(value: str) -> str:
    return f"""CASE event_id % 12 WHEN 0 THEN CAST({value} AS STRING) WHEN 1 THEN concat(' ', CAST({value} AS STRING), ' ')
        WHEN 2 THEN concat(CAST(CAST({value} AS BIGINT) AS STRING), 'd') WHEN 3 THEN '1,200' WHEN 4 THEN '1e3'
        WHEN 5 THEN '+7' WHEN 6 THEN '.5' WHEN 7 THEN '5.' WHEN 8 THEN '0x10' WHEN 9 THEN '1_000' WHEN 10 THEN 'true'
        ELSE concat('-', CAST(CAST({value} AS BIGINT) AS STRING)) END"""


def numeric_coerce(spark, sf):
    rows = table(spark, sf, "events").selectExpr("event_id", f"{_spelled('value')} AS cell")
    return rows.select("event_id", "cell", typed.number_or_null(F.col("cell")).alias("number")).drop("cell")


def numeric_strict(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "IF(l_returnflag = 'R', NULL, CAST(l_quantity + 0.9 AS STRING)) AS qty",
        "IF(l_discount = 0, NULL, CAST(l_discount AS STRING)) AS discount",
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        typed.whole_or_fail(F.col("qty")).alias("sold_qty"),
        typed.number_or_fail(F.col("discount")).alias("discount"),
    )


def int_check(spark, sf):
    """Whole numbers in several spellings; fractions become NULL here, long ids stay exact."""
    cell = F.expr(
        """CASE event_id % 6 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN concat(CAST(user_id AS STRING), '.0')
             WHEN 2 THEN CAST(9007199254740993 + event_id AS STRING) WHEN 3 THEN '3.7' WHEN 4 THEN '2e3' ELSE props END"""
    )
    return table(spark, sf, "events").select("event_id", typed.whole_or_null(cell, "null").alias("whole"))


def timestamp_coerce(spark, sf):
    cell = F.expr(
        """CASE event_id % 9 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') WHEN 1 THEN date_format(ts, 'yyyy-MM-dd')
             WHEN 2 THEN date_format(ts, "yyyy/MM/dd HH:mm") WHEN 3 THEN date_format(ts, 'MM/dd/yyyy HH:mm:ss')
             WHEN 4 THEN '2024' WHEN 5 THEN '2024-04' WHEN 6 THEN '2024-02-30' WHEN 7 THEN props
             ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") END"""
    )
    rows = table(spark, sf, "events").select("event_id", cell.alias("cell"))
    stamp = typed.stamp_or_null(F.col("cell"))
    return rows.select("event_id", stamp.alias("stamp"), typed.date_or_null(F.col("cell")).alias("day"))


def day_first_stamps(spark, sf):
    """A column of day-first texts, of which many would fit the other order too."""
    cell = F.expr("IF(event_id % 3 = 0, date_format(ts, 'd/M/yyyy'), date_format(ts, 'dd/MM/yyyy HH:mm:ss'))")
    rows = table(spark, sf, "events").select("event_id", cell.alias("cell"))
    order = typed.day_first_columns(rows, {"cell": F.col("cell")})
    return rows.select("event_id", typed.stamp_or_null(F.col("cell"), day_first=order["cell"]).alias("stamp"))


def mixed_fraction_stamps(spark, sf):
    """Long fractions, zones, one-digit parts and month-first texts."""
    cell = F.expr(
        """CASE event_id % 6 WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789Z'")
             WHEN 1 THEN date_format(ts, "yyyy-MM-dd HH:mm:ss'+03:00'") WHEN 2 THEN date_format(ts, 'M/d/yyyy H:mm')
             WHEN 3 THEN date_format(ts, 'yyyy-M-d H:mm:ss.S') WHEN 4 THEN '31/12/2024' ELSE date_format(ts, 'yyyy/M/d') END"""
    )
    rows = table(spark, sf, "events").select("event_id", cell.alias("cell"))
    order = typed.day_first_columns(rows, {"cell": F.col("cell")})
    return rows.select("event_id", typed.stamp_or_null(F.col("cell"), day_first=order["cell"]).alias("stamp"))


def epoch_numbers(spark, sf):
    """Number cells in a time column count nanoseconds since the epoch."""
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "CAST(CAST(event_id AS DECIMAL(20, 0)) * 86400000000000 + CAST(user_id AS DECIMAL(20, 0)) * 1000000000 AS STRING) AS cell",
    )
    return rows.select("event_id", typed.stamp_or_null(F.col("cell"), F.lit("n")).alias("stamp"))


def flag_cast(spark, sf):
    cell = F.expr(
        "CASE event_type WHEN 'view' THEN 'True' WHEN 'click' THEN 'false' WHEN 'error' THEN 'maybe' WHEN 'signup' THEN '1' END"
    )
    return table(spark, sf, "events").select("event_id", typed.flag_or_null(cell).alias("flag"))


def filename_dates(spark, sf):
    path = F.expr(
        """concat('/in/', CASE o_orderkey % 5
             WHEN 0 THEN concat(date_format(o_orderdate, 'yyyyMMdd'), '_', date_format(o_orderdate + INTERVAL 6 DAY, 'yyyyMMdd'), '_s1')
             WHEN 1 THEN concat(date_format(o_orderdate, 'yyyyMMdd'), '_', date_format(o_orderdate, 'yyyyMMdd'))
             WHEN 2 THEN concat(date_format(o_orderdate, 'yyyyMM'), '31_', date_format(o_orderdate, 'yyyyMMdd'), '_s')
             WHEN 3 THEN date_format(o_orderdate, 'yyyyMMdd') ELSE concat('x_', date_format(o_orderdate, 'yyyyMMdd'), '_y') END, '.xlsx')"""
    )
    rows = table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    dates = text.file_dates(F.col("path"))
    return rows.select(
        "o_orderkey",
        text.file_name(F.col("path")).alias("source_filename"),
        dates["start"].alias("statement_start_date"),
        dates["end"].alias("statement_end_date"),
    )


def header_cleaning(spark, sf):
    """Header strings made from part attributes, cleaned as a column."""
    raw = F.expr(
        """concat(' ', initcap(p_name), CASE p_size % 4 WHEN 0 THEN ' (1)' WHEN 1 THEN '(1)' WHEN 2 THEN '（KES） No.' ELSE '' END, ' ', p_type, '\t')"""
    )
    return table(spark, sf, "part").select("p_partkey", align.clean_header_column(raw).alias("column_name"))


def snake_headers(spark, sf):
    """Stock headers on a real frame; the export's names map to declared ones."""
    frame = table(spark, sf, "part").selectExpr(
        "p_partkey AS ListingId", "p_size AS `Non-FBK Inventory`", "p_name AS `Some (other) -- name`", "p_type AS `Status`"
    )
    return align.snake_columns(frame, {"ListingId": "listing_id", "Non-FBK Inventory": "non_fbk_inventory"})


QUERIES = {
    "day_first_stamps": day_first_stamps,
    "mixed_fraction_stamps": mixed_fraction_stamps,
    "strip_query": strip_query,
    "url_slug": url_slug,
    "url_param": url_param,
    "absolute_url": absolute_url,
    "product_links": product_links,
    "page_links_max": page_links_max,
    "page_heading": page_heading,
    "page_feature_lists": page_feature_lists,
    "document_stock_state": document_stock_state,
    "conversation_stock_state": conversation_stock_state,
    "collapse_space": collapse_space,
    "strip_text": strip_text,
    "null_text": null_text,
    "na_tokens": na_tokens,
    "comma_strip": comma_strip,
    "category_labels": category_labels,
    "price_text": price_text,
    "distinct_join": distinct_join,
    "numeric_coerce": numeric_coerce,
    "numeric_strict": numeric_strict,
    "int_check": int_check,
    "timestamp_coerce": timestamp_coerce,
    "epoch_numbers": epoch_numbers,
    "flag_cast": flag_cast,
    "filename_dates": filename_dates,
    "header_cleaning": header_cleaning,
    "snake_headers": snake_headers,
}

# Entities that occur in the given pages, decoded in an order that keeps &amp; last.
_DECODED = (
    "replace(replace(replace(replace(replace(replace(replace({}, '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), "
    "'&gt;', '>'), '&quot;', '\"'), '&nbsp;', chr(160)), '&amp;', '&')"
)
_SPACE = "[\\s\\v\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{1c}-\\x{1f}]"

SQL = {
    "day_first_stamps": """
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS stamp FROM events""",
    "mixed_fraction_stamps": """
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts) - INTERVAL 3 HOUR
          WHEN 2 THEN date_trunc('minute', ts)
          WHEN 3 THEN date_trunc('second', ts) + to_milliseconds(100 * (millisecond(ts) % 1000 // 100))
          WHEN 5 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS stamp FROM events""",
    "strip_query": "SELECT page_id, regexp_replace(url, '[?#].*$', '') AS clean_url FROM pages",
    "url_slug": """
        SELECT page_id, trim(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-z]+://[^/]*', ''), '/') AS slug FROM pages""",
    "url_param": """
        SELECT page_id, regexp_extract(q, '&utm_source=([^&]+)', 1) AS utm_source, regexp_extract(q, '&page=([^&]+)', 1) AS page,
          regexp_extract(q, '&ref=([^&]+)', 1) AS ref
        FROM (SELECT page_id, '&' || regexp_extract(url, '^[^#?]*[?]([^#]*)', 1) AS q FROM pages)""",
    "absolute_url": """
        SELECT page_id, href, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href ELSE href END AS absolute
        FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)""",
    "product_links": """
        SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'https://shop.example/product/' || p_partkey
            WHEN 3 THEN 'https://cdn.example/product/' || p_partkey ELSE 'https://shop.example/category/product/' || p_partkey END AS url
        FROM part WHERE p_size % 5 IN (0, 3, 4)""",
    "page_links_max": """
        SELECT page_id, CAST(coalesce(list_max(list_transform(regexp_extract_all(html, '<a [^>]*href="[^"]*page=(\\d+)', 1), lambda x: CAST(x AS INTEGER))), 1) AS INTEGER) AS total_pages,
          CAST(len(regexp_extract_all(html, '<a [^>]*href=')) AS INTEGER) AS links
        FROM (SELECT page_id, html || CASE WHEN page_id % 3 = 0 THEN '<a href="?page=' || (page_id % 40 + 3) || '"><a href="?page=2">' ELSE '' END AS html FROM pages)""",
    "page_heading": f"""
        SELECT page_id, trim(regexp_replace({_DECODED.format("regexp_replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '&amp$', '&amp;')")}, '{_SPACE}+', ' ', 'g')) AS heading FROM pages""",
    "page_feature_lists": """
        SELECT page_id, CAST(len(regexp_extract_all(html, '<ul[ >]')) + 1 - page_id % 2 AS INTEGER) AS lists,
          CASE WHEN page_id % 2 = 0 THEN '["Size: ' || page_id || '","plain","Type: b"]' WHEN len(items) >= 3 AND len(list_filter(items, lambda x: contains(x, ':'))) > 0
               THEN '[' || array_to_string(list_transform(items, lambda x: '"' || x || '"'), ',') || ']' ELSE '[]' END AS features
        FROM (SELECT page_id, html, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items FROM pages)""",
    "document_stock_state": """
        SELECT doc_id, CASE WHEN contains(lower(t), 'sold out') OR contains(lower(t), 'out of stock') THEN false
          WHEN regexp_matches(lower(t), '\\bin stock\\b') THEN true END AS in_stock
        FROM (SELECT doc_id, regexp_replace(text || CASE doc_id % 5 WHEN 0 THEN ' sold out' WHEN 1 THEN ' in stock.' WHEN 2 THEN ' reinstock'
          WHEN 3 THEN ' out of stock' ELSE '' END, '\\s+', ' ', 'g') AS t FROM documents)""",
    "conversation_stock_state": """
        SELECT conv_id, turn, CASE WHEN contains(said, 'sold out') OR contains(said, 'out of stock') THEN false
          WHEN regexp_matches(said, '\\bin stock\\b') THEN true END AS in_stock
        FROM (SELECT conv_id, turn, lower(CASE (conv_id + turn) % 4 WHEN 0 THEN 'Sold OUT. ' WHEN 1 THEN 'now In Stock! '
            WHEN 2 THEN 'reinstock ' ELSE '' END || text || CASE WHEN conv_id % 5 = 0 THEN ' Out of stock' ELSE '' END) AS said
          FROM conversations)""",
    "collapse_space": f"SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g')) AS line FROM documents",
    "strip_text": f"SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '^{_SPACE}+', ''), '{_SPACE}+$', '') AS stripped FROM documents",
    "null_text": """
        SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL WHEN 'view' THEN 'None'
          WHEN 'click' THEN 'NAN' ELSE props END AS cell FROM events""",
    "na_tokens": """
        SELECT event_type, CASE event_id % 24 WHEN 19 THEN 'na' WHEN 20 THEN 'Nan' WHEN 21 THEN ' ' WHEN 22 THEN '-'
          WHEN 23 THEN '0' END AS kept, count(*) AS cells FROM events GROUP BY ALL""",
    "comma_strip": """
        SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN ' ' ELSE '' END || o_orderkey || ',' AS order_sn FROM orders""",
    "category_labels": """
        SELECT p_partkey, upper(left(a, 1)) || substring(a, 2) || ' ' || upper(left(b, 1)) || substring(b, 2) || ' ' ||
          left(p_type, 1) || lower(substring(p_type, 2)) AS category
        FROM (SELECT *, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)""",
    "price_text": """
        SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'KSh ' || (c + 500) || ' -> KSh ' || c WHEN 1 THEN 'from KSh ' || c
          WHEN 2 THEN 'KSh ' || c || ' - KSh ' || (c + 900) || ' - KSh ' || (c + 100) WHEN 3 THEN 'from KSh ' || c ELSE '' END AS price_raw
        FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS c FROM part)""",
    "distinct_join": """
        SELECT event_id, event_type || ' - ' || user_id || CASE WHEN event_type = 'view' THEN '' ELSE ' - view' END AS joined FROM events""",
    "numeric_coerce": """
        SELECT event_id, CASE event_id % 12 WHEN 0 THEN value WHEN 1 THEN value WHEN 4 THEN 1000.0 WHEN 5 THEN 7.0 WHEN 6 THEN 0.5
          WHEN 7 THEN 5.0 WHEN 11 THEN -CAST(trunc(value) AS DOUBLE) END AS number FROM events""",
    "numeric_strict": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(trunc(l_quantity + 0.9) AS BIGINT) END AS sold_qty,
          l_discount AS discount FROM lineitem""",
    "int_check": """
        SELECT event_id, CASE event_id % 6 WHEN 0 THEN CASE WHEN value = floor(value) THEN CAST(value AS BIGINT) END
          WHEN 1 THEN user_id WHEN 2 THEN 9007199254740993 + event_id WHEN 4 THEN 2000 END AS whole FROM events""",
    "timestamp_coerce": """
        SELECT event_id, stamp, CAST(stamp AS DATE) AS day FROM (
          SELECT event_id, CASE event_id % 9 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts)
            WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('second', ts) WHEN 8 THEN ts END AS stamp FROM events)""",
    "epoch_numbers": """
        SELECT event_id, TIMESTAMP '1970-01-01' + to_seconds(event_id * 86400 + user_id) AS stamp FROM events""",
    "flag_cast": """
        SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false WHEN 'signup' THEN true END AS flag FROM events""",
    "filename_dates": """
        WITH f AS (
          SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5
            WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d') || '_s1'
            WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate, '%Y%m%d')
            WHEN 2 THEN strftime(o_orderdate, '%Y%m') || '31_' || strftime(o_orderdate, '%Y%m%d') || '_s'
            WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'x_' || strftime(o_orderdate, '%Y%m%d') || '_y' END || '.xlsx' AS source_filename
          FROM orders),
        d AS (
          SELECT o_orderkey, source_filename, CASE WHEN length(split_part(source_filename, '_', 1)) = 8 AND length(split_part(source_filename, '_', 2)) = 8
              THEN CAST(try_strptime(split_part(source_filename, '_', 1), '%Y%m%d') AS DATE) END AS a,
            CASE WHEN length(split_part(source_filename, '_', 1)) = 8 AND length(split_part(source_filename, '_', 2)) = 8
              THEN CAST(try_strptime(split_part(source_filename, '_', 2), '%Y%m%d') AS DATE) END AS b FROM f)
        SELECT o_orderkey, source_filename, CASE WHEN b IS NOT NULL THEN a END AS statement_start_date,
          CASE WHEN a IS NOT NULL THEN b END AS statement_end_date FROM d""",
    "header_cleaning": """
        SELECT p_partkey, replace(p_name, ' ', '_') || CASE p_size % 4 WHEN 0 THEN '__1' WHEN 1 THEN '_1' WHEN 2 THEN '_kes_no' ELSE '' END ||
          '_' || lower(p_type) AS column_name FROM part""",
    "snake_headers": """
        SELECT p_partkey AS listing_id, p_size AS non_fbk_inventory, p_name AS some_other_name, p_type AS status FROM part""",
}
