"""Registered queries over brand listings and product pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf.operators import metrics, page_order, products
from tallyshelf.plans import phones
from tallyshelf.registry import rendered_pages as rp
from tallyshelf.registry.tables import RUN_TS, table
from tallyshelf.sources import crawl
from tallyshelf.sources.page_facts import product_facts

KEYS = ("site", "brand")


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return phones.listing_links(rp.brand_pages(spark, sf), rp.brand_seeds(spark, sf), KEYS)


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return phones.brand_product_urls(rp.brand_pages(spark, sf), rp.brand_seeds(spark, sf), KEYS)


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    pages = rp.product_pages(spark, sf).filter(crawl.page_present(F.col("html")))
    return pages.select("url", product_facts(F.col("html")).alias("f"))


def phone_snapshot(spark, sf):
    return phones.phone_snapshot(_found(spark, sf), rp.product_pages(spark, sf), RUN_TS)


def phone_snapshot_unfiltered(spark, sf):
    """The same run with the brand filter switched off."""
    return phones.phone_snapshot(_found(spark, sf), rp.product_pages(spark, sf), RUN_TS, filter_leaks=False).select(
        "brand", "product_url", "scrape_error", "in_stock"
    )


def brand_product_urls(spark, sf):
    return _found(spark, sf).select(
        "site", "brand", F.col("brand_rank").cast("bigint"), "url", "price_raw", F.col("first_page").cast("bigint")
    )


def listing_links(spark, sf):
    rows = _links(spark, sf).filter("url IS NOT NULL")
    return rows.select("site", "brand", F.col("page_no").cast("bigint"), "url", "price_raw")


def next_links(spark, sf):
    return _links(spark, sf).select("site", "brand", F.col("page_no").cast("bigint"), "next_url").distinct()


def listing_chain(spark, sf):
    """Page numbers rebuilt from next links alone."""
    seeds = rp.brand_seeds(spark, sf)
    pages = _links(spark, sf).select(*KEYS, "page_no", "next_url").distinct().join(seeds, list(KEYS))
    own = F.when(F.col("page_no") == 1, F.col("start_url")).otherwise(
        F.concat("start_url", F.lit("page/"), "page_no", F.lit("/"))
    )
    pages = pages.select(*KEYS, own.alias("url"), "next_url")
    return page_order.numbered_chain(pages, seeds, KEYS).select(
        "site", "brand", F.col("page_no").cast("bigint"), "url"
    )


def brand_stops(spark, sf):
    _, stops = phones.scan_urls(_links(spark, sf), KEYS)
    return stops.select("site", "brand", F.col("stop_page").cast("bigint"))


def global_first_wins(spark, sf):
    owned = page_order.owned_urls(_found(spark, sf), "brand_rank", ["brand", "price_raw"])
    return owned.select("url", "brand", "price_raw")


def brand_first_wins(spark, sf):
    """Ship mode as brand, line number as page: first page and position of every part."""
    links = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("brand"),
        F.col("l_linenumber").alias("page_no"),
        F.col("l_orderkey").alias("pos"),
        F.concat(F.lit("/product/"), "l_partkey").alias("url"),
        F.col("l_extendedprice").alias("price"),
    )
    return page_order.first_links(links, ["brand"], ["price"]).select(
        "brand", "url", F.col("first_page").cast("bigint"), "pos", "price"
    )


def error_rows(spark, sf):
    parts = table(spark, sf, "part").selectExpr(
        "concat('https://phones', p_partkey div 10000, '.example/product/', replace(p_name, ' ', '-'), '-', p_partkey, '/') AS url",
        "p_brand AS brand",
        "concat('KES ', p_size) AS price_raw",
    )
    records = phones.product_records(parts, rp.product_pages(spark, sf), filter_leaks=False)
    return records.select("product_url", "name", "price_raw", "in_stock", "specs_json", "variants_json", "scrape_error")


def error_tally(spark, sf):
    snapshot = phones.phone_snapshot(_found(spark, sf), rp.product_pages(spark, sf), RUN_TS)
    return metrics.error_tally(snapshot)


def leakage_filter(spark, sf):
    parts = table(spark, sf, "part")
    crumb = F.when(F.col("p_size") % 4 == 0, "").otherwise(F.concat(F.lit("Home / "), F.upper("p_name")))
    parts = parts.withColumn("crumb", crumb).withColumn("word", F.initcap(F.split("p_name", " ")[0]))
    wanted = F.when(F.col("p_type") == "PROMO", F.lit("Blue")).otherwise(F.col("word"))
    return parts.filter(products.names_brand(F.col("crumb"), wanted)).select("p_partkey", "crumb")


def product_names(spark, sf):
    return _facts(spark, sf).select("url", F.col("f.name").alias("name"), F.col("f.breadcrumb").alias("breadcrumb"))


def stock_tristate(spark, sf):
    f = F.col("f")
    return _facts(spark, sf).select(
        "url", products.stock_state(f["says_gone"], f["says_in_stock"]).alias("in_stock")
    )


def feature_list(spark, sf):
    f = F.col("f")
    return _facts(spark, sf).select(
        "url", F.to_json(products.feature_list(f["key_items"], f["lists"])).alias("specs_json")
    )


def product_descriptions(spark, sf):
    f = F.col("f")
    return _facts(spark, sf).select("url", products.description(f["tab_text"], f["short_text"]).alias("description"))


def variants_json(spark, sf):
    f = F.col("f")
    made = products.variants_json(f["variations"], f["options"])
    rows = _facts(spark, sf).select("url", made.alias("variants_json"))
    v = F.try_parse_json("variants_json")
    return rows.select(
        "url",
        "variants_json",
        F.try_variant_get(v, "$.variations[0].sku", "string").alias("first_sku"),
        F.try_variant_get(v, "$.options.attribute_color[1]", "string").alias("second_colour"),
    )


def variant_texts(spark, sf):
    """Texts behind a value, several values, and keys that come twice."""
    raw = F.expr(
        """CASE p_size % 5 WHEN 0 THEN concat('[{"a":1,"a":', p_size, '}]') WHEN 1 THEN concat('[', p_size, '] x')
             WHEN 2 THEN '1,2' WHEN 3 THEN concat(' {"k": "', p_type, '"} ') ELSE concat('[{&quot;n&quot;:', p_size, '}]') END"""
    )
    none = F.lit(None).cast("map<string,array<string>>")
    return table(spark, sf, "part").select("p_partkey", products.variants_json(raw, none).alias("variants_json"))


def variation_rows(spark, sf):
    """Variations of every part, read with their types: two or one a part, some no list, some with odd fields."""
    raw = F.expr(
        """CASE p_size % 6
             WHEN 0 THEN concat('[{"sku":"A', p_partkey, '","display_price":', p_size, '.5,"display_regular_price":', p_size + 1,
               ',"is_in_stock":true,"attributes":{"attribute_color":"', p_type, '","attribute_size":"', p_size, '"}},',
               '{"sku":', p_partkey, ',"price":"', p_size, '.25","is_in_stock":false,"attributes":{"attribute_color":null}}]')
             WHEN 1 THEN 'false'
             WHEN 2 THEN concat('[{&quot;sku&quot;:&quot;B', p_partkey, '&quot;,&quot;display_price&quot;:&quot;on request&quot;}]')
             WHEN 3 THEN concat('{"sku":"C', p_partkey, '"}')
             WHEN 4 THEN concat('[', p_size, ',null,{"attributes":[],"price":', p_size, '}]')
             ELSE '{oops' END"""
    )
    none = F.lit(None).cast("map<string,array<string>>")
    records = table(spark, sf, "part").select("p_partkey", products.variants_json(raw, none).alias("variants_json"))
    rows = products.variation_rows(records, ["p_partkey"])
    return rows.select(
        "p_partkey", "pos", "sku", "price", "regular_price", "in_stock",
        F.col("options")["attribute_color"].alias("colour"), F.col("options")["attribute_size"].alias("size"),
    )


def page_variations(spark, sf):
    """Variations of the product pages, price by price."""
    f = F.col("f")
    records = _facts(spark, sf).select("url", products.variants_json(f["variations"], f["options"]).alias("variants_json"))
    return products.variation_rows(records, ["url"]).select("url", "pos", "sku", "price")


def capped_brand_urls(spark, sf):
    """Brand scans that stop after two pages."""
    found = phones.brand_product_urls(rp.brand_pages(spark, sf), rp.brand_seeds(spark, sf), KEYS, cap=2)
    return found.select("site", "brand", "url", "price_raw", F.col("first_page").cast("bigint"))


def brand_urls_by_links(spark, sf):
    """The URLs found when pages, landed twice and without numbers, are followed by their links."""
    seeds = rp.brand_seeds(spark, sf)
    pages = rp.brand_pages(spark, sf).join(seeds.select(*KEYS, "start_url"), list(KEYS))
    own = F.when(F.col("page_no") == 1, F.col("start_url")).otherwise(
        F.concat("start_url", F.lit("page/"), "page_no", F.lit("/"))
    )
    pages = pages.select(*KEYS, own.alias("url"), "html")
    found = phones.brand_urls_by_links(pages.unionByName(pages), seeds, KEYS)
    return found.select(
        "site", "brand", F.col("brand_rank").cast("bigint"), "url", "price_raw", F.col("first_page").cast("bigint")
    )


def repeated_product_pages(spark, sf):
    """Product pages landed twice give one record each."""
    pages = rp.product_pages(spark, sf)
    snapshot = phones.phone_snapshot(_found(spark, sf), pages.unionByName(pages), RUN_TS)
    return snapshot.select("brand", "product_url", "scrape_error", "in_stock")


def chain_of_repeated_pages(spark, sf):
    """Page numbers from next links where every page was landed twice and the last one links back."""
    part = table(spark, sf, "part")
    pages = part.selectExpr(
        "concat('b', p_size) AS brand", "concat('/', p_partkey) AS url", "p_partkey",
        "concat('/', coalesce(lead(p_partkey) OVER (PARTITION BY p_size ORDER BY p_partkey), min(p_partkey) OVER (PARTITION BY p_size))) AS next_url",
    )
    seeds = pages.groupBy("brand").agg(F.min_by("url", "p_partkey").alias("start_url"))
    links = pages.select("brand", "url", "next_url")
    found = page_order.numbered_chain(links.unionByName(links), seeds, ["brand"])
    return found.select("brand", F.col("page_no").cast("bigint"), "url")


def page_prices(spark, sf):
    return _facts(spark, sf).select("url", products.price_text(F.col("f.price")).alias("price_raw"))


QUERIES = {
    "phone_snapshot": phone_snapshot,
    "phone_snapshot_unfiltered": phone_snapshot_unfiltered,
    "brand_product_urls": brand_product_urls,
    "listing_links": listing_links,
    "next_links": next_links,
    "listing_chain": listing_chain,
    "brand_stops": brand_stops,
    "brand_first_wins": brand_first_wins,
    "global_first_wins": global_first_wins,
    "error_rows": error_rows,
    "error_tally": error_tally,
    "leakage_filter": leakage_filter,
    "product_names": product_names,
    "stock_tristate": stock_tristate,
    "feature_list": feature_list,
    "product_descriptions": product_descriptions,
    "variants_json": variants_json,
    "variant_texts": variant_texts,
    "variation_rows": variation_rows,
    "page_variations": page_variations,
    "capped_brand_urls": capped_brand_urls,
    "brand_urls_by_links": brand_urls_by_links,
    "repeated_product_pages": repeated_product_pages,
    "chain_of_repeated_pages": chain_of_repeated_pages,
    "page_prices": page_prices,
}

_SITE = "'https://phones' || site_no || '.example'"
_KEYS = f"{_SITE} AS site, 'Brand#' || b AS brand"
_EMPTY_VARIANTS = """'{"variations": [], "options": {}}'"""
_SNAPSHOT = f"""
snapshot AS (
  SELECT TIMESTAMP '{RUN_TS}' AS ts, 'Brand#' || o.b AS brand, o.url AS product_url,
    coalesce(f.name, '') AS name,
    CASE WHEN o.price_raw <> '' THEN o.price_raw ELSE coalesce(f.page_price, '') END AS price_raw,
    f.in_stock AS in_stock, coalesce(f.specs_json, '[]') AS specs_json, coalesce(f.description, '') AS description,
    coalesce(f.variants_json, {_EMPTY_VARIANTS}) AS variants_json,
    CASE WHEN f.url IS NULL THEN 'fetch_failed' ELSE '' END AS scrape_error,
    f.url IS NOT NULL AND f.breadcrumb <> '' AND NOT contains(lower(f.breadcrumb), lower('Brand#' || o.b)) AS leaked
  FROM owned o LEFT JOIN facts f ON f.url = o.url)
"""
_LISTED = rp.LISTING_SQL
_ALL = f"{rp.LISTING_SQL}, {rp.PRODUCTS_SQL}, {_SNAPSHOT}"
_FACTS = f"{rp.LISTING_SQL}, {rp.PRODUCTS_SQL}"

SQL = {
    "phone_snapshot": f"""WITH {_ALL}
        SELECT ts, brand, product_url, name, price_raw, in_stock, specs_json, description, variants_json, scrape_error
        FROM snapshot WHERE NOT leaked""",
    "phone_snapshot_unfiltered": f"WITH {_ALL} SELECT brand, product_url, scrape_error, in_stock FROM snapshot",
    "brand_product_urls": f"""WITH {_LISTED}
        SELECT {_KEYS}, CAST(b AS BIGINT) AS brand_rank, url, price_raw, CAST(first_page AS BIGINT) AS first_page FROM found""",
    "listing_links": f"""WITH {_LISTED}
        SELECT {_KEYS}, CAST(page_no AS BIGINT) AS page_no, url, price_raw FROM links""",
    "next_links": f"""WITH {_LISTED}
        SELECT {_KEYS}, CAST(page_no AS BIGINT) AS page_no,
          CASE WHEN page_no < n_pages AND b % 10 <> 2
               THEN {_SITE} || '/category/brand-' || b || '/page/' || (page_no + 1) || '/' END AS next_url
        FROM listing_pages JOIN extent USING (site_no)""",
    "listing_chain": f"""WITH RECURSIVE {_LISTED},
        hops AS (
          SELECT site_no, b, page_no, page_no < n_pages AND b % 10 <> 2 AS onward
          FROM listing_pages JOIN extent USING (site_no)),
        chain AS (
          SELECT site_no, CAST(b AS INTEGER) AS b, 1 AS page_no
          FROM (SELECT DISTINCT site_no FROM p0), generate_series(1, 25) g(b)
          UNION ALL
          SELECT c.site_no, c.b, c.page_no + 1 FROM chain c JOIN hops h
            ON h.site_no = c.site_no AND h.b = c.b AND h.page_no = c.page_no WHERE h.onward AND c.page_no < 400)
        SELECT {_KEYS}, CAST(page_no AS BIGINT) AS page_no, {_SITE} || '/category/brand-' || b || '/' ||
          CASE WHEN page_no = 1 THEN '' ELSE 'page/' || page_no || '/' END AS url FROM chain""",
    "brand_stops": f"WITH {_LISTED} SELECT {_KEYS}, CAST(stop_page AS BIGINT) AS stop_page FROM brand_stops",
    "brand_first_wins": """
        SELECT brand, url, first_page, pos, price FROM (
          SELECT l_returnflag || l_linestatus AS brand, '/product/' || l_partkey AS url,
            CAST(l_linenumber AS BIGINT) AS first_page, l_orderkey AS pos, l_extendedprice AS price,
            row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_partkey
                               ORDER BY l_linenumber, l_orderkey, l_extendedprice) AS rn
          FROM lineitem) WHERE rn = 1""",
    "global_first_wins": f"WITH {_LISTED} SELECT url, 'Brand#' || b AS brand, price_raw FROM owned",
    "error_rows": f"""WITH {_FACTS}
        SELECT p0.url AS product_url, coalesce(f.name, '') AS name, 'KES ' || p0.p_size AS price_raw, f.in_stock,
          coalesce(f.specs_json, '[]') AS specs_json, coalesce(f.variants_json, {_EMPTY_VARIANTS}) AS variants_json,
          CASE WHEN f.url IS NULL THEN 'fetch_failed' ELSE '' END AS scrape_error
        FROM p0 LEFT JOIN facts f ON f.url = p0.url""",
    "error_tally": f"""WITH {_ALL}
        SELECT scrape_error, count(*) AS rows FROM snapshot WHERE NOT leaked GROUP BY ALL""",
    "leakage_filter": """
        SELECT p_partkey, crumb FROM (
          SELECT *, CASE WHEN p_size % 4 = 0 THEN '' ELSE 'Home / ' || upper(p_name) END AS crumb,
            CASE WHEN p_type = 'PROMO' THEN 'blue' ELSE split_part(p_name, ' ', 1) END AS word FROM part)
        WHERE crumb = '' OR contains(lower(crumb), word)""",
    "product_names": f"WITH {_FACTS} SELECT url, name, breadcrumb FROM facts",
    "stock_tristate": f"WITH {_FACTS} SELECT url, in_stock FROM facts",
    "feature_list": f"WITH {_FACTS} SELECT url, specs_json FROM facts",
    "product_descriptions": f"WITH {_FACTS} SELECT url, description FROM facts",
    "variant_texts": """
        SELECT p_partkey, '{"variations": ' || CASE p_size % 5 WHEN 0 THEN '[{"a":' || p_size || '}]' WHEN 3 THEN '{"k":"' || p_type || '"}'
          WHEN 4 THEN '[{"n":' || p_size || '}]' ELSE '[]' END || ', "options": {}}' AS variants_json FROM part""",
    "variation_rows": """
        SELECT p_partkey, CAST(0 AS BIGINT) AS pos, 'A' || p_partkey AS sku, p_size + 0.5::DOUBLE AS price, CAST(p_size + 1 AS DOUBLE) AS regular_price,
          true AS in_stock, p_type AS colour, CAST(p_size AS VARCHAR) AS size FROM part WHERE p_size % 6 = 0
        UNION ALL SELECT p_partkey, 1, CAST(p_partkey AS VARCHAR), p_size + 0.25::DOUBLE, NULL, false, NULL, NULL FROM part WHERE p_size % 6 = 0
        UNION ALL SELECT p_partkey, 0, 'B' || p_partkey, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_size % 6 = 2
        UNION ALL SELECT p_partkey, 2, NULL, CAST(p_size AS DOUBLE), NULL, NULL, NULL, NULL FROM part WHERE p_size % 6 = 4""",
    "page_variations": f"""WITH {_FACTS}
        SELECT url, CAST(json_extract_string(variants_json, '$.variations[0].price') AS DOUBLE) AS price, CAST(0 AS BIGINT) AS pos,
          json_extract_string(variants_json, '$.variations[0].sku') AS sku
        FROM facts WHERE json_extract_string(variants_json, '$.variations[0].sku') IS NOT NULL""",
    "capped_brand_urls": f"""WITH {_LISTED}
        SELECT {_KEYS}, f.url, f.price_raw, CAST(f.first_page AS BIGINT) AS first_page
        FROM first_seen f JOIN brand_stops x USING (site_no, b) WHERE f.first_page < least(x.stop_page, 3)""",
    "repeated_product_pages": f"""WITH {_ALL}
        SELECT brand, product_url, scrape_error, in_stock FROM snapshot WHERE NOT leaked""",
    "chain_of_repeated_pages": """
        SELECT 'b' || p_size AS brand, row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS page_no, '/' || p_partkey AS url FROM part""",
    "variants_json": f"""WITH {_FACTS}
        SELECT url, variants_json, json_extract_string(variants_json, '$.variations[0].sku') AS first_sku,
          json_extract_string(variants_json, '$.options.attribute_color[1]') AS second_colour FROM facts""",
    "page_prices": f"WITH {_FACTS} SELECT url, page_price AS price_raw FROM facts",
}
SQL["brand_urls_by_links"] = SQL["brand_product_urls"]
