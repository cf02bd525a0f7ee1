"""Landed pages rendered from ``part``.

The given tables hold no shop pages, so the registered queries render them with Spark
expressions: every part becomes a product tile, a listing entry and a product page. What a
page looks like depends on the part's own values, and the number of shops grows with the
table (one shop per 9,000 or 10,000 parts). The SQL beside each query computes the expected
rows from ``part`` directly, never from the HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf.registry.tables import spread, table
from tallyshelf.sources import crawl

SLUGS = ("audio", "power", "smart-office", "personal-care", "home-appliances", "gift-cards")


def _case(subject: str, *values: str) -> str:
    """SQL CASE by 0-based number; the last value is the default."""
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {subject} {whens} ELSE {values[-1]} END"


# --- collection pages --------------------------------------------------------------------

_LINK_TAIL = _case(
    "i % 4",
    "concat('?ean=', 500000 + p_partkey)",
    "concat('?ref=a&amp;ean=E%2B', p_partkey, '+x')",
    "'?ean='",
    "' '",
)
_IMAGE = _case(
    "CAST(p_size % 11 AS INT)",
    """concat('<img src="" data-src="//cdn.example/', p_partkey, '.jpg">')""",
    """concat('<img srcset="/img/', p_partkey, '-1.jpg 1x, /img/', p_partkey, '-2.jpg 2x">')""",
    """'<img srcset=" ">'""",
    "''",
    """concat('<img src="https://[bad/', p_partkey, '.jpg">')""",
    """concat('<img src="/img/', p_partkey, '.jpg"/>')""",
)
_PRICE_LINE = _case(
    "CAST(p_partkey % 7 AS INT)",
    "concat('<div class=\"product-desc\"><p class=\"product-price\"><span>KES ', cents, '</span> <del>KES ', cents + 500, '</del></p></div>')",
    "concat('<div class=\"product-desc\"><p class=\"product-price\"><span>KES ', cents, '</span> <del>KES ', cents + 500, '</del></p></div>')",
    "concat('<div class=\"product-desc\"><p class=\"product-price\"><span>KES ', cents, '</span> <del> </del></p></div>')",
    "'<p class=\"product-price\"><span> </span></p>'",
    "''",
    "concat('<div class=\"product-price\"><span>KES ', cents, '</span></div>')",
    "''",
)
_TILE = f"""concat(
  '<div class="item js_product site-product">',
  '<a class="link" href="', CASE WHEN p_partkey % 101 = 0 THEN '/item/' ELSE '/product/' END,
  replace(p_name, ' ', '-'), '-', p_partkey, {_LINK_TAIL}, '"',
  CASE WHEN p_size % 5 = 0 THEN ' data-name=""' ELSE concat(' data-name="', p_name, ' &amp; co"') END,
  CASE WHEN p_size % 7 = 0 THEN '' ELSE concat(' data-sku=" ', p_brand, ' "') END,
  CASE WHEN p_partkey % 7 = 3 THEN concat(' data-price="KES ', cents, '"') ELSE '' END,
  '><b> ', replace(p_name, ' ', '</b> <i>'), ' </i></a>',
  '<div class="product-picture-wrap">', {_IMAGE}, '</div>',
  '<div class="product-points"><p class="product-point"><span>-</span><span> ', p_type, ' </span></p>',
  '<p class="product-point"><span> </span></p>',
  '<p class="product-point"><span>Size ', p_size, '</span></p></div>',
  {_PRICE_LINE},
  CASE WHEN p_size % 3 = 0 THEN '<em>Out of <!-- x -->Stock</em>' ELSE '' END,
  CASE WHEN p_partkey % 7 = 4 THEN concat('<a class="js_add_to_cart btn" data-price="KES ', cents, '">Add</a>')
       WHEN p_size % 3 = 1 THEN '<a class="js_add_to_cart btn">Add</a>' ELSE '' END,
  '</div>')"""


def collection_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``site, category, page_no, url, status, content_type, html``.

    Scan 2 has a page of repeats only, scan 3 a page without tiles, scan 4 a missing page
    (page 10 each), scan 5 starts with a page without tiles, scan 6 has no pager.
    """
    part = table(spark, sf_dir, "part").selectExpr(
        "*",
        "CAST(p_partkey div 9000 AS INT) AS site_no",
        "CAST((p_partkey % 9000) % 6 AS INT) AS r",
        "CAST((p_partkey % 9000) div 6 AS INT) AS i",
        "CAST(round(p_retailprice * 100) AS BIGINT) AS cents",
    )
    part = part.withColumn("page_no", F.expr("CAST(i div 24 + 1 AS INT)"))
    extent = part.groupBy("site_no", "r").agg(F.max("page_no").alias("n_pages"))
    hidden = "(r IN (1, 2) AND page_no = 10) OR (r = 4 AND page_no = 1)"
    own = f"array(struct(page_no AS shown_on, 0 AS copy, NOT ({hidden}) AS visible))"
    again = f"IF(p_partkey % 17 = 0, array(struct(page_no AS shown_on, 1 AS copy, NOT ({hidden}) AS visible)), array())"
    after = "IF((i % 24 = 23 AND NOT (r = 2 AND page_no = 9)) OR (r = 1 AND page_no = 9), array(struct(page_no + 1 AS shown_on, 2 AS copy, true AS visible)), array())"
    shown = part.select("*", F.expr(f"concat({own}, {again}, {after})").alias("spots"))
    shown = shown.select("*", F.explode("spots").alias("spot"))
    tiles = shown.select(
        "site_no",
        "r",
        F.col("spot.shown_on").alias("page_no"),
        F.struct("spot.copy", "i", F.expr(f"IF(spot.visible, {_TILE}, '')").alias("tile")).alias("t"),
    )
    # A page holds at most about fifty tiles.
    pages = tiles.groupBy("site_no", "r", "page_no").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    pages = pages.join(extent, ["site_no", "r"])
    slug = "element_at(array({}), r + 1)".format(", ".join(f"'{s}'" for s in SLUGS))
    pager = """CASE WHEN r IN (0, 2, 3) THEN concat('<p>Total <b>', n_pages, '</b>\n Pages</p>')
                    WHEN r IN (1, 4) THEN concat('<a href="?page=2">2</a> <a href="?page=', n_pages, '&amp;v=1">last</a>')
                    ELSE '' END"""
    html = f"""CASE WHEN r = 3 AND page_no = 10 THEN '' ELSE concat(
        '<!DOCTYPE html><html><head><title>Shop</title><script>if (1 < 2) document.write("<p>")</script></head><body>',
        {pager}, '<div id="grid">', array_join(transform(ts, t -> t.tile), '\n'), '</div></body></html>') END"""
    return pages.selectExpr(
        "concat('https://shop', site_no, '.example') AS site",
        f"{slug} AS category",
        "page_no",
        f"concat('https://shop', site_no, '.example/collections/', {slug}, '?page=', page_no) AS url",
        "200 AS status",
        "'text/html; charset=utf-8' AS content_type",
        f"{html} AS html",
    ).filter("NOT (html = '' AND site LIKE '%0.example')")


def category_seeds(spark: SparkSession) -> DataFrame:
    return crawl.category_seeds(spark, SLUGS)


# SQL over ``part``: tiles as shown on pages (scan_rows), then what a page-by-page scan keeps
# (kept). Names match the record columns.
_TILES = """
p0 AS (
  SELECT *, CAST(p_partkey // 9000 AS INTEGER) AS site_no, CAST((p_partkey % 9000) % 6 AS INTEGER) AS r,
         CAST((p_partkey % 9000) // 6 AS INTEGER) AS i, CAST(round(p_retailprice * 100) AS BIGINT) AS cents
  FROM part),
p1 AS (SELECT *, CAST(i // 24 + 1 AS INTEGER) AS own_page FROM p0),
extent AS (SELECT site_no, r, max(own_page) AS n_pages FROM p1 GROUP BY ALL),
spots AS (
  SELECT *, own_page AS page_no FROM p1 WHERE NOT ((r IN (1, 2) AND own_page = 10) OR (r = 4 AND own_page = 1))
  UNION ALL
  SELECT *, own_page AS page_no FROM p1
  WHERE p_partkey % 17 = 0 AND NOT ((r IN (1, 2) AND own_page = 10) OR (r = 4 AND own_page = 1))
  UNION ALL
  SELECT *, own_page + 1 AS page_no FROM p1 WHERE (i % 24 = 23 AND NOT (r = 2 AND own_page = 9)) OR (r = 1 AND own_page = 9)),
scan_rows AS (
  SELECT site_no, r, page_no, p_partkey,
    'https://shop' || site_no || '.example/product/' || replace(p_name, ' ', '-') || '-' || p_partkey ||
      CASE i % 4 WHEN 0 THEN '?ean=' || (500000 + p_partkey) WHEN 1 THEN '?ref=a&ean=E%2B' || p_partkey || '+x'
                 WHEN 2 THEN '?ean=' ELSE '' END AS product_url,
    CASE WHEN p_size % 5 = 0 THEN replace(p_name, ' ', '') ELSE p_name || ' & co' END AS title,
    p_type || ', Size ' || p_size AS short_description,
    CASE WHEN p_partkey % 7 = 6 THEN '' ELSE 'KES ' || cents END AS price_now,
    CASE WHEN p_partkey % 7 IN (0, 1) THEN 'KES ' || (cents + 500) ELSE '' END AS price_was,
    'KES' AS currency,
    CASE p_size % 11 WHEN 0 THEN 'https://cdn.example/' || p_partkey || '.jpg'
      WHEN 1 THEN 'https://shop' || site_no || '.example/img/' || p_partkey || '-1.jpg'
      WHEN 3 THEN '' ELSE 'https://shop' || site_no || '.example/img/' || p_partkey || '.jpg' END AS main_image_url,
    CASE i % 4 WHEN 0 THEN CAST(500000 + p_partkey AS VARCHAR) WHEN 1 THEN 'E+' || p_partkey || ' x' ELSE '' END AS ean,
    CASE WHEN p_size % 7 = 0 THEN '' ELSE p_brand END AS model,
    CASE WHEN p_size % 3 = 0 THEN 'OutOfStock' WHEN p_partkey % 7 = 4 OR p_size % 3 = 1 THEN 'InStock'
         ELSE 'Unknown' END AS stock_status,
    replace(p_name, ' ', '-') || '-' || p_partkey AS slug
  FROM spots
  WHERE p_partkey % 101 <> 0 AND p_size % 11 NOT IN (2, 4) AND NOT (r = 3 AND page_no = 10)),
limits AS (
  SELECT site_no, r, CASE WHEN r = 5 THEN 1 ELSE least(n_pages, {cap}) END AS last_page FROM extent),
first_seen AS (SELECT site_no, r, product_url, min(page_no) AS first_page FROM scan_rows WHERE page_no <= {cap} GROUP BY ALL),
wanted AS (SELECT site_no, r, last_page, unnest(generate_series(2, last_page)) AS page_no FROM limits),
stops AS (
  SELECT l.site_no, l.r, l.last_page, coalesce(min(w.page_no), l.last_page + 1) AS stop_page
  FROM limits l LEFT JOIN (
    SELECT * FROM wanted w WHERE NOT EXISTS (
      SELECT 1 FROM first_seen f WHERE f.site_no = w.site_no AND f.r = w.r AND f.first_page = w.page_no)) w
    ON w.site_no = l.site_no AND w.r = l.r
  GROUP BY l.site_no, l.r, l.last_page),
kept AS (
  SELECT s.* FROM scan_rows s JOIN first_seen f USING (site_no, r, product_url) JOIN stops x USING (site_no, r)
  WHERE s.page_no = f.first_page AND s.page_no < x.stop_page)
"""


def tiles_sql(cap: int = 1_000_000) -> str:
    """``scan_rows`` and ``kept`` of scans of up to ``cap`` pages."""
    return _TILES.replace("{cap}", str(cap))


TILES_SQL = tiles_sql()
CATEGORY_SQL = (
    "CASE r WHEN 0 THEN 'Audio' WHEN 1 THEN 'Power' WHEN 2 THEN 'Smart Office' WHEN 3 THEN 'Personal Care' "
    "WHEN 4 THEN 'Home Appliances' ELSE 'Gift Cards' END"
)
SLUG_SQL = (
    "CASE r WHEN 0 THEN 'audio' WHEN 1 THEN 'power' WHEN 2 THEN 'smart-office' WHEN 3 THEN 'personal-care' "
    "WHEN 4 THEN 'home-appliances' ELSE 'gift-cards' END"
)
SITE_SQL = "'https://shop' || site_no || '.example'"


# --- brand listings ----------------------------------------------------------------------

_HREF = _case(
    "CAST(p_size % 4 AS INT)",
    "concat(site, '/product/', slug, '/?ref=x#top')",
    "concat('/product/', slug, '/')",
    "concat('../../product/./', slug, '/')",
    "concat('/product/', slug, '/?add-to-cart=', p_partkey)",
)
_PRICE_BOX = _case(
    "CAST(p_size % 5 AS INT)",
    "concat('<span class=\"price\"><del><bdi>KSh ', cents + 500, '</bdi></del> <ins><bdi>KSh ', cents, '</bdi></ins></span>')",
    "concat('<span class=\"price\"><bdi>KSh ', cents, '</bdi> to <bdi>KSh&nbsp;', cents + 900, '</bdi></span>')",
    "concat('<span class=\"price\"><bdi><i>KSh</i> ', cents, '</bdi></span>')",
    "concat('<p class=\"price\"><bdi>KSh ', cents, '</bdi> / <bdi>KSh ', cents, '</bdi></p>')",
    "concat('<span class=\"price\"><span class=\"screen-reader-text\">Price was</span><bdi>KSh ', cents, '</bdi></span>')",
)


def _listed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part under its brand, and every tenth size under the next brand as well."""
    part = table(spark, sf_dir, "part").selectExpr(
        "*",
        "CAST(p_partkey div 10000 AS INT) AS site_no",
        "CAST((p_partkey % 10000) div 400 + 1 AS INT) AS page_no",
        "CAST(substring(p_brand, 7) AS INT) AS own",
        "concat(replace(p_name, ' ', '-'), '-', p_partkey) AS slug",
        "CAST(round(p_retailprice * 100) AS BIGINT) AS cents",
        "concat('https://phones', p_partkey div 10000, '.example') AS site",
    )
    return part.select("*", F.expr("explode(IF(p_size % 10 = 0, array(own, own % 25 + 1), array(own)))").alias("b"))


def brand_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``site, brand_rank, brand, start_url``: 25 brands per shop, one shop per 10,000 parts."""
    sites = table(spark, sf_dir, "part").selectExpr("CAST(p_partkey div 10000 AS INT) AS site_no").distinct()
    return sites.select("site_no", F.explode(F.sequence(F.lit(1), F.lit(25))).alias("brand_rank")).selectExpr(
        "concat('https://phones', site_no, '.example') AS site",
        "brand_rank",
        "concat('Brand#', brand_rank) AS brand",
        "concat('https://phones', site_no, '.example/category/brand-', brand_rank, '/') AS start_url",
    )


def brand_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``site, brand, page_no, url, html`` in several page layouts by brand number."""
    listed = _listed_parts(spark, sf_dir)
    extent = listed.groupBy("site_no").agg(F.max("page_no").alias("n_pages"))
    # Brand 9 shows page 2 again instead of page 3.
    spots = "IF(b = 9, CASE page_no WHEN 2 THEN array(2, 3) WHEN 3 THEN array() ELSE array(page_no) END, array(page_no))"
    listed = listed.select("*", F.expr(f"explode({spots})").alias("shown_on"))
    price = f"""CASE WHEN b <> own THEN concat('<span class="price"><bdi>ALT ', cents, '</bdi></span>')
                     WHEN p_type = 'ECONOMY' AND b % 5 <> 0 THEN ''
                     ELSE {_PRICE_BOX} END"""
    link = f"concat('<a href=\"', {_HREF}, '\">', p_name, '</a>')"
    entry = f"IF(b % 5 = 0, concat('<div class=\"card\">', {link}, {price}, '</div>'), concat('<li>', {link}, {price}, '</li>'))"
    pages = (
        listed.select("site_no", "site", "b", "shown_on", F.struct("p_partkey", F.expr(entry).alias("entry")).alias("e"))
        .groupBy("site_no", "site", "b", F.col("shown_on").alias("page_no"))
        .agg(F.array_sort(F.collect_list("e")).alias("es"))
        .join(extent, "site_no")
    )
    pages = pages.filter("NOT (b = 7 AND page_no = 4)")
    entries = "array_join(transform(es, e -> e.entry), '')"
    grid = f"""IF(b % 5 = 0,
      concat('<div class="grid">', {entries}, '<a href="/product/add-to-cart/1">x</a></div>'),
      concat('<ul class="products">', {entries}, '<li><a href="/shop/?u=/product/none">x</a></li></ul>'))"""
    side = "IF(b = 11, '<aside><ul class=\"products\"><li><a href=\"/product/widget/\">w</a></li></ul></aside>', '')"
    onward = "page_no < n_pages"
    pager = f"""CASE WHEN NOT ({onward}) OR b % 10 = 3 THEN ''
      WHEN b % 10 = 2 THEN concat('<nav><a class="next page-numbers" href="page/', page_no + 1, '/">next</a></nav>')
      ELSE concat('<p><a class="page-numbers next" href="page/', page_no + 1, '/">next</a></p>') END"""
    head = f"IF({onward} AND b % 10 = 3, concat('<link rel=\"next\" href=\"page/', page_no + 1, '/\">'), '')"
    html = f"""IF(b = 8 AND page_no = 4, '', concat('<html><head>', {head}, '</head><body><header><a href="/product/top/">t</a></header><main>',
      {side}, {grid}, {pager}, '</main></body></html>'))"""
    return pages.selectExpr(
        "site",
        "concat('Brand#', b) AS brand",
        "page_no",
        "concat(site, '/category/brand-', b, '/page/', page_no, '/') AS url",
        f"{html} AS html",
    )


LISTING_SQL = """
p0 AS (
  SELECT *, CAST(p_partkey // 10000 AS INTEGER) AS site_no, CAST((p_partkey % 10000) // 400 + 1 AS INTEGER) AS own_page,
         CAST(substring(p_brand, 7) AS INTEGER) AS own, CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
         'https://phones' || (p_partkey // 10000) || '.example/product/' || replace(p_name, ' ', '-') || '-' || p_partkey || '/' AS url
  FROM part),
listed AS (
  SELECT *, own AS b FROM p0 UNION ALL SELECT *, own % 25 + 1 AS b FROM p0 WHERE p_size % 10 = 0),
extent AS (SELECT site_no, max(own_page) AS n_pages FROM listed GROUP BY ALL),
shown AS (
  SELECT *, own_page AS page_no FROM listed WHERE NOT (b = 9 AND own_page = 3)
  UNION ALL SELECT *, 3 AS page_no FROM listed WHERE b = 9 AND own_page = 2),
listing_pages AS (SELECT DISTINCT site_no, b, page_no FROM shown WHERE NOT (b IN (7, 8) AND page_no = 4)),
links AS (
  SELECT site_no, b, page_no, p_partkey, url,
    CASE WHEN b <> own THEN 'ALT ' || cents
         WHEN p_type = 'ECONOMY' AND b % 5 <> 0 THEN ''
         ELSE CASE p_size % 5 WHEN 0 THEN 'KSh ' || (cents + 500) || ' -> KSh ' || cents
           WHEN 1 THEN 'KSh ' || cents || ' - KSh ' || (cents + 900)
           WHEN 3 THEN 'KSh ' || cents || ' / KSh ' || cents
           ELSE 'KSh ' || cents END END AS price_raw
  FROM shown WHERE NOT (b IN (7, 8) AND page_no = 4)),
first_seen AS (
  SELECT site_no, b, url, min(page_no) AS first_page, arg_min(price_raw, page_no) AS price_raw FROM links GROUP BY ALL),
ends AS (
  SELECT s.site_no, s.b, n AS page_no FROM (SELECT DISTINCT site_no, b FROM listing_pages) s, generate_series(1, 400) g(n)
  WHERE NOT EXISTS (SELECT 1 FROM listing_pages l WHERE l.site_no = s.site_no AND l.b = s.b AND l.page_no = n)
     OR (n > 1 AND NOT EXISTS (SELECT 1 FROM first_seen f WHERE f.site_no = s.site_no AND f.b = s.b AND f.first_page = n))
  UNION ALL
  SELECT l.site_no, l.b, l.page_no + 1 FROM listing_pages l JOIN extent e USING (site_no)
  WHERE l.page_no >= e.n_pages OR l.b % 10 = 2),
brand_stops AS (SELECT site_no, b, min(page_no) AS stop_page FROM ends GROUP BY ALL),
found AS (
  SELECT f.* FROM first_seen f JOIN brand_stops x USING (site_no, b) WHERE f.first_page < x.stop_page),
owned AS (
  SELECT url, min(b) AS b, arg_min(price_raw, b) AS price_raw FROM found GROUP BY ALL)
"""


# --- product pages -----------------------------------------------------------------------

_FEATURES = _case(
    "CAST(p_size % 4 AS INT)",
    "concat('<p><b>KEY features</b></p><ul><li>Size: ', p_size, '</li><li> </li><li>Type ', p_type, '</li></ul>')",
    "concat('<ul><li>a</li><li>b</li><li>c</li></ul><ul><li>Size: ', p_size, '</li><li>Type:<br> ', p_type, '</li><li>plain</li></ul>')",
    "''",
    "'<ul><li>x: 1</li><li>y: 2</li></ul>'",
)
_VARIATIONS = _case(
    "CAST(p_size % 5 AS INT)",
    "concat(' data-product_variations=\"[{&quot;sku&quot;:&quot;', p_partkey, '&quot;,&quot;price&quot;:', cents, '}]\"')",
    "' data-product_variations=\"false\"'",
    "' data-product_variations=\"{oops\"'",
    "''",
)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html``; parts of size 13 have no page and parts of size 26 an empty one.

    The narrow rows are dealt to all cores: a file of parts is small, but the pages made from it are not.
    """
    part = spread(spark, sf_dir, "part").selectExpr(
        "*",
        "CAST(round(p_retailprice * 100) AS BIGINT) AS cents",
        "concat('https://phones', p_partkey div 10000, '.example/product/', replace(p_name, ' ', '-'), '-', p_partkey, '/') AS url",
    )
    crumb = """CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN '<nav class="woocommerce-breadcrumb">Home / Other</nav>'
      ELSE concat('<nav class="woocommerce-breadcrumb"><a>Home</a> /  ', upper(p_brand), '</nav>') END"""
    form = f"""IF(p_size % 5 = 4, '', concat('<form class="cart variations_form"', {_VARIATIONS},
      '><select name=" attribute_color "><option value="">Choose an option</option><option>Red</option><option>Blue ',
      p_size, '</option></select><select><option>lost</option></select></form>'))"""
    about = """IF(p_size % 2 = 0, concat('<div id="tab-description"><h2>Details</h2><p>About ', p_name, '.</div>'),
      concat('<div class="woocommerce-product-details__short-description">Brief\n on  ', p_name, '</div>'))"""
    stock = "CASE p_size % 3 WHEN 0 THEN '<p>Sold <b>Out</b></p>' WHEN 1 THEN '<p>12 In&nbsp;Stock: In Stock</p>' ELSE '<p>instock</p>' END"
    html = f"""IF(p_size = 26, '', concat('<html><body>', {crumb}, '<h1 class="product_title"> ', p_name, '&nbsp; &amp; more </h1>',
      '<p class="price"><bdi>KSh page ', cents, '</bdi></p>', {stock}, {_FEATURES}, {about}, {form}, '</body></html>'))"""
    return part.filter("p_size <> 13").selectExpr("url", f"{html} AS html")


PRODUCTS_SQL = """
facts AS (
  SELECT url, p_brand, p_size,
    p_name || ' & more' AS name,
    CASE p_size % 6 WHEN 0 THEN '' WHEN 1 THEN 'Home / Other' ELSE 'Home / ' || upper(p_brand) END AS breadcrumb,
    'KSh page ' || cents AS page_price,
    CASE p_size % 3 WHEN 0 THEN false WHEN 1 THEN true END AS in_stock,
    CASE p_size % 4 WHEN 0 THEN '["Size: ' || p_size || '","Type ' || p_type || '"]'
      WHEN 1 THEN '["Size: ' || p_size || '","Type: ' || p_type || '","plain"]' ELSE '[]' END AS specs_json,
    CASE WHEN p_size % 2 = 0 THEN 'Details About ' || p_name || '.' ELSE 'Brief on ' || p_name END AS description,
    '{"variations": ' || CASE p_size % 5 WHEN 0 THEN '[{"price":' || cents || ',"sku":"' || p_partkey || '"}]'
      WHEN 1 THEN 'false' ELSE '[]' END || ', "options": ' ||
      CASE WHEN p_size % 5 = 4 THEN '{}' ELSE '{"attribute_color":["Red","Blue ' || p_size || '"]}' END || '}' AS variants_json
  FROM p0 WHERE p_size NOT IN (13, 26))
"""
