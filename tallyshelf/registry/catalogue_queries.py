"""Registered queries over collection pages, with the SQL that states their result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyshelf import session
from tallyshelf.functions import text
from tallyshelf.operators import metrics, page_order, sinks, tiles
from tallyshelf.plans import catalogue
from tallyshelf.plans.schemas import CATALOGUE
from tallyshelf.registry import rendered_pages as rp
from tallyshelf.registry.tables import RUN_TS, table
from tallyshelf.sources import crawl
from tallyshelf.streaming import landing

KEYS = ("site", "category")


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.page_tiles(rp.collection_pages(spark, sf), rp.category_seeds(spark), F.col("site"), KEYS)


def catalogue_snapshot(spark, sf):
    pages, seeds = rp.collection_pages(spark, sf), rp.category_seeds(spark)
    return catalogue.catalogue_snapshot(pages, seeds, F.col("site"), RUN_TS, KEYS)


def capped_catalogue(spark, sf):
    """The same with a limit of five pages a scan."""
    pages, seeds = rp.collection_pages(spark, sf), rp.category_seeds(spark)
    return catalogue.catalogue_snapshot(pages, seeds, F.col("site"), RUN_TS, KEYS, cap=5)


def catalogue_sheet(spark, sf):
    """Two runs of the catalogue in one text sheet, under local time, read back."""
    spot = f"{session.scratch_root(spark)}/catalogue-sheet-{uuid.uuid4().hex}"
    snapshot = session.written(catalogue_snapshot(spark, sf), "sheet-snapshot")
    for run in (RUN_TS, "2024-05-02 22:15:00"):
        rows = catalogue.sheet_rows(snapshot, run)
        sinks.append_under_header(rows, spot, rows.columns)
    stored = sinks.read_sheet(spark, spot)
    return stored.select("ts", "category", "product_url", "title", "price_now", "stock_status")


def tile_records(spark, sf):
    rows = tiles.usable(_rows(spark, sf))
    return rows.select("site", "category", "page_no", *tiles.TILE_COLUMNS)


def tile_stock_counts(spark, sf):
    rows = tiles.usable(_rows(spark, sf))
    return rows.groupBy("site", "category", "stock_status").agg(F.count("*").alias("tiles"))


def total_pages(spark, sf):
    first = _rows(spark, sf).filter("page_no = 1").select("site", "category", "total_pages").distinct()
    return first.withColumn("total_pages", F.col("total_pages").cast("bigint"))


def scan_stops(spark, sf):
    rows = _rows(spark, sf)
    firsts = page_order.first_pages(tiles.usable(rows), KEYS)
    return page_order.collection_stops(rows, firsts, KEYS).select(
        "site", "category", F.col("last_page").cast("bigint"), F.col("stop_page").cast("bigint")
    )


def page_metrics(spark, sf):
    rows = tiles.usable(_rows(spark, sf))
    found = metrics.page_metrics(rows, page_order.first_pages(rows, KEYS), KEYS)
    return found.withColumn("page_no", F.col("page_no").cast("bigint"))


def category_totals(spark, sf):
    kept = catalogue.scan_result(_rows(spark, sf), KEYS)
    named = kept.withColumn("category", text.category_label(F.col("category")))
    return metrics.counts_by(
        named,
        ["category"],
        without_price=F.col("price_now") == "",
        without_image=F.col("main_image_url") == "",
        with_ean=F.col("ean") != "",
    )


def crawl_plan(spark, sf):
    slugs = F.array(*[F.lit(s) for s in rp.SLUGS])
    seeds = (
        table(spark, sf, "part")
        .selectExpr("concat('https://shop', p_partkey div 9000, '.example') AS site")
        .distinct()
        .select("site", F.posexplode(slugs).alias("pos", "category"))
        .withColumn("rank", F.col("pos") + 1)
    )
    planned = crawl.crawl_plan(seeds, F.col("site"), 60)
    return planned.select("rank", "category", "page_no", "page_url")


def local_stamps(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"))
    ntz = F.date_trunc("second", "at").cast("timestamp_ntz")
    local = F.convert_timezone(F.lit("UTC"), F.lit("Africa/Nairobi"), ntz)
    return rows.select(
        "event_id",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_ts"),
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("utc_ts"),
        catalogue.local_stamp_text(RUN_TS).alias("run_local_ts"),
    )


def cross_page_dedupe(spark, sf):
    """Return flag as category, line number as page, part as URL; keys repeat within a page."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("category"),
        F.col("l_linenumber").alias("page_no"),
        F.concat(F.lit("/product/"), "l_partkey").alias("product_url"),
        "l_orderkey",
        "l_extendedprice",
    )
    firsts = page_order.first_pages(rows, ["category"])
    return page_order.drop_repeats(rows, firsts, ["category"]).select(
        "category", F.col("page_no").cast("bigint"), "product_url", "l_orderkey", "l_extendedprice"
    )


def prefix_stop(spark, sf):
    """Supplier as category, pages from the ship week: pages go missing, and some bring
    nothing new, at different places for each supplier."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("category"),
        F.expr("CAST(weekofyear(l_shipdate) AS INT)").alias("page_no"),
        F.concat(F.lit("/product/"), F.expr("l_partkey % 97")).alias("product_url"),
        F.col("l_linenumber").alias("line"),
        "l_orderkey",
    )
    rows = session.written(rows, "weekly-tiles")
    pages = rows.select("category", "page_no", F.expr("CAST(30 + category % 40 AS INT)").alias("total_pages"))
    pages = pages.distinct()
    firsts = page_order.first_pages(rows, ["category"])
    stops = page_order.collection_stops(pages, firsts, ["category"])
    kept = page_order.kept_tiles(rows, firsts, stops, ["category"])
    return kept.select("category", F.col("page_no").cast("bigint"), "product_url", "line", "l_orderkey")


def crawl_attempts(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "concat('https://a.example/', event_id div 3) AS url",
        "CAST(event_id % 3 + 1 AS INT) AS attempt",
        """CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 503 ELSE 200 END AS status""",
        "CASE WHEN event_type = 'view' AND value > 50 THEN 'application/json' WHEN event_type = 'click' AND value < 2 THEN NULL ELSE 'text/html; charset=utf-8' END AS content_type",
        "props AS html",
    )
    return crawl.resolve_attempts(events).select("url", "attempt", "html")


def _land_shops(spark: SparkSession, sf: str, root: str, counters: str | None = None) -> None:
    """Every shop lands as one run with a manifest, its first pages once more and late; the stream takes the runs in."""
    run = F.regexp_extract("site", r"^https://(\w+)\.", 1).alias("run_id")
    at = F.lit("2024-05-01 06:00:00").cast("timestamp")
    pages = rp.collection_pages(spark, sf).select(
        "category", "page_no", "url", "status", "content_type", "html", at.alias("landed_at"), run
    )
    late = pages.filter("page_no = 1").withColumn("landed_at", at + F.expr("INTERVAL 2 HOURS"))
    pages.unionByName(late).write.partitionBy("run_id").parquet(f"{root}/pages")
    runs = spark.read.parquet(f"{root}/pages").select(F.col("run_id").cast("string")).distinct()
    stamped = runs.select("run_id", F.lit(RUN_TS).alias("run_ts"), (at + F.expr("INTERVAL 1 HOUR")).alias("closed_at"))
    stamped.write.json(f"{root}/manifests")
    base = F.concat(F.lit("https://"), "run_id", F.lit(".example"))
    landing.catalogue_stream(spark, root, f"{root}/out", rp.category_seeds(spark), base, metrics_table=counters).awaitTermination()


def catalogue_stream(spark, sf):
    """Every shop lands as one run with a manifest; the stream turns whole runs into snapshots."""
    root = f"{session.scratch_root(spark)}/landing-{uuid.uuid4().hex}"
    _land_shops(spark, sf, root)
    found = landing.landed(spark, f"{root}/out")
    return found.select("ts", "category", "product_url", "title", "price_now", "stock_status")


def run_metrics(spark, sf):
    """Counters of a run of all shops, taken while its rows are written, read back from the metrics table."""
    stored, counters = f"counted_{uuid.uuid4().hex[:10]}", f"run_metrics_{uuid.uuid4().hex[:10]}"
    tally = metrics.Tally()
    pages, seeds = rp.collection_pages(spark, sf), rp.category_seeds(spark)
    sinks.append_snapshot(catalogue.catalogue_snapshot(pages, seeds, F.col("site"), RUN_TS, KEYS, tally=tally), stored, CATALOGUE)
    metrics.append_run(tally, spark, counters, "all shops", RUN_TS)
    return spark.table(counters).select("run", "run_ts", "step", "counter", "value")


def stream_metrics(spark, sf):
    """What the recurring runs counted, late pages among it, added up over their batches."""
    root, counters = f"{session.scratch_root(spark)}/landing-{uuid.uuid4().hex}", f"stream_metrics_{uuid.uuid4().hex[:10]}"
    _land_shops(spark, sf, root, counters)
    return spark.table(counters).groupBy("step", "counter").agg(F.sum("value").alias("value"))


QUERIES = {
    "run_metrics": run_metrics,
    "stream_metrics": stream_metrics,
    "capped_catalogue": capped_catalogue,
    "catalogue_sheet": catalogue_sheet,
    "catalogue_snapshot": catalogue_snapshot,
    "tile_records": tile_records,
    "tile_stock_counts": tile_stock_counts,
    "total_pages": total_pages,
    "scan_stops": scan_stops,
    "page_metrics": page_metrics,
    "category_totals": category_totals,
    "crawl_plan": crawl_plan,
    "local_stamps": local_stamps,
    "cross_page_dedupe": cross_page_dedupe,
    "prefix_stop": prefix_stop,
    "crawl_attempts": crawl_attempts,
    "catalogue_stream": catalogue_stream,
}

_RECORD = ", ".join(tiles.TILE_COLUMNS)
_HEAD = f"{rp.SITE_SQL} AS site, {rp.SLUG_SQL} AS category"
_COUNTED = f"""{rp.TILES_SQL},
landed_pages AS (
  SELECT DISTINCT site_no, r, page_no FROM (SELECT site_no, r, own_page AS page_no FROM p1 UNION ALL SELECT site_no, r, page_no FROM spots)
  WHERE NOT (r = 3 AND page_no = 10)),
counted AS (
  SELECT 'pages' AS step, 'rows' AS counter, count(*) AS value FROM landed_pages
  UNION ALL SELECT 'tiles', 'usable', count(*) FROM scan_rows
  UNION ALL SELECT 'new URLs', 'rows', count(*) FROM first_seen JOIN stops USING (site_no, r) WHERE first_page < stop_page
  UNION ALL SELECT 'snapshot', 'rows', count(*) FROM kept)
"""

SQL = {
    "catalogue_sheet": f"""WITH {rp.TILES_SQL}
        SELECT t.ts, {rp.CATEGORY_SQL} AS category, product_url, title, nullif(price_now, '') AS price_now, stock_status
        FROM kept, (VALUES ('2024-05-01 09:30:00'), ('2024-05-03 01:15:00')) t(ts)""",
    "capped_catalogue": f"""WITH {rp.tiles_sql(5)}
        SELECT TIMESTAMP '{RUN_TS}' AS ts, {rp.CATEGORY_SQL} AS category, {_RECORD} FROM kept""",
    "catalogue_snapshot": f"""WITH {rp.TILES_SQL}
        SELECT TIMESTAMP '{RUN_TS}' AS ts, {rp.CATEGORY_SQL} AS category, {_RECORD} FROM kept""",
    "catalogue_stream": f"""WITH {rp.TILES_SQL}
        SELECT TIMESTAMP '{RUN_TS}' AS ts, {rp.CATEGORY_SQL} AS category, product_url, title, price_now, stock_status FROM kept""",
    "tile_records": f"""WITH {rp.TILES_SQL}
        SELECT {_HEAD}, CAST(page_no AS INTEGER) AS page_no, {_RECORD} FROM scan_rows""",
    "tile_stock_counts": f"""WITH {rp.TILES_SQL}
        SELECT {_HEAD}, stock_status, count(*) AS tiles FROM scan_rows GROUP BY ALL""",
    "total_pages": f"""WITH {rp.TILES_SQL}
        SELECT {_HEAD}, CAST(CASE WHEN r = 5 THEN 1 WHEN r IN (1, 4) THEN greatest(n_pages, 2) ELSE n_pages END AS BIGINT) AS total_pages
        FROM extent""",
    "scan_stops": f"""WITH {rp.TILES_SQL}
        SELECT {_HEAD}, CAST(last_page AS BIGINT) AS last_page, CAST(stop_page AS BIGINT) AS stop_page FROM stops""",
    "run_metrics": f"""WITH {_COUNTED}
        SELECT 'all shops' AS run, TIMESTAMP '{RUN_TS}' AS run_ts, step, counter, value FROM counted""",
    "stream_metrics": f"""WITH {_COUNTED}
        SELECT step, counter, value FROM counted
        UNION ALL SELECT 'late pages', 'rows', (SELECT count(*) FROM landed_pages WHERE page_no = 1)""",
    "page_metrics": f"""WITH {rp.TILES_SQL}
        SELECT {_HEAD}, CAST(s.page_no AS BIGINT) AS page_no, count(*) AS found,
          CAST(count(DISTINCT CASE WHEN f.first_page = s.page_no THEN s.product_url END) AS BIGINT) AS new_urls
        FROM scan_rows s JOIN first_seen f USING (site_no, r, product_url) GROUP BY ALL""",
    "category_totals": f"""WITH {rp.TILES_SQL}
        SELECT {rp.CATEGORY_SQL} AS category, count(*) AS rows, count(*) FILTER (price_now = '') AS without_price,
          count(*) FILTER (main_image_url = '') AS without_image, count(*) FILTER (ean <> '') AS with_ean
        FROM kept GROUP BY ALL""",
    "crawl_plan": """
        SELECT CAST(s.rank AS INTEGER) AS rank, s.category, CAST(g.n AS INTEGER) AS page_no,
          'https://shop' || x.site_no || '.example/collections/' || s.category || '?page=' || g.n AS page_url
        FROM (VALUES (1, 'audio'), (2, 'power'), (3, 'smart-office'), (4, 'personal-care'), (5, 'home-appliances'),
                     (6, 'gift-cards')) s(rank, category),
             (SELECT DISTINCT p_partkey // 9000 AS site_no FROM part) x, generate_series(1, 60) g(n)""",
    "local_stamps": f"""
        SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS local_ts,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc_ts, '2024-05-01 09:30:00' AS run_local_ts FROM events""",
    "cross_page_dedupe": """
        SELECT category, page_no, product_url, l_orderkey, l_extendedprice FROM (
          SELECT l_returnflag AS category, CAST(l_linenumber AS BIGINT) AS page_no, '/product/' || l_partkey AS product_url,
            l_orderkey, l_extendedprice, min(l_linenumber) OVER (PARTITION BY l_returnflag, l_partkey) AS first_page
          FROM lineitem) WHERE page_no = first_page""",
    "prefix_stop": """
        WITH t AS (
          SELECT l_suppkey AS category, CAST(weekofyear(l_shipdate) AS BIGINT) AS page_no,
            '/product/' || (l_partkey % 97) AS product_url, l_linenumber AS line, l_orderkey FROM lineitem),
        f AS (SELECT category, product_url, min(page_no) AS first_page FROM t GROUP BY ALL),
        s AS (SELECT DISTINCT category, 30 + category % 40 AS last_page FROM t WHERE page_no = 1),
        gaps AS (
          SELECT s.category, min(n) AS gap FROM s, generate_series(2, 80) g(n)
          WHERE n <= last_page AND NOT EXISTS (SELECT 1 FROM f WHERE f.category = s.category AND f.first_page = n)
          GROUP BY ALL)
        SELECT t.* FROM t JOIN f USING (category, product_url) JOIN s USING (category) LEFT JOIN gaps USING (category)
        WHERE t.page_no = f.first_page AND t.page_no < coalesce(gap, last_page + 1)""",
    "crawl_attempts": """
        WITH a AS (
          SELECT 'https://a.example/' || (event_id // 3) AS url, CAST(event_id % 3 + 1 AS INTEGER) AS attempt,
            event_type IN ('click', 'view', 'purchase') AND NOT (event_type = 'view' AND value > 50)
              AND NOT (event_type = 'click' AND value < 2) AS usable,
            event_type = 'error' AS refused, props AS html FROM events),
        w AS (
          SELECT url, min(attempt) FILTER (usable) AS won, min(attempt) FILTER (refused) AS refused_at FROM a GROUP BY ALL)
        SELECT a.url, a.attempt, a.html FROM a JOIN w ON a.url = w.url AND a.attempt = w.won
        WHERE refused_at IS NULL OR won < refused_at""",
}
