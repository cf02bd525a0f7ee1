"""Page-order rules against a page-by-page loop on random crawls."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyshelf.operators import page_order
from tallyshelf.plans import phones
from tallyshelf.sources import crawl

SLUGS = ("audio", "power", "smart-office", "personal-care", "home-appliances")


def read_collection(pages: dict[int, list[str] | None], total: int, cap: int) -> list[tuple[int, str]]:
    """A crawler reading one collection page after page."""
    if pages.get(1) is None:
        return []
    out, seen = [], set()
    for no in range(1, max(1, min(total, cap)) + 1):
        urls = pages.get(no)
        if urls is None:
            break
        new = [u for u in urls if u not in seen]
        if no > 1 and not new:
            break
        out += [(no, u) for u in new]
        seen |= set(new)
    return out


def test_collections_equal_a_sequential_reader(spark):
    rng = random.Random(4)
    expected, tiles, pages = [], [], []
    for c in range(300):
        crawl_pages = {}
        for no in range(1, rng.randint(1, 9)):
            if rng.random() < 0.1:
                continue
            crawl_pages[no] = [f"u{rng.randint(0, 4 + 3 * no)}" for _ in range(rng.choice([0, 1, 2, 3, 5, 5]))]
        total = rng.randint(0, 9)
        name = f"c{c}"
        expected += [(name, no, u) for no, u in read_collection(crawl_pages, total, 6)]
        for no, urls in crawl_pages.items():
            pages.append((name, no, total if no == 1 else 99))
            tiles += [(name, no, u) for u in urls]
    tile_rows = spark.createDataFrame(tiles, "category STRING, page_no INT, product_url STRING")
    page_rows = spark.createDataFrame(pages, "category STRING, page_no INT, total_pages INT")
    firsts = page_order.first_pages(tile_rows, ["category"])
    stops = page_order.collection_stops(page_rows, firsts, ["category"], cap=6)
    kept = page_order.drop_repeats(page_order.before_stop(tile_rows, stops, ["category"]), firsts, ["category"])
    found = [(r["category"], r["page_no"], r["product_url"]) for r in kept.collect()]
    assert sorted(found) == sorted(expected)


def read_brand(pages: dict[int, tuple[list[str], bool] | None], cap: int) -> dict[str, int]:
    out: dict[str, int] = {}
    no, more = 0, True
    while more and no < cap:
        no += 1
        if pages.get(no) is None:
            break
        urls, more = pages[no]
        fresh = [u for u in urls if u not in out]
        for u in fresh:
            out.setdefault(u, no)
        if no > 1 and not fresh:
            break
    return out


def test_brands_equal_a_sequential_reader(spark):
    rng = random.Random(9)
    expected, owners, links, pages = {}, {}, [], []
    for rank in range(1, 150):
        brand = f"b{rank:03d}"
        listing = {}
        for no in range(1, rng.randint(1, 9)):
            if rng.random() < 0.08:
                continue
            listing[no] = ([f"u{rng.randint(0, 200)}" for _ in range(rng.choice([0, 1, 3, 4]))], rng.random() < 0.85)
        for url, no in read_brand(listing, 5).items():
            expected[brand, url] = no
            owners.setdefault(url, brand)
        for no, (urls, more) in listing.items():
            pages.append((brand, no, more))
            links += [(brand, no, i, u, f"{brand}-{no}-{i}") for i, u in enumerate(urls)]
    link_rows = spark.createDataFrame(links, "brand STRING, page_no INT, pos INT, url STRING, price_raw STRING")
    page_rows = spark.createDataFrame(pages, "brand STRING, page_no INT, has_next BOOLEAN")
    firsts = page_order.first_links(link_rows, ["brand"], ["price_raw"])
    stops = page_order.brand_stops(page_rows, firsts, ["brand"], cap=5)
    found = page_order.before_stop(firsts, stops, ["brand"], "first_page")
    rows = found.collect()
    assert {(r["brand"], r["url"]): r["first_page"] for r in rows} == expected
    assert all(r["price_raw"].startswith(f"{r['brand']}-{r['first_page']}-") for r in rows)
    ranked = found.withColumn("brand_rank", F.substring("brand", 2, 3).cast("int"))
    owned = page_order.owned_urls(ranked, "brand_rank", ["brand"])
    assert {r["url"]: r["brand"] for r in owned.collect()} == owners


def test_page_cap_of_a_brand(spark):
    rows = [("b", no, 0, f"u{no}", "") for no in range(1, 131)]
    links = spark.createDataFrame(rows, "brand STRING, page_no INT, pos INT, url STRING, price_raw STRING")
    pages = links.select("brand", "page_no", F.lit(True).alias("has_next"))
    firsts = page_order.first_links(links, ["brand"], ["price_raw"])
    for cap, pages_read in ((120, 120), (None, 130)):
        stops = page_order.brand_stops(pages, firsts, ["brand"], cap)
        assert page_order.before_stop(firsts, stops, ["brand"], "first_page").count() == pages_read


def test_wide_rows_move_once(spark):
    rows = spark.createDataFrame([("c", 1, "u", "wide")], "category STRING, page_no INT, product_url STRING, html STRING")
    pages = spark.createDataFrame([("c", 1, 3)], "category STRING, page_no INT, total_pages INT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        firsts = page_order.first_pages(rows, ["category"])
        stops = page_order.collection_stops(pages, firsts, ["category"])
        kept = page_order.kept_tiles(rows, firsts, stops, ["category"])
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    wide = [line for line in moved if "page_no" in line.split("hashpartitioning(")[1].split(")")[0]]
    # Both sides of the one semi join; the wide side is dealt by nothing else.
    assert len(wide) == 2 and all("product_url" in w for w in wide)


def test_chain_of_next_links(spark):
    pages = [("b", f"p{n}", f"p{n + 1}") for n in range(1, 125)] + [("c", "q1", None)]
    pages += pages[:40] + [("d", "r1", "r2"), ("d", "r2", "r1")]
    steps = spark.createDataFrame(pages, "brand STRING, url STRING, next_url STRING")
    seeds = spark.createDataFrame([("b", "p1"), ("c", "q1"), ("d", "r1")], "brand STRING, start_url STRING")
    for cap, last in ((120, 120), (None, 125)):
        chain = page_order.numbered_chain(steps, seeds, ["brand"], cap).collect()
        assert {r["url"]: r["page_no"] for r in chain if r["brand"] == "b"} == {f"p{n}": n for n in range(1, last + 1)}
        assert [r["url"] for r in chain if r["brand"] == "c"] == ["q1"]
        assert sorted((r["page_no"], r["url"]) for r in chain if r["brand"] == "d") == [(1, "r1"), (2, "r2")]


def fetch(attempts: list[tuple[int, int, str | None]]) -> int | None:
    for attempt, status, kind in attempts:
        if status == 200 and "text/html" in (kind or ""):
            return attempt
        if 400 <= status < 500:
            return None
    return None


def test_attempts_equal_a_sequential_fetch(spark):
    rng = random.Random(2)
    rows, expected, without_cap = [], {}, {}
    for n in range(400):
        tries = [
            (a, rng.choice([200, 200, 500, 404, 0]), rng.choice(["text/html; charset=utf-8", "text/html", "image/png", None]))
            for a in range(1, rng.randint(1, 4) + 1)
        ]
        for cap, into in ((3, expected), (None, without_cap)):
            if won := fetch(tries[:cap]):
                into[f"u{n}"] = f"{won}"
        rows += [(f"u{n}", a, s, k, f"{a}") for a, s, k in tries]
    df = spark.createDataFrame(rows, "url STRING, attempt INT, status INT, content_type STRING, html STRING")
    assert {r["url"]: r["html"] for r in crawl.resolve_attempts(df, max_attempts=3).collect()} == expected
    assert {r["url"]: r["html"] for r in crawl.resolve_attempts(df).collect()} == without_cap


def test_plan_and_seeds(spark):
    plan = crawl.crawl_plan(crawl.category_seeds(spark, SLUGS), "https://shop.example", pages=3)
    assert plan.count() == 15
    first = plan.orderBy("rank", "page_no").first()
    assert first["page_url"] == "https://shop.example/collections/audio?page=1"
    brands = crawl.brand_seeds(spark, {"b": "https://x/b/", "a": "https://x/a/"})
    assert [(r["brand_rank"], r["brand"]) for r in brands.orderBy("brand_rank").collect()] == [(1, "b"), (2, "a")]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_by_hash_aggregates(spark):
    links = spark.createDataFrame(
        [("a", "u", 2, 7, "9"), ("a", "u", 1, 9, "x"), ("a", "u", 1, 3, "b"), ("a", "u", 1, 3, None), ("b", "u", 1, 1, "c"), ("a", "v", 40000, 0, "d")],
        "brand STRING, url STRING, page_no INT, pos INT, price STRING",
    )
    firsts = page_order.first_links(links, ["brand"], ["price"])
    assert sorted(tuple(r) for r in firsts.collect()) == [("a", "u", 1, 3, None), ("a", "v", 40000, 0, "d"), ("b", "u", 1, 1, "c")]
    ranked = links.withColumn("rank", F.when(F.col("brand") == "b", 1).otherwise(2))
    owned = page_order.owned_urls(ranked, "rank", ["brand", "price"])
    assert sorted(tuple(r) for r in owned.collect()) == [("u", 1, "b", "c"), ("v", 2, "a", "d")]
    assert "SortAggregate" not in physical(firsts) and "SortAggregate" not in physical(owned)


def test_pages_go_before_the_parse_whatever_the_list(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        owned = spark.range(3000).selectExpr("concat('u', id) AS url")
        pages = spark.range(30000).selectExpr("concat('u', id) AS url", "IF(id % 2 = 0, 'x', '') AS html")
        kept = {r["url"] for r in phones.asked_pages(owned, pages).collect()}
        assert {f"u{i}" for i in range(0, 3000, 2)} <= kept and len(kept) < 1500 + 13500 / 10
        assert "Exchange hashpartitioning(url" not in physical(phones.asked_pages(owned, pages))
        nothing = phones.asked_pages(owned.limit(0), pages)
        assert nothing.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
