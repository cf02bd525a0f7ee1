"""One small page per extraction rule."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators import products, tiles
from tallyshelf.plans import phones
from tallyshelf.sources import page_facts
from tallyshelf.sources.page_facts import collection_page, listing_page, product_page

SLUGS = ("audio", "power", "smart-office", "personal-care", "home-appliances")

BASE = "https://shop.example"


def tile(inner: str) -> str:
    return f'<div class="x js_product site-product">{inner}</div>'


def records(spark, html: str) -> list[dict]:
    pages = spark.createDataFrame([(1, html)], "page_no INT, html STRING")
    facts = pages.select("page_no", page_facts.collection_facts("html").alias("f")).select("page_no", "f.tiles")
    return [r.asDict() for r in tiles.usable(tiles.tile_rows(facts, BASE)).orderBy("pos").collect()]


LINK = '<a href="/product/a-1?ean=7" data-name="A">t</a>'


def test_tile_needs_a_rooted_product_link(spark):
    html = tile('<a href="https://shop.example/product/a">a</a>') + tile('<a href=" /product/a">a</a>') + tile(LINK)
    assert [r["product_url"] for r in records(spark, html)] == [f"{BASE}/product/a-1?ean=7"]


def test_both_classes_are_needed():
    assert collection_page('<div class="js_product"><a href="/product/a">a</a></div>')["tiles"] == []
    assert len(collection_page(f'<div class="site-product js_product">{LINK}</div>')["tiles"]) == 1


def test_title_falls_back_to_joined_anchor_text(spark):
    html = tile('<a href="/product/a" data-name=""> x <b> y </b>z</a>')
    assert records(spark, html)[0]["title"] == "xyz"


@pytest.mark.parametrize(
    "image, expected",
    [
        ('<img src="/a.jpg">', f"{BASE}/a.jpg"),
        ('<img src="" data-src="//c.example/a.jpg">', "https://c.example/a.jpg"),
        ('<img srcset=" /s.jpg 1x, /t.jpg 2x">', f"{BASE}/s.jpg"),
        ("<img>", ""),
        ("", ""),
    ],
)
def test_image(spark, image, expected):
    html = tile(f'{LINK}<div class="product-picture-wrap">{image}</div>')
    assert records(spark, html)[0]["main_image_url"] == expected


@pytest.mark.parametrize("image", ['<img srcset=" ">', '<img srcset=",/a.jpg">', '<img src="http://[bad/a.jpg">'])
def test_tile_is_lost_with_an_unusable_image(spark, image):
    html = tile(f'{LINK}<div class="product-picture-wrap">{image}</div>') + tile(LINK)
    assert [r["pos"] for r in records(spark, html)] == [1]


def test_prices_look_at_first_match_of_each_rule_only(spark):
    empty_first = '<div class="product-desc"><p class="product-price"><span> </span><span>9</span></p></div>'
    assert records(spark, tile(LINK + empty_first))[0]["price_now"] == ""
    later = '<p class="product-price"><i class="x"><span> </span></i></p><div class="product-desc"><b class="product-price"><span>5</span><del>6</del></b></div>'
    found = records(spark, tile(LINK + later))[0]
    assert (found["price_now"], found["price_was"]) == ("5", "6")


def test_price_rules_see_ancestors_above_the_tile(spark):
    html = f'<div class="product-price">{tile(LINK + "<span>4</span>")}</div>'
    assert records(spark, html)[0]["price_now"] == "4"


def test_price_falls_back_to_attributes(spark):
    html = tile('<a href="/product/a" data-price="KES 1">a</a>') + tile(
        '<a href="/product/b">b</a><a class="js_add_to_cart" data-price="KES 2">+</a>'
    )
    assert [r["price_now"] for r in records(spark, html)] == ["KES 1", "KES 2"]


def test_points_take_the_last_span(spark):
    html = tile(
        LINK
        + '<div class="product-points"><p class="product-point"><span>a<span>b</span></span></p>'
        + '<p class="product-point"><span> </span></p><p class="product-point">none</p>'
        + '<p class="product-point"><span>c</span><span> d <b>e</b></span></p></div>'
    )
    assert records(spark, html)[0]["short_description"] == "b, de"


def test_stock_words_win_over_the_cart_button(spark):
    cart = '<a class="js_add_to_cart">+</a>'
    html = tile(LINK + cart + "<i>OUT</i> of stock") + tile(LINK + cart) + tile(LINK)
    assert [r["stock_status"] for r in records(spark, html)] == ["OutOfStock", "InStock", "Unknown"]


@pytest.mark.parametrize(
    "html, pages",
    [
        ("<p>Total <b>12</b> Pages</p><a href='?page=40'>x</a>", 12),
        ("<p>total 12 pages</p><a href='?page=3'>x</a><a href='?per_page=20'>y</a>", 20),
        ("<p>Total many, Pages; total 7 pages</p>", 7),
        ("<script>Total 9 Pages</script>", 1),
        ("", 1),
    ],
)
def test_total_pages(spark, html, pages):
    facts = collection_page(html)
    row = spark.range(1).select(
        tiles.total_pages(F.lit(facts["total_hit"]).cast("int"), F.lit(facts["link_max"]).cast("int"))
    )
    assert row.first()[0] == pages


# --- listings ----------------------------------------------------------------------------


def links(spark, html: str, start: str = "https://p.example/c/b/"):
    parsed = spark.createDataFrame([("b", 1, start, html)], "brand STRING, page_no INT, start_url STRING, html STRING")
    facts = parsed.select("brand", "page_no", "start_url", page_facts.listing_facts("html").alias("f"))
    rows = phones.link_rows(facts.select("brand", "page_no", "start_url", F.col("f.links").alias("links")), ["brand"])
    return [(r["url"], r["price_raw"]) for r in rows.filter("url IS NOT NULL").orderBy("pos").collect()]


def card(href: str, price: str = "") -> str:
    return f'<li><a href="{href}">x</a>{price}</li>'


def test_links_survive_an_add_to_cart_query_but_not_a_path(spark):
    html = "<ul class='products'>" + card("/product/a/?add-to-cart=1") + card("/product/add-to-cart/1") + card(
        "/s?u=/product/z"
    ) + card("../../product/b#x") + "</ul>"
    assert [u for u, _ in links(spark, html)] == ["https://p.example/product/a/", "https://p.example/product/b"]


def test_price_search_stops_at_the_main_element(spark):
    box = '<span class="price"><bdi>1</bdi></span>'
    plain = f"<div>{box}<main><ul class='products'>{card('/product/a')}</ul></main></div>"
    assert links(spark, plain) == [("https://p.example/product/a", "")]
    shared = f"<main><div><ul class='products'>{card('/product/a')}{card('/product/b', box)}</ul></div></main>"
    assert links(spark, shared) == [("https://p.example/product/a", "1"), ("https://p.example/product/b", "1")]


@pytest.mark.parametrize(
    "price, expected",
    [
        ('<del><bdi>5</bdi></del><ins><span class="woocommerce-Price-amount"> 4 </span></ins>', "5 -> 4"),
        ("<bdi>5</bdi> to <bdi>5</bdi><bdi>6</bdi><bdi>7</bdi>", "5 - 6 - 7"),
        ("<bdi>5</bdi> <bdi>5</bdi>", "5 5"),
        ('<i class="screen-reader-text">was</i>from\xa0 <b>3</b>', "from 3"),
        ("<del><bdi>5</bdi></del>", "5"),
    ],
)
def test_price_text(spark, price, expected):
    html = f"<ul class='products'>{card('/product/a', f'<p class=price>{price}</p>')}</ul>"
    assert links(spark, html) == [("https://p.example/product/a", expected)]


def test_first_occurrence_wins_even_without_price(spark):
    from tallyshelf.operators import page_order

    html = "<ul class='products'><a href='/product/a'>i</a>" + card("/product/a", "<b class='price'>2</b>") + "</ul>"
    found = links(spark, html)
    assert found == [("https://p.example/product/a", ""), ("https://p.example/product/a", "2")]
    rows = spark.createDataFrame([("b", 1, i, u, p) for i, (u, p) in enumerate(found)], "brand STRING, page_no INT, pos INT, url STRING, price_raw STRING")
    assert page_order.first_links(rows, ["brand"], ["price_raw"]).first()["price_raw"] == ""


def test_grid_choice():
    known = "<div><a href='/product/x'>x</a><a href='/product/y'>y</a></div><section class='products'><a href='/product/a'>a</a></section>"
    assert [k["href"] for k in listing_page(known)["links"]] == ["/product/a"]
    tie = "<div id=1><a href='/product/a'>a</a></div><div id=2><a href='/product/b'>b</a></div>"
    assert [k["href"] for k in listing_page(tie)["links"]] == ["/product/a"]
    none = "<p><a href='/product/a?add-to-cart=1'>a</a></p>"
    assert [k["href"] for k in listing_page(none)["links"]] == ["/product/a?add-to-cart=1"]


def test_boilerplate_is_removed_inside_the_root_only():
    html = (
        "<nav><a class='next' href='/outside'>n</a></nav><main><aside><ul class='products'><a href='/product/s'>s</a></ul></aside>"
        "<nav><a class='next' href='/inside'>n</a></nav><div class='widget-area'><a href='/product/w'>w</a></div>"
        "<ul><a href='/product/a'>a</a></ul></main>"
    )
    facts = listing_page(html)
    assert [k["href"] for k in facts["links"]] == ["/product/a"]
    assert facts["next_anchor"] == "/outside"


def test_next_link_in_navigation_is_invisible_without_main():
    facts = listing_page("<link rel='next' href='/l'><nav><a class='next page-numbers' href='/n'>n</a></nav>")
    assert facts["next_anchor"] is None and facts["next_link"] == "/l"


# --- product pages -----------------------------------------------------------------------


def test_key_features_list():
    html = "<ul><li>no</li></ul><div><b>key features</b></div><p></p><ul><li> a <i>b</i></li><li> </li><li>c</li></ul>"
    assert product_page(html)["key_items"] == ["a b", "c"]
    in_comment = "<!-- Key Features --><ul><li>x</li></ul>"
    assert product_page(in_comment)["key_items"] == ["x"]


def features(spark, lists):
    row = spark.range(1).select(F.from_json(F.lit(json.dumps(lists)), "array<array<string>>").alias("l"))
    return row.select(products.fullest_list("l")).first()[0]


def test_feature_fallback(spark):
    assert features(spark, [["a:1", "b:2"], ["a", "b", "c"], ["a:", "b", "c"], ["x:", "y", "z"]]) == ["a:", "b", "c"]
    assert features(spark, [["a:", "b:", "c"], ["a:", "b:", "c:"]]) == ["a:", "b:", "c:"]
    assert features(spark, [["a", "b", "c"]]) == []
    assert features(spark, []) == []


def test_description_takes_first_panel_then_short_text():
    html = "<div id='tab-description'> </div><div id='x' class='woocommerce-Tabs-panel--description'>late</div>"
    assert product_page(html)["tab_text"] == ""


def variants(spark, raw, options="map()"):
    row = spark.createDataFrame([(raw,)], "raw STRING")
    made = products.variants_json(F.col("raw"), F.expr(f"CAST({options} AS MAP<STRING, ARRAY<STRING>>)"))
    return json.loads(row.select(made).first()[0])


def test_variants(spark):
    assert variants(spark, '[{"a": 1}]') == {"variations": [{"a": 1}], "options": {}}
    assert variants(spark, "false", "map('c', array('x'))") == {"variations": False, "options": {"c": ["x"]}}
    assert variants(spark, "[{&quot;a&quot;: 1}]")["variations"] == [{"a": 1}]
    assert variants(spark, "{oops")["variations"] == []
    assert variants(spark, None) == {"variations": [], "options": {}}


def test_options():
    html = (
        "<form class='variations_form'><select id='size'><option>Choose an Option</option><option>S</option></select>"
        "<select name='size'><option>M</option></select><select name=' '><option>x</option></select>"
        "<select name='e'><option> </option></select></form>"
    )
    assert dict(product_page(html)["options"]) == {"size": ["M"]}


@pytest.mark.parametrize(
    "words, state",
    [("Sold <b>out</b> in stock", False), ("12 In\n Stock now", None), ("12 In Stock now", True), ("reinstock", None)],
)
def test_stock_state(spark, words, state):
    facts = product_page(f"<p>{words}</p>")
    row = spark.range(1).select(products.stock_state(F.lit(facts["says_gone"]), F.lit(facts["says_in_stock"])))
    assert row.first()[0] is state


def test_unreadable_page_becomes_an_error_row(spark, monkeypatch):
    def broken(html):
        if "boom" in html:
            raise ValueError("boom")
        return product_page(html)

    pages = spark.createDataFrame([("u1", "<h1>a</h1>"), ("u2", "boom"), ("u4", "")], "url STRING, html STRING")
    owned = spark.createDataFrame([(f"u{i}", "b", "KES 1") for i in (1, 2, 3, 4)], "url STRING, brand STRING, price_raw STRING")
    facts = page_facts._facts(broken, page_facts.PRODUCT_TYPE, on_error={"ok": False})
    monkeypatch.setattr(phones, "product_facts", facts)
    rows = {r["product_url"]: r for r in phones.product_records(owned, pages).collect()}
    assert {u: r["scrape_error"] for u, r in rows.items()} == {
        "u1": "", "u2": "parse_failed", "u3": "fetch_failed", "u4": "fetch_failed"
    }
    failed = rows["u2"]
    assert (failed["name"], failed["price_raw"], failed["in_stock"], failed["specs_json"]) == ("", "KES 1", None, "[]")
    assert json.loads(failed["variants_json"]) == {"variations": [], "options": {}}


def test_owner_is_settled_before_the_brand_filter(spark):
    found = spark.createDataFrame(
        [(2, "beta", "u", "2"), (1, "alpha", "u", "")], "brand_rank INT, brand STRING, url STRING, price_raw STRING"
    )
    page = "<nav class='woocommerce-breadcrumb'>Home / BETA</nav><h1>x</h1><p class='price'>9</p>"
    pages = spark.createDataFrame([("u", page)], "url STRING, html STRING")
    assert phones.phone_snapshot(found, pages, "2024-05-01 00:00:00").count() == 0
    kept = phones.phone_snapshot(found, pages, "2024-05-01 00:00:00", filter_leaks=False).first()
    assert (kept["brand"], kept["price_raw"]) == ("alpha", "9")


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def small_run(spark):
    seeds = spark.createDataFrame([(1, "b", "https://p.example/b/")], "brand_rank INT, brand STRING, start_url STRING")
    pages = [("b", n, f"<ul class='products'>{card(f'/product/{n}', '<b class=price>5</b>')}</ul><a class='next' href='{n + 1}'>n</a>") for n in (1, 2)]
    listings = spark.createDataFrame([*pages, ("other", 1, pages[0][2])], "brand STRING, page_no INT, html STRING")
    found = phones.brand_product_urls(listings, seeds)
    products_ = spark.createDataFrame([(f"https://p.example/product/{n}", f"<h1>{n}</h1>") for n in (1, 2, 3)], "url STRING, html STRING")
    return phones.phone_snapshot(found, products_, "2024-05-01 00:00:00")


def test_lists_beyond_the_broadcast_limit_give_the_same_rows(spark, no_broadcast):
    without = small_run(spark)
    assert "BroadcastHashJoin" not in plan_of(without)
    rows = sorted(without.collect())
    assert [r["name"] for r in rows] == ["1", "2"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert sorted(small_run(spark).collect()) == rows


def test_html_is_not_shuffled_for_a_seed_list(spark, tmp_path):
    from tallyshelf import session
    from tallyshelf.sources import crawl

    pages = spark.createDataFrame([("audio", 1, "x"), ("none", 1, "y")], "category STRING, page_no INT, html STRING")
    pages.write.parquet(str(tmp_path / "p"))
    for seeds in (crawl.category_seeds(spark, SLUGS), spark.createDataFrame([(1, "audio")], "rank INT, category STRING")):
        named = session.sized(seeds.select("category"), "seeds")
        assert session.fits_broadcast(named)
        joined = spark.read.parquet(str(tmp_path / "p")).join(F.broadcast(named), "category", "left_semi")
        assert "Exchange hashpartitioning" not in plan_of(joined) and joined.count() == 1


def test_a_page_is_parsed_once_per_plan(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "page_no INT, html STRING").write.parquet(str(tmp_path / "p"))
    facts = spark.read.parquet(str(tmp_path / "p")).select("page_no", page_facts.collection_facts("html").alias("f"))
    total = tiles.total_pages(F.col("f.total_hit"), F.col("f.link_max")).alias("total_pages")
    rows = tiles.tile_rows(facts.select("page_no", total, F.col("f.tiles").alias("tiles")), BASE)
    assert plan_of(rows).count("ArrowEvalPython") == 1
