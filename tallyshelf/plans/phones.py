"""Brand listing pages and product pages to the phone snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyshelf import session
from tallyshelf.functions import urls
from tallyshelf.operators import members, page_order, products
from tallyshelf.plans.catalogue import run_stamp
from tallyshelf.plans.schemas import PHONES
from tallyshelf.sources import crawl
from tallyshelf.sources.page_facts import listing_facts, product_facts


def listing_links(
    pages: DataFrame,
    seeds: DataFrame,
    keys: Sequence[str] = ("brand",),
    cap: int | None = None,
    page: str = "page_no",
) -> DataFrame:
    """Links of every present listing page of a seeded brand, as a written table.

    ``page`` names a page within its scan: a number, or an address where pages have none.

    ``*keys, page_no, next_url, pos, url, price_raw``; a page without links has one row, and
    an anchor that is no product link a row, without ``url``. Pages are parsed and addresses
    resolved once, because the later steps read different columns of them. A seed list beyond
    the broadcast limit meets the facts instead of the pages, so HTML is never shuffled.
    """
    numbered = crawl.within(F.col(page), cap) if page == "page_no" else F.lit(True)
    wanted = pages.filter(numbered & crawl.page_present(F.col("html")))
    wanted = wanted.select(*keys, page, "html")
    starts = session.sized(seeds.select(*keys, "start_url"), "seeds")
    small = session.fits_broadcast(starts)
    if small:
        wanted = wanted.join(F.broadcast(starts), list(keys))
    facts = wanted.select(*[c for c in wanted.columns if c != "html"], listing_facts(F.col("html")).alias("f"))
    if not small:
        facts = facts.join(starts, list(keys))
    next_href = F.coalesce(F.nullif("f.next_anchor", F.lit("")), F.nullif("f.next_link", F.lit("")))
    facts = facts.select(
        *keys, page, "start_url", F.col("f.links").alias("links"), urls.absolute_url(next_href, F.col("start_url")).alias("next_url")
    )
    return session.written(link_rows(facts, [*keys, page, "next_url"]), "listing-links")


def link_rows(facts: DataFrame, others: Sequence[str]) -> DataFrame:
    """``*others, pos, url, price_raw`` for every anchor of ``links``; ``url`` only where it is
    a product link. Resolved and stripped in steps, so no address is worked out twice."""
    link = F.col("_link")
    rows = facts.select(*others, "start_url", F.explode_outer("links").alias("_link"))
    rows = rows.select(*others, "_link", urls.absolute_url(link["href"], F.col("start_url")).alias("_url"))
    rows = rows.select(*others, "_link", urls.without_query(F.col("_url")).alias("_url"))
    return rows.select(
        *others,
        link["pos"].alias("pos"),
        F.when(urls.is_product_link(F.col("_url")), F.col("_url")).alias("url"),
        products.price_text(link["price"]).alias("price_raw"),
    )


def scan_urls(
    links: DataFrame, keys: Sequence[str] = ("brand",), cap: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(URLs a next-link scan of every brand finds, stop page of every scan)."""
    named = links.filter("url IS NOT NULL")
    # Read for the stops and for the URLs.
    spots = session.written(page_order.first_spots(named, keys), "first-spots")
    present = links.select(*keys, "page_no", F.col("next_url").isNotNull().alias("has_next"))
    stops = page_order.brand_stops(present, spots, keys, cap)
    reached = page_order.before_stop(spots, stops, keys, "first_page")
    return page_order.at_spots(named, reached, keys, ["price_raw"]), stops


def brand_product_urls(
    pages: DataFrame, seeds: DataFrame, keys: Sequence[str] = ("brand",), cap: int | None = None
) -> DataFrame:
    """``*keys, brand_rank, url, price_raw, first_page, pos``: the URLs found under each brand.

    ``seeds`` holds ``*keys, brand_rank, start_url``; ``keys`` identify one scan.
    """
    return _ranked_urls(listing_links(pages, seeds, keys, cap), seeds, keys, cap)


def brand_urls_by_links(
    pages: DataFrame, seeds: DataFrame, keys: Sequence[str] = ("brand",), cap: int | None = None
) -> DataFrame:
    """As ``brand_product_urls`` for ``pages`` (``*keys, url, html``) that carry no number.

    Pages are numbered by following next links from ``start_url``; pages that no link leads to
    do not count, and a page landed twice counts once.
    """
    named = pages.select(*keys, F.col("url").alias("page_url"), "html")
    links = listing_links(named, seeds, keys, page="page_url")
    steps = links.select(*keys, F.col("page_url").alias("url"), "next_url").distinct()
    chain = page_order.numbered_chain(steps, seeds, keys, cap).withColumnRenamed("url", "page_url")
    numbered = links.distinct().join(chain, [*keys, "page_url"])
    return _ranked_urls(session.written(numbered, "numbered-links"), seeds, keys, cap)


def _ranked_urls(links: DataFrame, seeds: DataFrame, keys: Sequence[str], cap: int | None) -> DataFrame:
    found, _ = scan_urls(links, keys, cap)
    ranks = session.sized(seeds.select(*keys, "brand_rank"), "seeds")
    return found.join(ranks, list(keys)).select(
        *keys, "brand_rank", "url", "price_raw", "first_page", "pos"
    )


def asked_pages(owned: DataFrame, product_pages: DataFrame) -> DataFrame:
    """``url, html`` of present pages, nearly all of them among the URLs of ``owned``."""
    pages = product_pages.select("url", "html").filter(crawl.page_present(F.col("html")))
    return members.pruned(pages, owned, "url")


def product_records(owned: DataFrame, product_pages: DataFrame, filter_leaks: bool = True) -> DataFrame:
    """Attach page facts to every URL, then drop pages of other brands and mark failures.

    ``owned`` is ``url, brand, price_raw`` with one row per URL; ``product_pages`` is
    ``url, html``; of several rows of one URL a readable one counts. Pages nobody asked for go by
    a bitmap of the URLs, whatever their number; the others are parsed where they lie, and only
    their facts are written and joined, so HTML is not shuffled.
    """
    owned = session.written(owned, "owned-urls")
    pages = asked_pages(owned, product_pages)
    facts = pages.select(
        "url", product_facts(F.col("html")).alias("f"), F.xxhash64("html").alias("digest"), F.monotonically_increasing_id().alias("id")
    )
    facts = session.written(facts, "product-facts")
    # A page landed more than once counts once: a readable one before others, then by its digest.
    # Only (url, number, number) is aggregated; pages with equal digests have equal facts.
    order = F.when(F.col("f.ok"), F.lit(0)).otherwise(F.lit(1 << 62)) + F.shiftrightunsigned("digest", 2)
    counted = facts.groupBy("url").agg(F.min_by("id", order).alias("id"))
    facts = facts.join(counted, ["url", "id"], "left_semi").select("url", "f")
    joined = owned.join(facts, "url", "left")

    f = F.col("f")
    ok = F.coalesce(f["ok"], F.lit(False))
    error = F.when(f.isNull(), "fetch_failed").when(~f["ok"], "parse_failed").otherwise("")
    if filter_leaks:
        leaked = ok & ~products.names_brand(f["breadcrumb"], F.col("brand"))
        joined = joined.filter(~F.coalesce(leaked, F.lit(False)))

    specs = products.feature_list(f["key_items"], f["lists"])
    variants = products.variants_json(f["variations"], f["options"])
    price = F.when(F.col("price_raw") != "", F.col("price_raw")).otherwise(
        F.when(ok, products.price_text(f["price"])).otherwise(F.lit(""))
    )
    return joined.select(
        "brand",
        F.when(ok, urls.without_query(F.col("url"))).otherwise(F.col("url")).alias("product_url"),
        F.when(ok, f["name"]).otherwise(F.lit("")).alias("name"),
        price.alias("price_raw"),
        F.when(ok, products.stock_state(f["says_gone"], f["says_in_stock"])).alias("in_stock"),
        F.when(ok, F.to_json(specs)).otherwise(F.lit("[]")).alias("specs_json"),
        F.when(ok, products.description(f["tab_text"], f["short_text"])).otherwise(F.lit("")).alias("description"),
        F.when(ok, variants).otherwise(F.lit(products.NO_VARIANTS)).alias("variants_json"),
        error.alias("scrape_error"),
    )


def phone_snapshot(
    found: DataFrame,
    product_pages: DataFrame,
    run_ts: dt.datetime | str | None = None,
    filter_leaks: bool = True,
) -> DataFrame:
    """The whole job from ``brand_product_urls`` output.

    Ownership is settled before the brand filter: a URL whose owner fails the filter is gone,
    later brands do not get it.
    """
    found = session.written(found.select("url", "brand_rank", "brand", "price_raw"), "found-urls")
    owned = page_order.owned_urls(found, "brand_rank", ["brand", "price_raw"])
    records = product_records(owned.select("url", "brand", "price_raw"), product_pages, filter_leaks)
    return records.withColumn("ts", run_stamp(run_ts)).to(PHONES)
