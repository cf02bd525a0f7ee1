"""Page-order rules: repeats, page caps, where a scan stops, which brand owns a URL.

A crawl reads pages one after another and carries state. Here the same outcome comes from
aggregates: "seen on an earlier page" is a minimum page number, and "the scan stopped at p"
is the first gap in the set of pages that brought something new. Groups are reduced to
minimums and to the set of a scan's page numbers before they are shuffled, so a hot category
or URL never gathers its rows in one task. Page limits hold only where a caller names one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyshelf import session
from tallyshelf.sources.crawl import within


def first_pages(tiles: DataFrame, keys: Sequence[str], url: str = "product_url") -> DataFrame:
    """First page of every URL within its scan: ``*keys, url, first_page``."""
    return tiles.groupBy(*keys, url).agg(F.min("page_no").alias("first_page"))


def drop_repeats(tiles: DataFrame, firsts: DataFrame, keys: Sequence[str], url: str = "product_url") -> DataFrame:
    """Keep tiles on the first page of their URL; repeats within that page stay.

    The page number is part of the join key, which spreads a URL that recurs everywhere, and
    both sides arrive as plain shuffles so adaptive execution may split what is still skewed.
    """
    firsts = firsts.withColumnRenamed("first_page", "page_no")
    return tiles.join(firsts, [*keys, url, "page_no"], "left_semi")


def _first_gap(pages: Column, start: int) -> Column:
    """Lowest number from ``start`` on that is missing from the set ``pages``."""
    after = F.array_sort(F.filter(pages, lambda p: p >= start))
    met = F.transform(after, lambda p, i: F.struct((p == i + start).alias("as_expected"), (i + start).alias("n")))
    gaps = F.filter(met, lambda m: ~m["as_expected"])
    return F.coalesce(F.get(gaps, F.lit(0))["n"], F.size(after) + start)


def _no_pages() -> Column:
    return F.array().cast("array<int>")


def collection_stops(pages: DataFrame, firsts: DataFrame, keys: Sequence[str], cap: int | None = None) -> DataFrame:
    """Per scan: ``*keys, last_page, stop_page``; only pages below ``stop_page`` count.

    ``pages`` holds ``*keys, page_no, total_pages`` of the pages that exist. A scan without
    page 1 yields no row. Page 1 may bring nothing; any later page up to the last that is
    missing, empty or all repeats ends the scan.
    """
    total = F.max("total_pages")
    last = total if cap is None else F.least(total, F.lit(cap))
    caps = pages.filter("page_no = 1").groupBy(*keys).agg(last.cast("int").alias("last_page"))
    new_pages = (
        firsts.filter(within(F.col("first_page"), cap))
        .groupBy(*keys)
        .agg(F.collect_set(F.col("first_page").cast("int")).alias("_new"))
    )
    gap = _first_gap(F.coalesce("_new", _no_pages()), 2)
    return caps.join(new_pages, list(keys), "left").select(
        *keys, "last_page", F.least(gap, F.greatest("last_page", F.lit(1)) + 1).alias("stop_page")
    )


def before_stop(rows: DataFrame, stops: DataFrame, keys: Sequence[str], page: str = "page_no") -> DataFrame:
    """Rows on pages the scan reached. One stop row per scan; the planner sizes the join."""
    return rows.join(stops.select(*keys, "stop_page"), list(keys)).filter(F.col(page) < F.col("stop_page")).drop("stop_page")


def kept_tiles(
    tiles: DataFrame,
    firsts: DataFrame,
    stops: DataFrame,
    keys: Sequence[str],
    seen: Callable[[DataFrame], DataFrame] | None = None,
    url: str = "product_url",
) -> DataFrame:
    """Tiles on the first page of their URL and before the page where the scan stopped.

    A kept tile's page is its URL's first page, so the narrow list of first pages meets the
    stops and the wide tiles move once, dealt by scan, URL and page. ``seen`` may observe that
    list: a row per scan and URL the scan reached.
    """
    reached = before_stop(firsts, stops, keys, "first_page")
    if seen:
        reached = seen(reached)
    return drop_repeats(tiles, reached, keys, url)


def first_spots(links: DataFrame, keys: Sequence[str], url: str = "url") -> DataFrame:
    """First (page, position) of every URL within its scan: ``*keys, url, first_page, pos``.

    Page and position are one number in page order, so the minimum is a hash aggregate.
    """
    kinds = {c: links.schema[c].dataType for c in ("page_no", "pos")}
    spot = F.shiftleft(F.col("page_no").cast("long"), 32) + F.col("pos")
    found = links.groupBy(*keys, url).agg(F.min(spot).alias("_spot"))
    return found.select(
        *keys,
        url,
        F.shiftright("_spot", 32).cast(kinds["page_no"]).alias("first_page"),
        F.col("_spot").bitwiseAND(F.lit((1 << 32) - 1)).cast(kinds["pos"]).alias("pos"),
    )


def _carried(links: DataFrame, best: DataFrame, on: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """``best`` (``on``) with the columns found there; of several rows of one spot the least."""
    met = links.select(*on, *carry).join(best.select(*on), list(on), "left_semi")
    one = met.groupBy(*on).agg(F.array_min(F.collect_set(F.struct(*carry))).alias("_there"))
    return one.select(*on, *[f"_there.{c}" for c in carry])


def at_spots(links: DataFrame, spots: DataFrame, keys: Sequence[str], carry: Sequence[str], url: str = "url") -> DataFrame:
    """``spots`` with the columns ``carry`` of the links that stand there."""
    named = links.withColumnRenamed("page_no", "first_page")
    return _carried(named, spots, [*keys, url, "first_page", "pos"], carry)


def first_links(links: DataFrame, keys: Sequence[str], carry: Sequence[str], url: str = "url") -> DataFrame:
    """First (page, position) of every URL within its scan, with the columns found there."""
    return at_spots(links, first_spots(links, keys, url), keys, carry, url)


def brand_stops(pages: DataFrame, firsts: DataFrame, keys: Sequence[str], cap: int | None = None) -> DataFrame:
    """Per scan: ``*keys, stop_page`` for scans that follow next-page links.

    ``pages`` holds ``*keys, page_no, has_next`` of the pages that exist. The scan ends at a
    missing page, at a later page without a new URL, or after a page without a next link.
    """
    seen = pages.filter(within(F.col("page_no"), cap)).groupBy(*keys).agg(
        F.collect_set(F.col("page_no").cast("int")).alias("_present"),
        F.min(F.when(~F.col("has_next"), F.col("page_no") + 1)).alias("_after_last"),
    )
    new_pages = (
        firsts.filter(within(F.col("first_page"), cap))
        .groupBy(*keys)
        .agg(F.collect_set(F.col("first_page").cast("int")).alias("_new"))
    )
    ends = [_first_gap(F.col("_present"), 1), _first_gap(F.coalesce("_new", _no_pages()), 2), F.col("_after_last")]
    # A scan with every page has its end in the first of these; NULL in the last is passed over.
    stop = F.least(*ends, *([] if cap is None else [F.lit(cap + 1)]))
    return seen.join(new_pages, list(keys), "left").select(*keys, stop.cast("int").alias("stop_page"))


def owned_urls(links: DataFrame, rank: str, carry: Sequence[str], url: str = "url") -> DataFrame:
    """Every URL once, under the earliest-ranked brand that lists it. ``links`` are read twice."""
    best = links.groupBy(url).agg(F.min(rank).alias(rank))
    return _carried(links, best, [url, rank], carry)


def numbered_chain(pages: DataFrame, seeds: DataFrame, keys: Sequence[str], cap: int | None = None) -> DataFrame:
    """Give pages their number by following next links from each start URL.

    ``pages`` holds ``*keys, url, next_url``; a page landed twice counts once, and a page that
    is linked to again keeps its first number, so circles end. ``seeds`` holds ``*keys,
    start_url``. For page tables that were landed without a page number. The reach doubles
    each round (1, 2, 4, ... pages ahead) until a round brings no new page; every round is
    written, which keeps plans flat and survives lost executors.
    """
    on = [*keys, "url"]
    reach = seeds.select(*keys, F.col("start_url").alias("url"), F.lit(1).alias("page_no")).distinct()
    jump = session.written(pages.filter("next_url IS NOT NULL").select(*on, "next_url").distinct(), "chain-links")
    step, known = 1, 0
    while cap is None or step < cap:
        ahead = reach.join(jump, on).select(*keys, F.col("next_url").alias("url"), (F.col("page_no") + step).alias("page_no"))
        every = reach.unionByName(ahead).groupBy(*on).agg(F.min("page_no").alias("page_no"))
        reach = session.written(every.filter(within(F.col("page_no"), cap)), "chain-reach")
        now = reach.count()
        if now == known:
            break
        known, step = now, step * 2
        onward = jump.select(*keys, F.col("url").alias("next_url"), F.col("next_url").alias("_far"))
        farther = jump.join(onward, [*keys, "next_url"]).select(*on, F.col("_far").alias("next_url")).distinct()
        jump = session.written(farther, "chain-links")
    return reach.select(*keys, "page_no", "url")
