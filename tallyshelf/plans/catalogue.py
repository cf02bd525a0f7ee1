"""Collection pages to the 13-column catalogue snapshot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyshelf import session
from tallyshelf.functions import text
from tallyshelf.operators import page_order, tiles
from tallyshelf.operators.metrics import Tally
from tallyshelf.plans.schemas import CATALOGUE
from tallyshelf.sources import crawl
from tallyshelf.sources.page_facts import collection_facts


def run_stamp(run_ts: dt.datetime | str | None) -> Column:
    """One UTC time for all rows of a run, cut to seconds."""
    value = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return F.date_trunc("second", value)


def local_stamp_text(run_ts: dt.datetime | str | None, zone: str = "Africa/Nairobi") -> Column:
    """The run time as wall-clock text of one zone, for text sinks."""
    ntz = run_stamp(run_ts).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz), "yyyy-MM-dd HH:mm:ss")


def sheet_rows(snapshot: DataFrame, run_ts: dt.datetime | str | None, zone: str = "Africa/Nairobi") -> DataFrame:
    """The snapshot as 13 text columns for ``append_under_header``, the run time in local time."""
    others = [F.col(c).cast("string").alias(c) for c in CATALOGUE.names if c != "ts"]
    return snapshot.select(local_stamp_text(run_ts, zone).alias("ts"), *others)


def page_tiles(
    pages: DataFrame,
    seeds: DataFrame,
    base_url: Column | str,
    keys: Sequence[str],
    cap: int | None = None,
    tally: Tally | None = None,
) -> DataFrame:
    """Tile records of every present page of a seeded category, as a written table.

    ``*keys, page_no, total_pages, pos`` and the record columns; a page without tiles has one
    row without ``product_url``. The page limit, the seed list and the presence test run
    before the parse, and the scan reads the keys, ``page_no`` and ``html`` only. A seed list
    beyond the broadcast limit is applied to the facts instead, so HTML is never shuffled.
    Pages are parsed and records built once, because the later steps read different columns.
    A ``tally`` counts the pages and their tiles.
    """
    wanted = pages.filter(crawl.within(F.col("page_no"), cap) & crawl.page_present(F.col("html")))
    wanted = wanted.select(*keys, "page_no", "html")
    named = session.sized(seeds.select("category"), "seeds")
    small = session.fits_broadcast(named)
    if small:
        wanted = wanted.join(F.broadcast(named), "category", "left_semi")
    facts = wanted.select(*keys, "page_no", collection_facts(F.col("html")).alias("f"))
    if not small:
        facts = facts.join(named, "category", "left_semi")
    total = tiles.total_pages(F.col("f.total_hit"), F.col("f.link_max")).alias("total_pages")
    facts = facts.select(*keys, "page_no", total, F.col("f.tiles").alias("tiles"))
    rows = tiles.tile_rows(tally.watch("pages", facts) if tally else facts, base_url)
    if tally:
        rows = tally.watch("tiles", rows, usable=F.count("product_url"))
    return session.written(rows, "collection-tiles")


def scan_result(
    rows: DataFrame, keys: Sequence[str], cap: int | None = None, tally: Tally | None = None
) -> DataFrame:
    """Of ``page_tiles``, what a page-by-page scan keeps: no repeats of earlier pages, nothing
    from the page it stopped at on. A ``tally`` counts the URLs that are new to their scan."""
    found = tiles.usable(rows)
    firsts = page_order.first_pages(found, keys)
    stops = page_order.collection_stops(rows.select(*keys, "page_no", "total_pages"), firsts, keys, cap)
    seen = (lambda new: tally.watch("new URLs", new)) if tally else None
    return page_order.kept_tiles(found.drop("total_pages"), firsts, stops, keys, seen)


def shaped(rows: DataFrame, run_ts: dt.datetime | str | None = None) -> DataFrame:
    return rows.select(
        run_stamp(run_ts).alias("ts"),
        text.category_label(F.col("category")).alias("category"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in tiles.TILE_COLUMNS],
    ).to(CATALOGUE)


def catalogue_snapshot(
    pages: DataFrame,
    seeds: DataFrame,
    base_url: Column | str,
    run_ts: dt.datetime | str | None = None,
    keys: Sequence[str] = ("category",),
    cap: int | None = None,
    tally: Tally | None = None,
) -> DataFrame:
    """The whole job. ``keys`` identify one scan: category alone, or site/run plus category.

    ``base_url`` may be a column of ``keys`` when several sites are read at once. A ``tally``
    has its counters once the snapshot is written.
    """
    found = page_tiles(pages, seeds, base_url, keys, cap, tally)
    rows = shaped(scan_result(found, keys, cap, tally), run_ts)
    return tally.watch("snapshot", rows) if tally else rows
