"""Product tiles of collection pages: from raw facts to record columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyshelf.functions import text, urls

CURRENCY = "KES"

TILE_COLUMNS = (
    "product_url",
    "title",
    "short_description",
    "price_now",
    "price_was",
    "currency",
    "main_image_url",
    "ean",
    "model",
    "stock_status",
    "slug",
)


def total_pages(total_hit: Column, link_max: Column) -> Column:
    return F.coalesce(total_hit, link_max, F.lit(1))


def first_filled(texts: Column) -> Column:
    """First non-empty entry, empty text when there is none."""
    return F.coalesce(F.get(F.filter(texts, lambda t: t != ""), F.lit(0)), F.lit(""))


def image_source(tile: Column) -> Column:
    """``src``, else ``data-src``, else the first address of ``srcset``.

    NULL when ``srcset`` is the only source and its first candidate is blank: such a tile is
    lost as a whole.
    """
    candidate = text.strip(F.split(tile["srcset"], ",")[0])
    from_set = F.nullif(F.split(candidate, f"{text.SPACE}+")[0], F.lit(""))
    plain = text.filled(tile["src"], tile["data_src"])
    return F.when(plain != "", plain).when(F.length(tile["srcset"]) > 0, from_set).otherwise(F.lit(""))


def stock_status(tile: Column) -> Column:
    return (
        F.when(tile["says_out_of_stock"], "OutOfStock").when(tile["has_cart"], "InStock").otherwise("Unknown")
    )


def tile_rows(pages: DataFrame, base_url: Column | str, tiles: str = "tiles") -> DataFrame:
    """One row per tile, in page order: the page's other columns, ``pos`` and the record.

    A page without tiles keeps one row, and so does a tile whose image address cannot be
    resolved; both have no ``product_url``. ``usable`` drops them.
    """
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    others = [c for c in pages.columns if c != tiles]
    t = F.col("_tile")
    rows = pages.select(*others, base.alias("_base"), F.explode_outer(tiles).alias("_tile"))
    rows = rows.select("*", text.strip(t["href"]).alias("_href"), image_source(t).alias("_image"))
    rows = rows.select(
        "*",
        urls.absolute_url(F.col("_href"), F.col("_base")).alias("_url"),
        urls.absolute_url(F.col("_image"), F.col("_base")).alias("_main_image"),
    )
    record = {
        "product_url": F.when(F.col("_main_image").isNotNull(), F.col("_url")),
        "title": text.filled(t["data_name"], t["anchor_text"]),
        "short_description": F.array_join(F.filter(t["points"], lambda p: p != ""), ", "),
        "price_now": text.filled(first_filled(t["now_texts"]), t["data_price"], t["cart_price"]),
        "price_was": first_filled(t["was_texts"]),
        "currency": F.lit(CURRENCY),
        "main_image_url": F.col("_main_image"),
        "ean": urls.query_value(F.col("_href"), "ean"),
        "model": text.strip(F.coalesce(t["data_sku"], F.lit(""))),
        "stock_status": stock_status(t),
        "slug": urls.product_slug(F.col("_url")),
    }
    return rows.select(*others, t["pos"].alias("pos"), *[record[name].alias(name) for name in TILE_COLUMNS])


def usable(rows: DataFrame) -> DataFrame:
    return rows.filter("product_url IS NOT NULL")
