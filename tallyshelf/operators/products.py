"""Product links and product pages: from raw facts to record columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyshelf.functions import text

NO_VARIANTS = '{"variations": [], "options": {}}'


def price_text(price: Column) -> Column:
    """Visible price: sale ``was -> now``, range of distinct amounts, else the whole text."""
    amounts = F.array_distinct(F.filter(price["amounts"], lambda a: a != ""))
    sale = price["was"].isNotNull() & price["now"].isNotNull()
    return (
        F.when(price.isNull(), F.lit(""))
        .when(sale, F.concat(price["was"], F.lit(" -> "), price["now"]))
        .when(F.size(amounts) >= 2, F.array_join(amounts, " - "))
        .otherwise(F.coalesce(price["full"], F.lit("")))
    )


def stock_state(says_gone: Column, says_in_stock: Column) -> Column:
    """False when sold out, True when stated, NULL when the page does not say."""
    return F.when(says_gone, F.lit(False)).when(says_in_stock, F.lit(True))


def stock_state_of(page_text: Column) -> Column:
    low = F.lower(page_text)
    return stock_state(low.contains("sold out") | low.contains("out of stock"), low.rlike(r"(?U)\bin stock\b"))


def fullest_list(lists: Column) -> Column:
    """Among lists of three or more items, the first with most ``:`` items; none scores 0."""
    scored = F.transform(
        F.filter(lists, lambda items: F.size(items) >= 3),
        lambda items, i: F.struct(
            F.size(F.filter(items, lambda x: F.contains(x, F.lit(":")))).alias("score"), (-i).alias("rank"), items.alias("items")
        ),
    )
    best = F.array_max(F.filter(scored, lambda s: s["score"] > 0))
    return F.coalesce(best["items"], F.array().cast("array<string>"))


def feature_list(key_items: Column, lists: Column) -> Column:
    return F.when(F.size(key_items) > 0, key_items).otherwise(fullest_list(lists))


def plain_json(raw: Column) -> Column:
    """The text written anew from its parsed value; NULL unless the whole text is one JSON value.

    The parser stops at the end of a value, so text behind it is found by parsing the text as
    an array element and as a field too. A repeated key needs
    ``spark.sql.variant.allowDuplicateKeys``, under which the last one counts.
    """
    as_item = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), raw, F.lit("}")))
    one = F.size(F.try_variant_get(as_item, "$", "array<variant>")) == 1
    return F.when(one & as_field.isNotNull(), F.to_json(F.try_parse_json(raw)))


def variants_json(raw: Column, options: Column) -> Column:
    """``{"variations": ..., "options": {...}}``; unreadable variations become ``[]``."""
    unescaped = F.replace(raw, F.lit("&quot;"), F.lit('"'))
    variations = F.coalesce(plain_json(raw), plain_json(unescaped), F.lit("[]"))
    chosen = F.coalesce(options, F.create_map().cast("map<string,array<string>>"))
    return F.concat(F.lit('{"variations": '), variations, F.lit(', "options": '), F.to_json(chosen), F.lit("}"))


def variation_rows(records: DataFrame, keys: Sequence[str], variants: str = "variants_json") -> DataFrame:
    """One row per variation of a record: ``*keys, pos, sku, price, regular_price, in_stock, options``.

    ``variants`` is what ``variants_json`` made. ``pos`` counts from 0; ``options`` maps the variation's own option names
    to the chosen values. A field that is missing or of another kind is NULL, a price in quotes is read as a number.
    Variations that are no list, and list entries that are no object, have no rows.
    """
    listed = F.try_variant_get(F.try_parse_json(variants), "$.variations", "variant")
    named = records.select(*keys, listed.alias("_listed"))
    each = records.sparkSession.tvf.variant_explode(F.col("_listed").outer())
    rows = named.lateralJoin(each).where("key IS NULL AND startswith(schema_of_variant(value), 'OBJECT')")
    read = lambda path, kind: F.try_variant_get("value", path, kind)
    return rows.select(
        *keys,
        F.col("pos").cast("bigint").alias("pos"),
        read("$.sku", "string").alias("sku"),
        F.coalesce(read("$.display_price", "double"), read("$.price", "double")).alias("price"),
        read("$.display_regular_price", "double").alias("regular_price"),
        read("$.is_in_stock", "boolean").alias("in_stock"),
        read("$.attributes", "map<string,string>").alias("options"),
    )


def names_brand(breadcrumb: Column, brand: Column) -> Column:
    """False for a page whose breadcrumb exists and does not name the brand."""
    return (breadcrumb == "") | F.lower(breadcrumb).contains(F.lower(brand))


def description(tab_text: Column, short_text: Column) -> Column:
    return text.filled(tab_text, short_text)
