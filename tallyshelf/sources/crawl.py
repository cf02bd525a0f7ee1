"""Landed crawl pages: crawl plan, attempt resolution and readable-page scan.

Page tables carry ``page_no`` and ``html``; an absent row, NULL and empty ``html`` all mean
that there is no page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def within(number: Column, cap: int | None) -> Column:
    """From 1 up to ``cap``; without a cap every number from 1 on."""
    return number >= 1 if cap is None else number.between(1, cap)


def category_seeds(spark: SparkSession, slugs: Sequence[str]) -> DataFrame:
    """``rank, category`` in the order in which collections are visited."""
    rows = [{"rank": rank, "category": slug} for rank, slug in enumerate(slugs, start=1)]
    return _inline(spark, rows)


def brand_seeds(spark: SparkSession, start_urls: dict[str, str]) -> DataFrame:
    """``brand_rank, brand, start_url`` in the order in which brands are visited."""
    rows = [
        {"brand_rank": rank, "brand": brand, "start_url": url}
        for rank, (brand, url) in enumerate(start_urls.items(), start=1)
    ]
    return _inline(spark, rows)


def _inline(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Rows as literals of the plan, so their small size is known and they are broadcast."""
    structs = [F.struct(*[F.lit(v).alias(name) for name, v in row.items()]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def crawl_plan(seeds: DataFrame, base_url: Column | str, pages: int) -> DataFrame:
    """One row per page address to fetch: every seed category times pages 1..``pages``."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    address = F.format_string("%s/collections/%s?page=%d", base, F.col("category"), F.col("page_no"))
    return seeds.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.lit(pages)))).withColumn(
        "page_url", address
    )


def is_html_response(status: Column, content_type: Column) -> Column:
    return (status == 200) & F.coalesce(content_type, F.lit("")).contains("text/html")


def resolve_attempts(
    attempts: DataFrame, keys: Sequence[str] = ("url",), max_attempts: int | None = None
) -> DataFrame:
    """The attempt that yields the page of each address; addresses without one are absent.

    Attempts above ``max_attempts`` do not count; by default all do.
    The first usable attempt wins unless a client error came before it. A usable first
    attempt cannot have been preceded by anything, so those rows - nearly all of a healthy
    crawl, and all of its HTML volume - pass straight through. Only retries meet the narrow
    list of earlier outcomes.
    """
    attempts = attempts.filter(within(F.col("attempt"), max_attempts))
    usable = is_html_response(F.col("status"), F.col("content_type"))
    decisive = usable | F.col("status").between(400, 499)
    direct = attempts.filter(usable & (F.col("attempt") == 1))
    retried = attempts.filter(usable & (F.col("attempt") > 1))
    decided = (
        attempts.filter(decisive)
        .groupBy(*keys)
        .agg(F.min("attempt").alias("_decided_at"))
    )
    same = [retried[k] == decided[k] for k in keys]
    waiting = retried.join(decided, [*same, F.col("_decided_at") < retried["attempt"]], "left_anti")
    return direct.unionByName(waiting)


def page_present(html: Column) -> Column:
    return F.coalesce(F.length(html) > 0, F.lit(False))
