"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs (rendered pages, exported sheets, workbooks) are landed first and not timed; a timed
run is a whole job from landed files to its last row. Each job runs once to warm up and the
median of three more runs is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, functions as F

from tallyshelf import registry, session
from tallyshelf.plans import catalogue, ledger, phones
from tallyshelf.registry import rendered_pages as rp, rendered_sheets as rs
from tallyshelf.registry.tables import RUN_TS
from tallyshelf.sources import workbook

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session.local_session(CPUS, "bench")
    spark.conf.set("spark.sql.shuffle.partitions", CPUS)
    spark.sparkContext.setLogLevel("OFF")
    # A file of small pages is one unit of work, so they lie in as many files as there are cores.
    land = lambda df, name: session.written(df, f"bench-{name}", files=int(CPUS))

    shop_pages, shop_seeds = land(rp.collection_pages(spark, SF_DIR), "shop"), rp.category_seeds(spark)
    listings, brand_seeds = land(rp.brand_pages(spark, SF_DIR), "listings"), rp.brand_seeds(spark, SF_DIR)
    products = land(rp.product_pages(spark, SF_DIR), "products")
    order_sheet, stock_sheet = rs.order_sheet(spark, SF_DIR), rs.stock_sheet(spark, SF_DIR)
    details, bills = rs.detail_sheets(spark, SF_DIR), rs.bill_sheets(spark, SF_DIR)
    books = land(rs.workbooks(spark, SF_DIR), "books")

    site, brand = ("site", "category"), ("site", "brand")
    found = lambda: phones.brand_product_urls(listings, brand_seeds, brand)
    jobs = {
        "catalogue_snapshot": lambda: catalogue.catalogue_snapshot(shop_pages, shop_seeds, F.col("site"), RUN_TS, site),
        "brand_product_urls": found,
        "phone_snapshot": lambda: phones.phone_snapshot(found(), products, RUN_TS),
        "completed_orders": lambda: ledger.completed_orders(order_sheet, "shop", land=False),
        "stock": lambda: ledger.stock(stock_sheet, "shop", RUN_TS),
        "weekly_bill_details": lambda: ledger.weekly_statements(ledger.statement_rows(details), land=False)["bill details"],
        "weekly_bill": lambda: ledger.weekly_statements(ledger.statement_rows(bills), land=False)["bill"],
        "workbook_decode": lambda: workbook.decoded(books, ["lines"]),
        **{
            name: (lambda fn: lambda: fn(spark, SF_DIR))(registry.QUERIES[name])
            for name in ("page_heading", "absolute_url", "cross_page_dedupe", "prefix_stop", "brand_first_wins", "crawl_attempts")
        },
    }
    units = {
        "catalogue_snapshot": ("pages", shop_pages.count()),
        "brand_product_urls": ("pages", listings.count()),
        "phone_snapshot": ("pages", listings.count() + products.count()),
        "completed_orders": ("rows", order_sheet.count()),
        "weekly_bill_details": ("rows", details.count()),
        "workbook_decode": ("workbooks", books.count()),
    }

    seconds = {}
    for name, job in jobs.items():
        finish(job())
        taken = []
        for _ in range(RUNS):
            started = time.perf_counter()
            finish(job())
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    rates = {name: f"{round(n / seconds[name])} {unit}/s" for name, (unit, n) in units.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline jobs (median of three runs each)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rates": rates,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
