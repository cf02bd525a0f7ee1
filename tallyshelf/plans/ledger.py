"""Marketplace exports to typed ledger tables: completed orders, stock, weekly statements.

All three are narrow: rows go from raw cells to typed columns without a shuffle. The weekly
statements add two schema-sized aggregates (header dictionary; types of undeclared columns and
orders of time columns).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from tallyshelf import session
from tallyshelf.functions import text, typed
from tallyshelf.operators import align
from tallyshelf.plans.schemas import (
    COMPLETED_ORDERS,
    STATEMENT_SCHEMAS,
    STOCK,
    STOCK_HEADERS,
)


def data_rows(raw: DataFrame) -> DataFrame:
    return raw.filter("error IS NULL AND row_idx > 0")


def _typed(
    c: Column,
    field: StructField,
    numbers: dict[str, Callable[[Column], Column]],
    kind: Column | None,
    day_first: bool = False,
) -> Column:
    match field.dataType.simpleString():
        case "string":
            pass
        case "timestamp":
            c = typed.stamp_or_null(c, kind, day_first)
        case number:
            c = numbers[number](c)
    return c.alias(field.name)


def completed_orders(raw: DataFrame, shop_name: str, land: bool = True) -> DataFrame:
    """Order history by column position; surplus columns are cut, too few fail the job.

    Whether a time column puts the day first is found out by one pass over the time columns
    when this is called, so the cells are landed first and the input is read once; ``land=False``
    is for sheets that lie in a table already. Cells are looked up in one projection and converted in the next, so a cell's text is
    produced once however often its conversion looks at it.
    """
    named = [f for f in COMPLETED_ORDERS.fields if f.name != "shop_name"]
    looked_up = []
    for i, field in enumerate(named):
        c = text.na_to_null(align.positional_cell(i, len(named)))
        looked_up.append((text.null_text(c) if field.dataType == StringType() else c).alias(field.name))
    strict = {"bigint": typed.whole_or_fail, "double": typed.number_or_fail}
    rows = data_rows(raw).select("kinds", *looked_up)
    if land:
        rows = session.written(rows, "order-cells")
    times = {f.name: F.col(f.name) for f in named if f.dataType.simpleString() == "timestamp"}
    order = typed.day_first_columns(rows, times)
    columns = [_typed(F.col(f.name), f, strict, F.get("kinds", F.lit(i)), order.get(f.name, False)) for i, f in enumerate(named)]
    return rows.select(*columns, F.lit(shop_name).alias("shop_name")).to(COMPLETED_ORDERS)


def stock(
    raw: DataFrame, shop_name: str, run_ts: dt.datetime | str | None = None, on_fraction: str = "error"
) -> DataFrame:
    """Stock list by header; every sheet must have all ten columns, extras are dropped."""
    raw = align.required_headers(raw.filter("error IS NULL"), list(STOCK_HEADERS))
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    rows = data_rows(raw).select(*[text.na_to_null(align.cell(h)).alias(n) for h, n in STOCK_HEADERS.items()])
    coercing = {"bigint": lambda c: typed.whole_or_null(c, on_fraction), "double": typed.number_or_null}
    columns = [_typed(F.col(n), STOCK[n], coercing, None) for n in STOCK_HEADERS.values()]
    return rows.select(*columns, stamp.alias("updated_at_ts"), F.lit(shop_name).alias("shop_name")).to(STOCK)


def statement_rows(raw: DataFrame) -> DataFrame:
    """Data rows with ``tab`` and ``layout``; a raw layer read by tab already holds one sheet per tab.

    A raw layer that was landed with its ``layout`` keeps it.
    """
    name = F.lower(text.strip(F.col("sheet")))
    layout = F.col("layout") if "layout" in raw.columns else align.layout_key()
    return data_rows(raw).withColumns({"tab": name, "layout": layout})


def weekly_statements(
    rows: DataFrame,
    schemas: Mapping[str, StructType] = STATEMENT_SCHEMAS,
    mode: str = "first",
    on_fraction: str = "error",
    land: bool = True,
) -> dict[str, DataFrame]:
    """One frame per tab that has data: declared columns, then undeclared ones.

    ``rows`` are statement rows with ``tab``. Tabs are independent: each frame fails or
    succeeds when it is written. Rows are read by two small aggregates and once per tab, so
    they are landed first, by tab; ``land=False`` is for rows that lie in a table already.
    """
    rows = rows.filter(F.col("tab").isin(*schemas))
    if land:
        landed = rows.select("tab", "path", "layout", "header", "cells", "kinds")
        rows = session.written(landed, "statement-rows", ["tab"], codec="zstd")
    layouts = align.tab_layouts(rows)
    sources = {tab: found.sources(mode) for tab, found in layouts.tabs.items()}
    extras = {
        tab: [s for name, s in found.items() if name not in schemas[tab].names] for tab, found in sources.items()
    }
    is_time = lambda f: isinstance(f.dataType, (DateType, TimestampType)) and f.name not in LINEAGE_COLUMNS
    times = {
        tab: [found[f.name] for f in schemas[tab].fields if is_time(f) and f.name in found] for tab, found in sources.items()
    }
    told = align.findings(rows, layouts, extras, times)

    frames = {}
    for tab in schemas:
        if tab in layouts.tabs:
            own = told.get(tab, align.Findings({}, frozenset()))
            frames[tab] = _statement(rows, tab, layouts, schemas[tab], sources[tab], own, on_fraction)
    return frames


LINEAGE_COLUMNS = ("source_filename", "statement_start_date", "statement_end_date")


def _statement(
    rows: DataFrame,
    tab: str,
    layouts: align.Layouts,
    schema: StructType,
    sources: Mapping[str, align.Source],
    told: align.Findings,
    on_fraction: str,
) -> DataFrame:
    """Typed rows of one tab: look cells up, clean the texts, read numbers, convert.

    Separate projections, because each step reads the previous one's result several times.
    """
    lineage = [
        F.col("_file").alias("source_filename"),
        F.when(F.col("_day1").isNotNull(), F.col("_day0")).alias("statement_start_date"),
        F.when(F.col("_day0").isNotNull(), F.col("_day1")).alias("statement_end_date"),
    ]
    own, extras = LINEAGE_COLUMNS, told.types
    used = [s for n, s in sources.items() if n not in own and (n in schema.names or n in extras)]
    at = {s.name: i for i, s in enumerate(used)}
    kinds = [f"_k{i}" for i in range(len(used))]
    texts = [f"_t{i}" for i in range(len(used))]
    numeric = {f.name for f in schema.fields if isinstance(f.dataType, (DoubleType, LongType))}
    numeric |= {n for n, t in extras.items() if t in ("BIGINT", "DOUBLE")}

    found = align.placed(rows, tab, layouts, used)
    found = found.select(text.file_name(F.col("path")).alias("_file"), *align.lookups(used))
    found = found.select("_file", F.split("_file", "_").alias("_parts"), *kinds, *align.trimmed(len(used)))
    days = [F.get("_parts", F.lit(i)).alias(f"_day{i}") for i in range(2)]
    found = found.select("_file", *days, *kinds, *align.cleaned(used))
    days = [text.named_day(F.col(f"_day{i}")).alias(f"_day{i}") for i in range(2)]
    found = found.select("_file", *days, *kinds, *texts, *align.numbers(at[n] for n in at if n in numeric))
    declared = [
        align.typed_column(at.get(f.name), f, on_fraction, f.name in at and sources[f.name].loses_commas, f.name in told.day_first)
        for f in schema.fields
        if f.name not in own
    ]
    added = [align.extra_column(at[n], sources[n], t) for n, t in extras.items() if n not in own]
    return found.select(*lineage, *declared, *added)
