"""Columns of many differently headed sheets to one declared, typed table.

Rows come from the raw sheet layer (``header``, ``cells``, ``kinds``). Header rows lie in a dictionary
of their own, keyed by ``layout``; rows carry that key only. The driver sees one row per different
column name, as many as the result has columns; cell values never leave the executors. Names stay
ordinals into ``cells`` until they are final, because raw headers may differ in case only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tallyshelf import session
from tallyshelf.functions import text, typed


_FINANCE_NAME = str.maketrans({" ": "_", ".": None, "(": "_", ")": None, "（": "_", "）": None})


def clean_header(name: object) -> str:
    """Finance header: blanks and opening brackets to ``_``, dots and closing ones dropped."""
    return str(name).strip().translate(_FINANCE_NAME).lower()


def clean_header_column(c: Column) -> Column:
    return F.lower(F.translate(text.strip(c), " (（.)）", "___"))


def snake_header(name: str, overrides: dict[str, str] | None = None) -> str:
    if overrides and name in overrides:
        return overrides[name]
    words = re.sub(r"[^\w\s]+", " ", name).split()
    return "_".join(words).lower()


def snake_columns(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({c: snake_header(c, overrides) for c in df.columns})


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Exact, case-sensitive presence test on a frame's own columns."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def required_headers(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same test on a raw layer: a sheet lacking a name fails the job that reads it.

    Checked in the pass that types the rows, header rows included, so there is no extra scan
    and no table is replaced before the check has passed.
    """
    lacking = F.array_except(F.array(*[F.lit(n) for n in names]), "header")
    message = F.concat(F.lit("missing columns in "), "path", F.lit(": "), F.array_join(lacking, ", "))
    return rows.filter(F.when(F.size(lacking) > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def cell(name: str, values: str = "cells") -> Column:
    """Value under one raw header; NULL where the row's sheet does not have it."""
    at = F.array_position("header", F.lit(name)).cast("int") - 1
    return F.get(F.col(values), at)


def positional_cell(index: int, least: int) -> Column:
    """Value by position; a sheet with fewer than ``least`` columns fails the job."""
    short = F.concat(F.lit("sheet has too few columns: "), F.col("path"))
    return F.when(F.size("header") < least, F.raise_error(short).cast("string")).otherwise(
        F.get("cells", F.lit(index))
    )


@dataclass(frozen=True)
class Source:
    """Where a target column finds its cells: raw headers, in order of appearance."""

    name: str
    headers: tuple[str, ...]

    @property
    def loses_commas(self) -> bool:
        return "order" in self.name or "sn" in self.name


def layout_key() -> Column:
    """128 bits that name a header row."""
    return F.md5(F.array_join("header", "\x1f", "\x00"))


@dataclass(frozen=True)
class TabHeaders:
    """Raw column names of one tab in order of first appearance, and the number of its files."""

    raws: tuple[str, ...]
    files: int

    def sources(self, mode: str = "first") -> dict[str, Source]:
        """Cleaned name to source, in order of first appearance.

        ``first`` keeps the first of equal cleaned names and drops the others' values;
        ``coalesce`` falls through to them.
        """
        if mode not in ("first", "coalesce"):
            raise ValueError(f"mode must be 'first' or 'coalesce', not {mode!r}")
        merged: dict[str, list[str]] = {}
        for raw in self.raws:
            merged.setdefault(clean_header(raw), []).append(raw)
        return {
            name: Source(name, tuple(raws if mode == "coalesce" else raws[:1])) for name, raws in merged.items()
        }


@dataclass(frozen=True)
class Layouts:
    """The header dictionary ``tab, layout, header`` as a written table, and what each tab's headers come to."""

    table: DataFrame
    tabs: Mapping[str, TabHeaders]

    def places(self, tab: str, headers: Sequence[str]) -> DataFrame:
        """``layout, at``: for each of ``headers`` its place in the layout, -1 where it is missing."""
        wanted = F.array(*[F.lit(h) for h in headers]).cast("array<string>")
        at = F.transform(wanted, lambda h: F.array_position("header", h).cast("int") - 1)
        found = self.table.filter(F.col("tab") == tab).select("layout", at.alias("at"))
        return F.broadcast(found) if session.fits_broadcast(self.table) else found


def tab_layouts(rows: DataFrame) -> Layouts:
    """Header dictionary of all tabs at once, files taken in file-name order.

    Headers travel with data rows, so sheets without data do not count. Column pruning leaves
    this pass four columns, and its aggregates are reduced before they are shuffled.
    """
    per_file = rows.select("tab", "path", "layout", "header").distinct()
    first = F.min(F.struct(text.file_name(F.col("path")).alias("file"), "path")).alias("first")
    layouts = per_file.groupBy("tab", "layout", "header").agg(first, F.count("*").alias("files"))
    table = session.written(layouts, "layouts")
    spots = table.select("tab", "first", F.posexplode("header").alias("at", "raw"))
    spots = spots.groupBy("tab", "raw").agg(F.min(F.struct("first", "at")).alias("spot"))
    files = {r["tab"]: r["files"] for r in table.groupBy("tab").agg(F.sum("files").alias("files")).collect()}
    found: dict[str, list[tuple]] = {}
    for r in spots.collect():  # one row per different column name
        found.setdefault(r["tab"], []).append((r["spot"], r["raw"]))
    tabs = {tab: TabHeaders(tuple(raw for _, raw in sorted(own)), files[tab]) for tab, own in found.items()}
    return Layouts(table.select("tab", "layout", "header"), tabs)


def placed(rows: DataFrame, tab: str, layouts: Layouts, sources: Sequence[Source]) -> DataFrame:
    """Rows of one tab with ``at``: for every header of every source, its place in the row.

    Places are worked out once per header row. The dictionary is broadcast within the session's
    limit; beyond it there are tens of thousands of layouts, and rows are dealt by theirs.
    """
    places = layouts.places(tab, [h for s in sources for h in s.headers])
    return rows.filter(F.col("tab") == tab).drop("header").join(places, "layout")


def lookups(sources: Sequence[Source]) -> list[Column]:
    """Text and kind of every source as plain columns ``_t<i>`` and ``_k<i>``, from ``at``."""
    columns, n = [], 0
    for i, source in enumerate(sources):
        spots = [F.get("at", F.lit(n + j)) for j in range(len(source.headers))]
        n += len(spots)
        cells = [F.get("cells", spot) for spot in spots]
        if len(cells) > 1:
            cells = [text.na_to_null(c) for c in cells]
        columns.append(F.coalesce(*cells).alias(f"_t{i}"))
        kinds = [F.get("kinds", spot) for spot in spots]
        if len(kinds) > 1:
            kinds = [F.nullif(k, F.lit("e")) for k in kinds]
        columns.append(F.coalesce(*kinds).alias(f"_k{i}"))
    return columns


def trimmed(count: int) -> list[Column]:
    return [text.strip(text.na_to_null(F.col(f"_t{i}"))).alias(f"_t{i}") for i in range(count)]


def cleaned(sources: Sequence[Source]) -> list[Column]:
    """Trimmed text as the ledger sees it: nan words gone, order numbers without commas."""
    shown = []
    for i, source in enumerate(sources):
        c = text.null_text(F.col(f"_t{i}"))
        if source.loses_commas:
            c = text.strip_leading_commas(c)
        shown.append(c.alias(f"_t{i}"))
    return shown


def numbers(positions: Iterable[int]) -> list[Column]:
    return [typed.number_or_null(F.col(f"_t{i}")).alias(f"_d{i}") for i in positions]


def typed_column(
    at: int | None, field: StructField, on_fraction: str = "error", loses_commas: bool = True, day_first: bool = False
) -> Column:
    """A declared column from cleaned source ``at``; typed NULL when the tab lacks it."""
    if at is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c, kind = F.col(f"_t{at}"), F.col(f"_k{at}")
    match field.dataType:
        case DoubleType():
            c = F.col(f"_d{at}")
        case LongType():
            c = typed.whole_or_null(c, on_fraction, F.col(f"_d{at}"))
        case StringType():
            c = text.strip(c) if loses_commas else c  # other texts are trimmed already
        case DateType():
            c = typed.date_or_null(c, kind, day_first)
        case TimestampType():
            c = typed.stamp_or_null(c, kind, day_first)
        case TimestampNTZType():
            c = typed.stamp_or_null(c, kind, day_first).cast("timestamp_ntz")
        case BooleanType():
            c = typed.flag_or_null(c)
        case other:
            raise TypeError(f"no rule for {other}")
    return c.alias(field.name)


# What a cell can be, as bits that add up over the cells of a column.
MISSING, DATE, FLAG, FLAG_WORD, WHOLE, FRACTION, OTHER = (1 << i for i in range(7))
CLASSES = ("empty", "stamp", "flag", "whole", "real", "text")


def cell_bit(said: Column, kind: Column) -> Column:
    """The bit of one cell, given its text without missing tokens and its kind."""
    number = F.when(kind == "s", said.rlike(typed.NUMBER)).otherwise(kind == "n")
    d = said.try_cast("double")
    marked = F.when(kind == "n", d != F.floor(d)).otherwise(said.rlike(typed.FRACTIONAL_MARK))
    return (
        F.when(said.isNull() | (kind == "e"), MISSING)
        .when(kind == "d", DATE)
        .when(kind == "b", FLAG)
        .when(said.isin("True", "TRUE", "true", "False", "FALSE", "false"), FLAG_WORD)
        .when(~number, OTHER)
        .when(marked, FRACTION)
        .otherwise(WHOLE)
    )


def class_bit(bits: Column) -> Column:
    """What a reader of one file would call a column whose cells come to ``bits``, as the bit of its class."""
    only = lambda *kinds: bits.bitwiseAND(F.lit(~sum(kinds))) == 0
    has = lambda *kinds: bits.bitwiseAND(F.lit(sum(kinds))) != 0
    at = {name: 1 << i for i, name in enumerate(CLASSES)}
    return (
        F.when(only(MISSING), at["empty"])
        .when(only(MISSING, DATE), at["stamp"])
        .when(only(FLAG, FLAG_WORD), at["flag"])
        .when(only(MISSING, FLAG, WHOLE, FRACTION) & ~has(MISSING, FRACTION), at["whole"])
        .when(only(MISSING, FLAG, WHOLE, FRACTION), at["real"])
        .otherwise(at["text"])
    )


def combined_type(classes: set[str], complete: bool) -> str:
    """Type name of a column over all files: ``classes`` seen, and whether no file lacks it."""
    solid = complete and "empty" not in classes
    seen = classes - {"empty"}
    if "text" in seen or ("stamp" in seen and len(seen) > 1):
        return "STRING"
    if "stamp" in seen:
        return "TIMESTAMP"
    if "flag" in seen:
        if not solid or "real" in seen:
            return "STRING"
        return "BIGINT" if "whole" in seen else "BOOLEAN"
    return "BIGINT" if seen == {"whole"} and solid else "DOUBLE"


@dataclass(frozen=True)
class Findings:
    """What one pass over the cells tells of a tab: types of undeclared columns, time columns with the day first."""

    types: Mapping[str, str]
    day_first: frozenset[str]


def file_classes(
    rows: DataFrame, tab: str, layouts: Layouts, extras: Sequence[Source], times: Sequence[Source], width: tuple[int, int]
) -> DataFrame:
    """``tab, path`` of each file of a tab, class bits ``x0``, ``x1`` ... and format masks ``t0`` ..., padded to ``width``.

    The bits of a row's cells are added up per file as they are read; no cell is moved. A column
    that the file lacks has NULL.
    """
    found = placed(rows, tab, layouts, [*extras, *times])
    # Looked up in one projection, cleaned in the next, so a cell's text is produced once however often it is looked at.
    n, columns, looked_up, cleaned_up = 0, [], [], []
    for i, source in enumerate([*extras, *times]):
        masks = []
        for _ in source.headers:
            spot = F.get("at", F.lit(n))
            said, kind, spot_name = f"_t{n}", f"_k{n}", f"_s{n}"
            looked_up.append(F.get("cells", spot).alias(said))
            if i >= len(extras):
                cleaned_up.append(text.na_to_null(F.col(said)).alias(said))
                masks.append(typed.order_mask(text.strip(F.col(said))))
            else:
                looked_up += [F.get("kinds", spot).alias(kind), spot.alias(spot_name)]
                cleaned_up += [text.na_to_null(F.col(said)).alias(said), kind, spot_name]
                masks.append(F.when(F.col(spot_name) >= 0, cell_bit(F.col(said), F.col(kind))))
            n += 1
        columns.append(masks)
    found = found.select("path", *looked_up).select("path", *cleaned_up)
    added = lambda masks: reduce(lambda a, b: F.coalesce(a.bitwiseOR(b), a, b), masks)
    kept = lambda masks: reduce(lambda a, b: a.bitwiseAND(b), masks)
    narrow = found.select(
        "path",
        *[added(m).alias(f"x{i}") for i, m in enumerate(columns[: len(extras)])],
        *[kept(m).alias(f"t{i}") for i, m in enumerate(columns[len(extras) :])],
    )
    none = F.lit(None).cast("int")
    sums = [(F.bit_or(f"x{i}") if i < len(extras) else F.first(none)).alias(f"x{i}") for i in range(width[0])]
    sums += [(F.bit_and(f"t{i}") if i < len(times) else F.first(none)).alias(f"t{i}") for i in range(width[1])]
    files = narrow.groupBy("path").agg(*sums) if sums else narrow.select("path").distinct()
    classes = [class_bit(F.col(f"x{i}")) for i in range(width[0])]
    known = [F.when(F.col(f"x{i}").isNotNull(), c).alias(f"x{i}") for i, c in enumerate(classes)]
    return files.select(F.lit(tab).alias("tab"), "path", *known, *[f"t{i}" for i in range(width[1])])


def findings(
    rows: DataFrame, layouts: Layouts, extras: Mapping[str, Sequence[Source]], times: Mapping[str, Sequence[Source]]
) -> dict[str, Findings]:
    """Types of undeclared columns and the order of day and month in time columns, of all tabs in one pass.

    One row per tab comes to the driver.
    """
    asked = [tab for tab in layouts.tabs if extras.get(tab) or times.get(tab)]
    if not asked:
        return {}
    width = (max(len(extras.get(t, ())) for t in asked), max(len(times.get(t, ())) for t in asked))
    files = [file_classes(rows, t, layouts, list(extras.get(t, ())), list(times.get(t, ())), width) for t in asked]
    sums = [f(f"x{i}").alias(f"{name}{i}") for i in range(width[0]) for name, f in (("seen", F.bit_or), ("having", F.count))]
    sums += [F.bit_and(f"t{i}").alias(f"t{i}") for i in range(width[1])]
    out = {}
    for r in reduce(DataFrame.unionByName, files).groupBy("tab").agg(*sums).collect():
        tab = r["tab"]
        types = {}
        for i, source in enumerate(extras.get(tab, ())):
            seen = {name for k, name in enumerate(CLASSES) if (r[f"seen{i}"] or 0) >> k & 1}
            types[source.name] = combined_type(seen, r[f"having{i}"] == layouts.tabs[tab].files)
        first = frozenset(s.name for i, s in enumerate(times.get(tab, ())) if r[f"t{i}"] == typed.DAY_FIRST)
        out[tab] = Findings(types, first)
    return out


def extra_column(at: int, source: Source, type_name: str) -> Column:
    c, kind = F.col(f"_t{at}"), F.col(f"_k{at}")
    truth = F.lower(c) == "true"
    match type_name:
        case "BIGINT":
            c = F.when(kind == "b", truth.cast("bigint")).otherwise(typed.whole_or_null(c, "error", F.col(f"_d{at}")))
        case "DOUBLE":
            c = F.when(kind == "b", truth.cast("double")).otherwise(F.col(f"_d{at}"))
        case "TIMESTAMP":
            c = typed.stamp_or_null(c)
        case "BOOLEAN":
            c = truth
    return c.alias(source.name)


def fit(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns only, in declared order and type; unknown columns are ignored."""
    return df.select(*[c for c in schema.names if c in df.columns]).to(schema)
