"""CSV exports to the raw sheet layer, however many files and header lines there are.

Rows of all files come from one scan of lines that Spark splits anywhere; a line is cut into cells by
``from_csv`` under the widest header, then to its own file's width. Headers are a table with one row per
file that the rows are joined to by path.

A cell in quotes may hold line breaks. What a line does to "inside quotes" depends only on the line:
``opens`` says where it ends if it starts outside, ``stays`` if it starts inside. A file in which no line
opens has a record per line, which one aggregate finds out. The lines of the others are written with
their block and place; lines follow each other within a block first, then blocks within a file (one row
per block), so a large file is never in one task. Line breaks within a cell are read as ``\\n``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyshelf import session
from tallyshelf.functions.text import NA_TOKENS
from tallyshelf.sources.workbook import RAW_TYPE

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
_OPENS = rf'^{_FIELDS}"{_QUOTED}$'
_STAYS = rf'^{_QUOTED}(?:"[^,]*+,{_FIELDS}"{_QUOTED})?+$'
#: Between cells of the scan of whole lines: nothing that a line holds.
_NO_SEPARATOR = "\x01\uffff\x01"
_MARK = "\x01"
_PARSING = {"escape": '"'}


def _opens(line: Column) -> Column:
    return F.contains(line, F.lit('"')) & line.rlike(_OPENS)


def _stays(line: Column) -> Column:
    return ~F.contains(line, F.lit('"')) | line.rlike(_STAYS)


def _cells(line: Column, width: int) -> Column:
    row = F.from_csv(line, ", ".join(f"c{i} STRING" for i in range(width)), _PARSING)
    return F.array(*(row[f"c{i}"] for i in range(width)))


def unique_names(shown: Column) -> Column:
    """Header texts as column names: blanks numbered, repeats suffixed by the first number that is free."""
    based = F.transform(shown, lambda c, i: F.when(c.isNull() | (c == ""), F.concat(F.lit("Unnamed: "), i)).otherwise(c))

    def add(names: Column, base: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(1), F.size(names) + 1), lambda n: F.concat_ws(".", base, n.cast("string")))
        free = F.filter(F.concat(F.array(base), numbered), lambda name: ~F.array_contains(names, name))
        return F.concat(names, F.array(F.get(free, F.lit(0))))

    return F.aggregate(based, F.array().cast("array<string>"), add)


def _moved(before: Window, fixed: Column, end: Column) -> tuple[Column, Column]:
    """What the steps of a window come to, one after the other: whether the end no longer depends on the start, and the end.

    A step sets the state (``fixed``: to ``end``) or adds ``end`` to it, modulo 2.
    """
    turns = F.coalesce(F.sum(F.when(~fixed, end).otherwise(0)).over(before), F.lit(0))
    # Turns up to the last step that set the state count no more.
    reset = F.last(F.when(fixed, F.struct(end.alias("end"), F.col("turned").alias("turned"))), True).over(before)
    return reset.isNotNull(), F.pmod(F.coalesce(reset["end"], F.lit(0)) + turns - F.coalesce(reset["turned"], F.lit(0)), F.lit(2))


def _turned(steps: DataFrame, order: Window) -> DataFrame:
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("turned", F.sum(F.when(~F.col("fixed"), F.col("end")).otherwise(0)).over(upto))


def joined_lines(lines: DataFrame) -> DataFrame:
    """Records ``path, at, line`` of ``lines`` (path, block, nth, line), a record's lines joined by line breaks.

    Lines are dealt by block of a file; only one row per block meets the other blocks of its file, and only
    lines of records that have several are grouped.
    """
    opens, stays = F.col("opens").cast("int"), F.col("stays").cast("int")
    steps = lines.select("*", _opens(F.col("line")).alias("opens"), _stays(F.col("line")).alias("stays"))
    # Ends that are the same from both starts set the state; the others keep (0) or turn (1) it.
    steps = steps.select("path", "block", "nth", "line", (opens == stays).alias("fixed"), opens.alias("end"))
    within = Window.partitionBy("path", "block").orderBy("nth")
    fixed, end = _moved(within.rowsBetween(Window.unboundedPreceding, -1), F.col("fixed"), F.col("end"))
    own_fixed, own_end = _moved(within.rowsBetween(Window.unboundedPreceding, 0), F.col("fixed"), F.col("end"))
    steps = _turned(steps, within).select(
        "path", "block", "nth", "line", fixed.alias("was_fixed"), end.alias("was"),
        own_fixed.alias("own_fixed"), own_end.alias("own_end"),
    )
    steps = session.written(steps, "csv-steps")

    along = Window.partitionBy("path").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max_by(F.struct(F.col("own_fixed").alias("fixed"), F.col("own_end").alias("end")), "nth").alias("last")
    blocks = _turned(steps.groupBy("path", "block").agg(last).select("path", "block", "last.*"), along)
    blocks = blocks.select("path", "block", _moved(earlier, F.col("fixed"), F.col("end"))[1].alias("entered"))
    state = F.when(F.col("was_fixed"), F.col("was")).otherwise(F.pmod(F.col("was") + F.col("entered"), F.lit(2)))
    place = F.struct("block", "nth")
    begun = steps.join(blocks, ["path", "block"]).select("path", "block", "nth", "line", F.when(state == 0, place).alias("start"))
    begun = session.written(begun, "csv-starts")

    latest = begun.groupBy("path", "block").agg(F.max("start").alias("latest"))
    latest = latest.select("path", "block", F.last("latest", True).over(earlier).alias("open"))
    own = F.last("start", True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    records = begun.withColumn("own", own).join(latest, ["path", "block"])
    records = records.select("path", F.coalesce("own", "open").alias("at"), place.alias("place"), "line")
    parts = F.sort_array(F.collect_list(F.struct("place", "line")))
    return records.groupBy("path", "at").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("line"))


def csv_rows(spark: SparkSession, location: str | Sequence[str], line_breaks: bool = True) -> DataFrame:
    """Raw sheet layer of CSV exports; every file is read under its own first record.

    Blank lines are left out, a row shorter than its header is filled with NULL, a longer one is cut. With
    ``line_breaks=False`` every line is a record. A quote that is never closed runs to the end of its file. The files are looked through once when this is called.
    """
    path = F.col("_metadata.file_path").alias("path")
    block = F.col("_metadata.file_block_start").alias("block")
    lines = spark.read.text(location).select(path, block, F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))
    bom = F.when(F.col("block") == 0, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line"))
    lines = lines.select("path", "block", "nth", bom.alias("line"))
    filled = lines.filter(F.trim("line") != "")
    broken = F.bool_or(_opens(F.col("line"))) if line_breaks else F.lit(False)
    files = filled.groupBy("path").agg(F.min_by("line", F.struct("block", "nth")).alias("line"), broken.alias("broken"))
    files = session.written(files, "csv-files")
    none = F.lit(None).cast("struct<block:bigint,nth:bigint>")
    plain, records = files.filter("NOT broken"), None
    if files.filter("broken").limit(1).count():
        of_broken = lines.join(files.filter("broken").select("path"), "path", "left_semi")
        records = session.written(joined_lines(session.written(of_broken, "csv-lines")).filter(F.trim("line") != ""), "csv-records")
        firsts = records.groupBy("path").agg(F.min("at").alias("first"), F.min_by("line", "at").alias("line"))
        plain = plain.select("path", none.alias("first"), "line").unionByName(firsts)
    else:
        plain = plain.select("path", none.alias("first"), "line")
    # A header has one cell more than separators at most; the mark behind its last cell tells how many.
    most = plain.agg(F.max(F.regexp_count("line", F.lit(",")) + 1)).first()[0]
    if most is None:
        return spark.createDataFrame([], RAW_TYPE)
    marked = _cells(F.concat("line", F.lit(f",{_MARK}")), most + 1)
    heads = plain.select(F.col("path").alias("file"), "first", marked.alias("marked"))
    own = F.slice("marked", 1, F.greatest(F.array_position("marked", F.lit(_MARK)) - 1, F.lit(1)).cast("int"))
    heads = session.written(heads.select("file", "first", unique_names(own).alias("header")), "csv-headers")
    width = heads.agg(F.max(F.size("header"))).first()[0]

    if session.fits_broadcast(heads):
        heads = F.broadcast(heads)  # else both sides are sorted by file

    # The reader leaves out blank lines and each file's first line.
    whole = spark.read.schema("line STRING").options(header=True, sep=_NO_SEPARATOR, quote="").csv(location)
    found = whole.select(path, "line").join(heads.filter("first IS NULL"), F.col("path") == F.col("file"))
    found = found.select("path", "header", "line")
    if records is not None:
        later = records.join(heads, F.col("path") == F.col("file")).filter(F.col("at") > F.col("first"))
        found = found.unionByName(later.select("path", "header", "line"))
    found = found.select("path", "header", F.slice(_cells(F.col("line"), width), F.lit(1), F.size("header")).alias("cells"))
    cells = F.transform("cells", lambda c: F.when(~c.isin(*NA_TOKENS), c))
    return found.select("path", "header", cells.alias("cells")).select(
        "path",
        F.lit("csv").alias("sheet"),
        F.lit(0).alias("sheet_pos"),
        F.lit(1).alias("row_idx"),
        "header",
        "cells",
        F.transform("cells", lambda c: F.when(c.isNull(), "e").otherwise("s")).alias("kinds"),
        F.lit(None).cast("string").alias("error"),
    )
