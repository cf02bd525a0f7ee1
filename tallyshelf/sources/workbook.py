"""Exported workbooks (xlsx) to the raw sheet layer.

One output row per sheet row: ``path, sheet, sheet_pos, row_idx, header, cells, kinds, error``.
``row_idx`` 0 repeats the header; every row carries its sheet's header, so later steps find a
cell by name without a join. Cells are text; ``kinds`` says what each was: ``s`` text,
``n`` number, ``d`` date, ``b`` boolean, ``e`` missing.

Spark hands out files to tasks. A workbook cannot be split, but the format limits a sheet to
1,048,576 rows, and rows leave the task in bounded batches while the sheet is read.
"""

from __future__ import annotations

import codecs
import datetime as dt
import io
import marshal
import re
import tempfile
import warnings
import zipfile
from collections.abc import Iterator, Sequence
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType
from pyspark.sql.utils import AnalysisException

from tallyshelf.functions import text
from tallyshelf.functions.text import NA_TOKENS

RAW_TYPE = (
    "path STRING, sheet STRING, sheet_pos INT, row_idx INT, header ARRAY<STRING>, "
    "cells ARRAY<STRING>, kinds ARRAY<STRING>, error STRING"
)
_BATCH = 2000
# A sheet's rows are kept in memory up to this many bytes and on disk beyond, until it is read to its end.
_SPOOL = 16 * 1024 * 1024
_CHUNK = 64 * 1024
_NO_ATTRS: dict[str, str] = {}
_MISSING = frozenset(NA_TOKENS)

# Built-in number formats that show a date or time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_NOT_DATE_LETTERS = re.compile(r'"[^"]*"|\[[^\]]*\]|\\.')


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column(ref: str) -> int:
    at = 0
    for ch in ref:
        if not ch.isalpha():
            break
        at = at * 26 + ord(ch.upper()) - 64
    return at - 1


# Rows as nearly all writers spell them. Whatever is spelled otherwise is read by the parser's events.
_ATTRS = r"""((?:\s[\w:.-]+="[^"<&\t\n]*")*)\s?"""
_CELL = rf"""<c{_ATTRS}(?:/>|>(?:<v>([^<]*)</v>|<is><t(?:\sxml:space="preserve")?>([^<]*)</t></is>)?</c>)"""
_CELLS = re.compile(_CELL)
_ROW = re.compile(rf"<row{_ATTRS}(?:/>|>((?:{_CELL.replace('(', '(?:').replace('(?:?:', '(?:')})*)</row>)")
_NAMED = re.compile(r'\s([\w:.-]+)="([^"]*)"')
_HEAD = re.compile(r'\ufeff?(?:<\?xml[^<>]*\?>\s*)?<worksheet(?=[\s>])[^<>]*\sxmlns="[^"]+"')
_OTHER_CODE = re.compile(r"""\sencoding=["'](?!utf-8["'])""", re.I)
_REFERENCE = re.compile(r"&(#x?[0-9a-fA-F]+|\w+);")
_NAMED_CHARS = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


class _Irregular(Exception):
    """A sheet whose rows are not spelled as ``_ROW`` has them."""


@lru_cache(4096)
def _attributes(raw: str) -> dict[str, str]:
    if "xmlns" in raw:
        raise _Irregular
    return dict(_NAMED.findall(raw))


@lru_cache(65536)
def _day_text(epoch: dt.datetime, days: float) -> str:
    return (epoch + dt.timedelta(microseconds=round(days * 86_400_000) * 1000)).isoformat(" ")


def _referred(match: re.Match) -> str:
    name = match.group(1)
    if name[0] != "#":
        return _NAMED_CHARS[name]
    return chr(int(name[2:], 16) if name[1] == "x" else int(name[1:]))


@lru_cache(4096)
def _unreferred(text: str) -> str:
    return _REFERENCE.sub(_referred, text)


def _all_text(element) -> str:
    """Joined ``t`` texts, phonetic hints left out."""
    parts = []
    for child in element:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.append(_all_text(child))
    return "".join(parts)


class _Book:
    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        book = self._xml("xl/workbook.xml")
        targets = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels")}
        self.sheets: list[tuple[str, str]] = []
        self.epoch = dt.datetime(1899, 12, 30)
        for part in book.iter():
            if _local(part.tag) == "sheet":
                rel = next(v for k, v in part.attrib.items() if _local(k) == "id")
                target = targets[rel]
                self.sheets.append((part.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
            elif _local(part.tag) == "workbookPr" and part.get("date1904") in ("1", "true"):
                self.epoch = dt.datetime(1904, 1, 1)
        names = set(self.zip.namelist())
        self.strings = (
            [_all_text(si) for si in self._xml("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        )
        self.date_styles = self._date_styles() if "xl/styles.xml" in names else frozenset()

    def _xml(self, name: str):
        return ElementTree.fromstring(self.zip.read(name))

    def _date_styles(self) -> frozenset:
        styles, own, dated = self._xml("xl/styles.xml"), {}, []
        for part in styles.iter():
            if _local(part.tag) == "numFmt":
                code = _NOT_DATE_LETTERS.sub("", part.get("formatCode") or "").lower()
                own[int(part.get("numFmtId"))] = any(ch in code for ch in "ymdhs")
            elif _local(part.tag) == "cellXfs":
                ids = [int(xf.get("numFmtId") or 0) for xf in part]
                dated = [i for i, f in enumerate(ids) if own.get(f, f in _DATE_FORMATS)]
        return frozenset(str(i) for i in dated)

    def _cell(self, kind: str, style: str | None, value: str | None, inline: str | None) -> tuple[str | None, str]:
        if kind == "inlineStr":
            return inline or "", "s"
        if value is None:
            return None, "e"
        if kind == "s":
            return self.strings[int(value)], "s"
        if kind == "str":
            return value, "s"
        if kind == "b":
            return ("True" if value in ("1", "true") else "False"), "b"
        if kind == "e":
            return None, "e"
        if kind == "d":
            return value.replace("T", " "), "d"
        dated = style in self.date_styles
        if not dated and len(value) < 18 and value.isascii() and value.isdigit():
            return value, "n"
        number = float(value)
        if dated:
            return _day_text(self.epoch, number), "d"
        if number.is_integer() and abs(number) < 1e18:
            digits = value if value.lstrip("-").isdigit() else str(int(number))
            return digits, "n"
        return repr(number), "n"

    def regular_rows(self, member: str) -> Iterator[tuple[int, list, list, bool]]:
        """What ``rows`` gives, for a sheet of regular markup; ``_Irregular`` for others, whose rows so far do not count.

        Rows are cut by patterns, the parser only proves that the sheet is well formed to its end.
        """
        proof = expat.ParserCreate(namespace_separator="}")
        decoder = codecs.getincrementaldecoder("utf-8")()
        text, in_data, ended, number = "", False, False, -1
        with self.zip.open(member) as source:
            chunk = b" "
            while chunk:
                chunk = source.read(_CHUNK)
                try:
                    proof.Parse(chunk, not chunk)
                except expat.ExpatError as problem:
                    raise ElementTree.ParseError(str(problem)) from None
                if ended:
                    continue
                if b"\r" in chunk:
                    raise _Irregular
                try:
                    text += decoder.decode(chunk, not chunk)
                except UnicodeDecodeError:
                    raise _Irregular from None
                at = 0
                if not in_data:
                    at = text.find("<sheetData>")
                    if at < 0:
                        if not chunk:
                            raise _Irregular
                        continue
                    head = text[:at]
                    own = _HEAD.match(head) and head.count("xmlns=") == 1 and "<!" not in head
                    if not own or _OTHER_CODE.search(head) or re.search(r"[<:]row[\s/>]", head):
                        raise _Irregular
                    at, in_data = at + len("<sheetData>"), True
                while found := _ROW.match(text, at):
                    at = found.end()
                    named, cells = _attributes(found[1]), found[2]
                    number = int(named["r"]) - 1 if named.get("r") else number + 1
                    yield number, *self._regular_cells(cells)
                text = text[at:]
                ended = text.startswith("</sheetData>")
                if not ended and "</row>" in text or not ended and not chunk:
                    raise _Irregular

    def _regular_cells(self, cells: str | None) -> tuple[list, list, bool]:
        texts: list = []
        kinds: list = []
        at, filled = -1, False
        for raw, value, inline in _CELLS.findall(cells) if cells else ():
            named = _attributes(raw) if raw else _NO_ATTRS
            at = _column(named["r"]) if named.get("r") else at + 1
            if "&" in value or "&" in inline:
                value, inline = _unreferred(value), _unreferred(inline)
            shown, kind = self._cell(named.get("t") or "n", named.get("s"), value or None, inline)
            if shown is None or shown == "":
                continue
            filled = True
            if shown in _MISSING:
                shown, kind = None, "e"
            if at == len(texts):
                texts.append(shown)
                kinds.append(kind)
            else:
                _put(texts, kinds, at, shown, kind)
        return texts, kinds, filled

    def rows(self, member: str) -> Iterator[tuple[int, list, list, bool]]:
        """``row number, texts, kinds, whether any cell is filled`` of a sheet's rows, up to each row's last filled cell.

        Cells come straight from the parser's events as the file is read, and no element is built. What follows the
        data is read too, to its end.
        """
        done: list[tuple[int, list, list, bool]] = []
        depth, ended, filled, number, at = 0, False, False, -1, -1
        texts: list = []
        kinds: list = []
        kind, style = "n", None
        value: str | None = None
        inline: str | None = None
        said: list[str] | None = None  # pieces of the text being read
        taking = runs = 0  # depth of the element whose text is read; depth of the innermost run of an inline string

        def start(name: str, attrs: dict) -> None:
            nonlocal depth, filled, number, at, texts, kinds, kind, style, value, inline, said, taking, runs
            if depth == 0:
                if name[-3:] == "row" and not ended and _local(name) == "row":
                    depth, at, filled, texts, kinds = 1, -1, False, [], []
                    number = int(attrs["r"]) - 1 if attrs.get("r") else number + 1
                return
            depth += 1
            if depth == 2:
                at = _column(attrs["r"]) if attrs.get("r") else at + 1
                kind, style, value, inline = attrs.get("t") or "n", attrs.get("s"), None, None
            elif depth == 3:
                if name[-2:] == "}v":
                    said, taking = [], 3
                elif name[-3:] == "}is":
                    inline, runs = "", 3
            else:
                taking = 0  # text behind an inner element does not count
                if runs == depth - 1:
                    inner = _local(name)
                    if inner == "t":
                        said, taking = [], depth
                    elif inner == "r":
                        runs = depth

        def end(name: str) -> None:
            nonlocal depth, ended, filled, value, inline, said, taking, runs
            if depth == 0:
                if name[-4:] == "Data" and _local(name) == "sheetData":
                    ended = True
                return
            if depth == 2:
                shown, found = self._cell(kind, style, value, inline)
                if shown is not None and shown != "":
                    filled = True
                    if shown in _MISSING:
                        shown, found = None, "e"
                    if at == len(texts):
                        texts.append(shown)
                        kinds.append(found)
                    else:
                        _put(texts, kinds, at, shown, found)
            elif depth == 1:
                done.append((number, texts, kinds, filled))
            elif said is not None:
                if depth == 3 and name[-2:] == "}v":
                    value = "".join(said) or None
                    said = None
                elif depth > 3 and runs == depth - 1 and _local(name) == "t":
                    inline += "".join(said)
                    said = None
            if depth >= 3:
                taking = 0
                if runs == depth:
                    runs = depth - 1 if depth > 3 else 0
            depth -= 1

        def chars(data: str) -> None:
            if taking and taking == depth:
                said.append(data)

        parser = expat.ParserCreate(namespace_separator="}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
        with self.zip.open(member) as source:
            chunk = b" "
            while chunk:
                chunk = source.read(_CHUNK)
                try:
                    parser.Parse(chunk, not chunk)
                except expat.ExpatError as problem:
                    raise ElementTree.ParseError(str(problem)) from None
                yield from done
                done.clear()


def _put(texts: list, kinds: list, at: int, shown: str | None, kind: str) -> None:
    """Set the cell of column ``at``, missing ones before it; a cell without a column is not kept."""
    if at < 0:
        return
    short = at + 1 - len(texts)
    if short > 0:
        texts.extend([None] * short)
        kinds.extend(["e"] * short)
    texts[at], kinds[at] = shown, kind


def unique_names(raw: Sequence[str | None]) -> list[str]:
    """Header texts as column names: blanks numbered, repeats suffixed."""
    taken: set[str] = set()
    names = []
    for i, shown in enumerate(raw):
        base = shown if shown not in (None, "") else f"Unnamed: {i}"
        name, n = base, 0
        while name in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name)
        names.append(name)
    return names


def _spool_rows(rows: Iterator[tuple[int, list, list, bool]], spool) -> tuple[int, int, list[int]]:
    """Write rows to the spool; the sheet's width, its last filled row and the sizes of the written blocks."""
    width, last, sizes = 0, -1, []
    ready: list[tuple[int, list, list]] = []
    for number, texts, kinds, filled in rows:
        if filled:
            width, last = max(width, len(texts)), max(last, number)
        ready.append((number, texts, kinds))
        if len(ready) == _BATCH:
            sizes.append(spool.write(marshal.dumps(ready)))
            ready = []
    sizes.append(spool.write(marshal.dumps(ready)))
    return width, last, sizes


def _sheet_rows(book: _Book, path: str, pos: int) -> Iterator[dict]:
    """Rows of one sheet, parsed once: they go to a spool, which lies on disk beyond ``_SPOOL`` bytes, until the sheet's
    extent is known and it has been read to its end."""
    sheet, member = book.sheets[pos]
    with tempfile.SpooledTemporaryFile(_SPOOL) as spool:
        try:
            width, last, sizes = _spool_rows(book.regular_rows(member), spool)
        except _Irregular:
            spool.seek(0)
            spool.truncate()
            width, last, sizes = _spool_rows(book.rows(member), spool)
        spool.seek(0)

        header, expected = None, 0
        for number, texts, shown_kinds in (row for size in sizes for row in marshal.loads(spool.read(size))):
            if number > last:
                break
            for at in range(expected, number + 1):
                cells, kinds = (texts, shown_kinds) if at == number else ([], [])
                short = width - len(cells)
                if short:
                    cells, kinds = cells + [None] * short, kinds + ["e"] * short
                if header is None:
                    header = unique_names(cells)
                yield {
                    "path": path,
                    "sheet": sheet,
                    "sheet_pos": pos,
                    "row_idx": at,
                    "header": header,
                    "cells": cells,
                    "kinds": kinds,
                }
            expected = number + 1


def _book_rows(path: str, content: bytes, tabs: Sequence[str] | None) -> Iterator[dict]:
    """Rows of the first sheet, or of the first sheet matching each wanted tab.

    A failure ends the file: rows of sheets read before it are out already, and one row with
    ``error`` reports it.
    """
    try:
        book = _Book(content)
        if tabs is None:
            wanted = [0]
        else:
            norm = [name.strip().lower() for name, _ in book.sheets]
            wanted = [norm.index(tab) for tab in tabs if tab in norm]
        for pos in wanted:
            yield from _sheet_rows(book, path, pos)
    except Exception as problem:
        yield {"path": path, "error": f"{type(problem).__name__}: {problem}"}


def _reader(tabs: Sequence[str] | None):
    schema = to_arrow_schema(DataType.fromDDL(RAW_TYPE))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = []
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for row in _book_rows(path, content.as_py(), tabs):
                    ready.append(row)
                    if len(ready) == _BATCH:
                        yield pa.RecordBatch.from_pylist(ready, schema=schema)
                        ready = []
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema=schema)

    return read


def workbook_rows(spark: SparkSession, location: str, tabs: Sequence[str] | None = None) -> DataFrame:
    """Raw sheet layer of every ``*.xlsx`` directly in ``location`` (or of one file).

    ``tabs=None`` reads the first sheet of each; otherwise the wanted tabs, matched without
    case and outer spaces, the first such sheet in workbook order. A place that is not there
    gives a warning and no rows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "false")
    )
    try:
        return decoded(files.load(location).select("path", "content"), tabs)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"nothing to read at {location}", stacklevel=2)
        return spark.createDataFrame([], RAW_TYPE)


def decoded(files: DataFrame, tabs: Sequence[str] | None = None) -> DataFrame:
    """Raw sheet layer of workbooks held as ``path, content``."""
    wanted = None if tabs is None else [t.strip().lower() for t in tabs]
    return files.select("path", "content").mapInArrow(_reader(wanted), RAW_TYPE)


def read_errors(raw: DataFrame) -> DataFrame:
    return raw.filter("error IS NOT NULL").select("path", "error")


def pick_sheets(raw: DataFrame, tabs: Sequence[str]) -> DataFrame:
    """Add ``tab`` to a raw layer that holds all sheets, keeping one sheet per file and tab."""
    wanted = raw.filter("error IS NULL").withColumn("tab", F.lower(text.strip(F.col("sheet"))))
    wanted = wanted.filter(F.col("tab").isin(*tabs))
    chosen = wanted.groupBy("path", "tab").agg(F.min("sheet_pos").alias("sheet_pos"))
    return wanted.join(chosen, ["path", "tab", "sheet_pos"], "left_semi")
