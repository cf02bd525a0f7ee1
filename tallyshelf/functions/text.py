"""Text clean-up as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Every character a Unicode-aware strip removes, as a set and as a pattern.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ODD_SPACE = r"[\x09-\x0d\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
SPACE = ODD_SPACE.replace(r"\x1f", r"\x20")

# Cell texts that mean "missing" in a spreadsheet export.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def na_to_null(c: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def null_text(c: Column) -> Column:
    """Exact ``nan`` / ``NaT`` become NULL; anything else, ``None`` included, stays."""
    return F.when(~c.isin("nan", "NaT"), c)


def strip(c: Column) -> Column:
    """Trim every Unicode whitespace character, not only spaces.

    Trimming by a list of characters is slow, so texts that begin and end with a plain character skip it.
    """
    plain = F.left(c, F.lit(1)).between("!", "~") & F.right(c, F.lit(1)).between("!", "~")
    return F.when(plain, c).otherwise(F.trim(c, F.lit(SPACE_CHARS)))


def strip_leading_commas(c: Column) -> Column:
    return F.ltrim(c, F.lit(","))


def collapse_space(c: Column) -> Column:
    """NULL to empty, whitespace runs (non-breaking ones too) to one space, trimmed.

    The pattern skips single plain spaces, which are right already and by far the most common.
    """
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{ODD_SPACE}{SPACE}*| {SPACE}+", " "))


def filled(*choices: Column) -> Column:
    """First choice that is neither NULL nor empty; empty text when there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices], F.lit(""))


def category_label(slug: Column) -> Column:
    """Words in title case: every letter run starts with a capital, also behind a digit or an apostrophe."""
    spaced = F.lower(F.replace(slug, F.lit("-"), F.lit(" ")))
    runs = F.regexp_extract_all(spaced, F.lit(r"(?:\p{L}+|[^\p{L}]+)"), F.lit(0))
    return F.when(spaced.rlike(r"[^\p{L} ]"), F.array_join(F.transform(runs, F.initcap), "")).otherwise(F.initcap(spaced))


def distinct_join(items: Column, sep: str = " - ") -> Column:
    """Distinct items in first-seen order, joined."""
    return F.array_join(F.array_distinct(items), sep)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def named_day(part: Column) -> Column:
    """The date that a part of a file name spells as ``yyyyMMdd``, or NULL."""
    spelled = F.concat_ws("-", F.left(part, F.lit(4)), F.substring(part, 5, 2), F.right(part, F.lit(2)))
    return F.when(part.rlike(r"^(?!0000)\d{8}$"), spelled.try_cast("date"))


# Both dates of a split file name, or NULL: the parts are looked at once each.
_NAME_DATES = r"""p -> transform(array(named_struct(
    'start', IF(rlike(get(p, 0), r'^(?!0000)\d{8}$'),
      try_cast(concat_ws('-', left(get(p, 0), 4), substr(get(p, 0), 5, 2), right(get(p, 0), 2)) AS DATE), NULL),
    'end', IF(rlike(get(p, 1), r'^(?!0000)\d{8}$'),
      try_cast(concat_ws('-', left(get(p, 1), 4), substr(get(p, 1), 5, 2), right(get(p, 1), 2)) AS DATE), NULL))),
  d -> IF(d.start IS NOT NULL AND d.end IS NOT NULL, d, NULL))[0]"""


def file_dates(path: Column) -> Column:
    """``yyyyMMdd_yyyyMMdd_...`` file names as struct<start, end>; NULL unless both are dates."""
    parts = F.array(F.split(file_name(path), "_"))
    return F.get(F.call_function("transform", parts, F.expr(_NAME_DATES)), F.lit(0))
