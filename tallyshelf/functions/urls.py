"""URL work as Catalyst expressions; no per-row Python."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NOISE = r"^[\x00-\x20]+|[\t\r\n]"
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"
_PARTS = rf"^(?:{_SCHEME})?(?://[^/?#]*)?([^?#]*)"
_DOTTED = r"(?:^|/)\.\.?(?:/|$)"
_BRACKET_HOST = r"^(?:[^@]*@)?\[(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*|v[0-9A-Fa-f]+\.[^\[\]]+)\](?::.*)?$"
# A rooted address that resolves by simply putting the origin in front of it.
_PLAIN = (
    r"^(?=/)(?:/[A-Za-z0-9_~%+,=@!$&'()*:-][A-Za-z0-9_.~%+,=@!$&'()*:-]*)*/?"
    r"(?:\?[^#\x00-\x20]+)?(?:#[^\x00-\x20]+)?$"
)
_PLAIN_BASE = r"^https?://[^/?#\s]+"


def _as_column(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _let(value: Column, body: str) -> Column:
    """A SQL lambda over a value that is computed once, however often the body uses it."""
    return F.get(F.call_function("transform", F.array(value), F.expr(body)), F.lit(0))


# struct<scheme, host, path, params, query, fragment>; parameters belong to the last segment.
_SPLIT = rf"""u -> named_struct(
  'scheme', lower(regexp_extract(u, r'^({_SCHEME})', 1)),
  'host', regexp_extract(u, r'^(?:{_SCHEME})?//([^/?#]*)', 1),
  'path', regexp_replace(regexp_extract(u, r'{_PARTS}', 1), r';[^/]*$', ''),
  'params', regexp_extract(regexp_extract(u, r'{_PARTS}', 1), r'^(?:.*/)?[^/;]*;([^/]*)$', 1),
  'query', regexp_extract(u, r'^[^#?]*\?([^#]*)', 1),
  'fragment', regexp_extract(u, r'#([\s\S]*)$', 1))"""

# Resolves . and .. segments of an absolute path.
_DROP_DOTS = rf"""p -> IF(NOT rlike(p, r'{_DOTTED}'), p, regexp_replace(concat('/', array_join(concat(
  aggregate(split(p, '/'), CAST(array() AS ARRAY<STRING>), (kept, seg) -> CASE seg
    WHEN '..' THEN slice(kept, 1, greatest(size(kept) - 1, 0)) WHEN '.' THEN kept ELSE concat(kept, array(seg)) END),
  IF(rlike(p, r'(?:^|/)\.\.?$'), array(''), CAST(array() AS ARRAY<STRING>))), '/')), r'^/(?=/)', ''))"""

# v.h is the split address, v.b the split base, v.raw the address as written.
_TAIL = "IF(v.h.query <> '', concat('?', v.h.query), ''), IF(v.h.fragment <> '', concat('#', v.h.fragment), '')"
_PARAMS = "IF(v.h.params <> '', concat(';', v.h.params), '')"
_MERGED = """IF(startswith(v.h.path, '/'), v.h.path,
    regexp_replace(concat('/', regexp_replace(v.b.path, r'[^/]*$', ''), v.h.path), r'/{2,}', '/'))"""
_JOIN = rf"""v -> CASE
  WHEN (contains(v.h.host, '[') OR contains(v.h.host, ']')) AND NOT rlike(v.h.host, r'{_BRACKET_HOST}') THEN NULL
  WHEN v.h.scheme <> '' AND v.h.scheme <> v.b.scheme THEN v.raw
  WHEN v.h.host <> '' THEN concat(v.b.scheme, '//', v.h.host, v.h.path, {_PARAMS}, {_TAIL})
  WHEN v.h.path = '' AND v.h.params = '' THEN concat(v.b.scheme, '//', v.b.host, v.b.path,
    IF(v.b.params <> '', concat(';', v.b.params), ''),
    IF(v.h.query <> '', concat('?', v.h.query), IF(v.b.query <> '', concat('?', v.b.query), '')),
    IF(v.h.fragment <> '', concat('#', v.h.fragment), ''))
  ELSE concat(v.b.scheme, '//', v.b.host, transform(array({_MERGED}), {_DROP_DOTS})[0], {_PARAMS}, {_TAIL}) END"""


def _resolved(href: Column, base: Column) -> Column:
    split = lambda url: _let(F.regexp_replace(url, _NOISE, ""), _SPLIT)
    return _let(F.struct(split(href).alias("h"), split(base).alias("b"), href.alias("raw")), _JOIN)


def absolute_url(href: Column, base: Column | str) -> Column:
    """Reference resolution against an http(s) base.

    Empty href gives empty text. NULL marks a host with broken brackets, which callers treat
    as an unusable link. Plain rooted addresses, the bulk of any crawl, skip the general rules.
    """
    base = _as_column(base)
    plain = href.rlike(_PLAIN) & ~href.rlike(_DOTTED) & base.rlike(_PLAIN_BASE)
    return (
        F.when(href == "", F.lit(""))
        .when(plain, F.concat(F.regexp_extract(base, f"({_PLAIN_BASE})", 1), href))
        .otherwise(_resolved(href, base))
    )


def _tidy(url: Column) -> Column:
    """Leading control characters and embedded line breaks do not belong to an address."""
    return F.regexp_replace(url, _NOISE, "")


def url_path(url: Column) -> Column:
    """Path without parameters."""
    return F.regexp_replace(F.regexp_extract(_tidy(url), _PARTS, 1), r";[^/]*$", "")


def product_slug(url: Column) -> Column:
    """First segment after ``/product/`` in the path; the whole path when it is not there."""
    path = url_path(url)
    after = F.regexp_extract(path, r"/product/+([^/]*)", 1)
    return F.when(path.contains("/product/"), after).otherwise(F.trim(path, F.lit("/")))


def query_value(url: Column, key: str) -> Column:
    """First non-blank value of one query parameter, decoded; empty text when absent.

    A percent sign without two hex digits stands for itself; bytes that are no UTF-8 become the
    replacement character.
    """
    query = F.regexp_extract(_tidy(url), r"^[^#?]*\?([^#]*)", 1)
    raw = F.regexp_extract(F.concat(F.lit("&"), query), rf"&{key}=([^&]+)", 1)
    return F.try_url_decode(F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25"))


def without_query(url: Column) -> Column:
    """Scheme, host, path and parameters."""
    kept = F.regexp_replace(_tidy(url), r"[?#][\s\S]*$", "")
    return F.regexp_replace(kept, r"(^|/)([^/;]*);$", "$1$2")


def is_product_link(url: Column) -> Column:
    """Judged after the query is gone, so an add-to-cart query does not disqualify a link."""
    return url_path(url).contains("/product/") & ~url.contains("add-to-cart")
