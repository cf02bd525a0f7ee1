"""Raw facts of one landed page, as Arrow functions over the ``html`` column.

Each function reads a page once and returns plain facts (attributes, texts, flags). Choosing
between them - which price wins, what counts as in stock, which links are products - is left
to Column expressions so those steps stay in the query plan.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tallyshelf.sources.markup import Node, Page, inside

_RUN = re.compile(r"\s+")
_TOTAL = re.compile(r"Total\s+(\d+)\s+Pages", re.IGNORECASE)
_PAGE_NO = re.compile(r"page=(\d+)")
_KEY_FEATURES = re.compile(r"\bKey Features\b", re.IGNORECASE)
_IN_STOCK = re.compile(r"\bin stock\b")
_INT_MAX = 2**31 - 1

PRICE_TYPE = "was STRING, now STRING, amounts ARRAY<STRING>, full STRING"
COLLECTION_TYPE = (
    "struct<total_hit INT, link_max INT, tiles ARRAY<STRUCT<"
    "pos INT, href STRING, data_name STRING, anchor_text STRING, data_sku STRING, data_price STRING, "
    "has_cart BOOLEAN, cart_price STRING, src STRING, data_src STRING, srcset STRING, points ARRAY<STRING>, "
    "now_texts ARRAY<STRING>, was_texts ARRAY<STRING>, says_out_of_stock BOOLEAN>>>"
)
LISTING_TYPE = (
    f"struct<links ARRAY<STRUCT<pos INT, href STRING, price STRUCT<{PRICE_TYPE}>>>, "
    "next_anchor STRING, next_link STRING>"
)
PRODUCT_TYPE = (
    "struct<ok BOOLEAN, name STRING, breadcrumb STRING, says_gone BOOLEAN, says_in_stock BOOLEAN, "
    "key_items ARRAY<STRING>, lists ARRAY<ARRAY<STRING>>, tab_text STRING, short_text STRING, "
    f"variations STRING, options MAP<STRING, ARRAY<STRING>>, price STRUCT<{PRICE_TYPE}>>"
)
OUTLINE_TYPE = "struct<heading STRING, hrefs ARRAY<STRING>, lists ARRAY<ARRAY<STRING>>, says_gone BOOLEAN, says_in_stock BOOLEAN>"


def _first(nodes: Iterable[Node]) -> Node | None:
    return next(iter(nodes), None)


def _one_line(text: str) -> str:
    return _RUN.sub(" ", text).strip()


def _page_number(digits: str) -> int:
    """A page number; one that no page table can hold counts as the largest that it can."""
    digits = digits.lstrip("0")
    return min(int(digits or "0"), _INT_MAX) if len(digits) <= 10 else _INT_MAX


# --- product tiles on collection pages ---------------------------------------------------


_PRICE_RULES: tuple[Callable[[Node], bool], ...] = (
    lambda line: inside(line, cls="product-desc"),
    lambda line: line.tag == "p",
    lambda line: True,
)


def _price_lines(n: Node) -> list[Node]:
    return [up for up in n.ancestors() if up.has("product-price")]


def _price_texts(page: Page, found: list[tuple[Node, list[Node]]]) -> list[str]:
    """Text of the first hit under each of three ever looser price-line rules."""
    firsts = (_first(n for n, lines in found if any(map(rule, lines))) for rule in _PRICE_RULES)
    return [page.text(n, "") for n in firsts]


def _tile_facts(page: Page, tile: Node, pos: int) -> dict | None:
    link = cart = image = None
    prices: dict[str, list] = {"span": [], "del": []}
    points, words = [], []
    for n in page.nodes[tile.at + 1 : tile.end]:
        tag = n.tag
        if tag is None:
            if not n.hidden:
                words.append(n.text.strip())
        elif tag == "a":
            if link is None and (n.get("href") or "").startswith("/product/"):
                link = n
            if cart is None and n.has("js_add_to_cart"):
                cart = n
        elif tag in prices:
            lines = _price_lines(n)
            if lines:
                prices[tag].append((n, lines))
        elif tag == "img":
            if image is None and inside(n, cls="product-picture-wrap"):
                image = n
        elif tag == "p" and n.has("product-point") and inside(n, tag="div", cls="product-points"):
            spans = list(page.elements(n, "span"))
            if spans:
                points.append(page.text(spans[-1], ""))
    if link is None:
        return None
    return {
        "pos": pos,
        "href": link.get("href"),
        "data_name": link.get("data-name"),
        "anchor_text": page.text(link, ""),
        "data_sku": link.get("data-sku"),
        "data_price": link.get("data-price"),
        "has_cart": cart is not None,
        "cart_price": cart.get("data-price") if cart else None,
        "src": image.get("src") if image else None,
        "data_src": image.get("data-src") if image else None,
        "srcset": image.get("srcset") if image else None,
        "points": points,
        "now_texts": _price_texts(page, prices["span"]),
        "was_texts": _price_texts(page, prices["del"]),
        "says_out_of_stock": "out of stock" in " ".join(w for w in words if w).lower(),
    }


def collection_page(html: str) -> dict:
    page = Page(html)
    visible, tiles, top = [], [], None
    for n in page.nodes:
        tag = n.tag
        if tag is None:
            if not n.hidden:
                visible.append(n.text)
        elif tag == "div":
            if n.has("js_product") and n.has("site-product"):
                tiles.append(n)
        elif tag == "a":
            numbered = _PAGE_NO.search(n.get("href") or "")
            if numbered:
                top = max(top or 0, _page_number(numbered.group(1)))
    said = "".join(visible)
    total = _TOTAL.search(said) if "Total" in said and "Pages" in said else None
    facts = (_tile_facts(page, tile, pos) for pos, tile in enumerate(tiles))
    return {
        "total_hit": _page_number(total.group(1)) if total else None,
        "link_max": top,
        "tiles": [f for f in facts if f is not None],
    }


# --- brand listing pages -----------------------------------------------------------------


def _is_price(n: Node) -> bool:
    return n.tag is not None and n.has("price")


def _is_amount(n: Node, within: str) -> bool:
    return (n.tag == "bdi" or n.has("woocommerce-Price-amount")) and inside(n, tag=within)


def _price_facts(page: Page, box: Node | None) -> dict | None:
    if box is None:
        return None
    for n in list(page.elements(box)):
        if n.has("screen-reader-text"):
            page.drop(n)
    inner = list(page.elements(box))
    was = _first(n for n in inner if _is_amount(n, "del"))
    now = _first(n for n in inner if _is_amount(n, "ins"))
    return {
        "was": _one_line(page.text(was)) if was else None,
        "now": _one_line(page.text(now)) if now else None,
        "amounts": [_one_line(page.text(n)) for n in inner if n.tag == "bdi"],
        "full": _one_line(page.text(box)),
    }


def _product_links(page: Page, top: Node) -> list[Node]:
    return [a for a in page.elements(top, "a") if "/product/" in (a.get("href") or "")]


_SIDE = ("sidebar", "widget-area", "product_list_widget")


def _drop_boilerplate(page: Page, top: Node) -> None:
    for n in list(page.elements(top)):
        if n.tag in ("aside", "header", "footer", "nav") or n.get("id") == "sidebar" or any(map(n.has, _SIDE)):
            page.drop(n)


def _grid(page: Page, top: Node) -> Node:
    """The product grid: a known container, else the one holding most product links."""
    for tag in ("ul", "div", "section"):
        known = _first(n for n in page.elements(top, tag) if n.has("products"))
        if known is not None:
            return known
    links = [a.at for a in _product_links(page, top) if "add-to-cart" not in a.get("href")]
    best, most = top, 0
    for box in page.elements(top, "ul", "div", "section"):
        held = bisect_left(links, box.end) - bisect_left(links, box.at)
        if held > most:
            best, most = box, held
    return best


def _tile_price(page: Page, link: Node) -> Node | None:
    for up in link.ancestors():
        if up.tag in ("li", "article", "div", "section"):
            price = _first(n for n in page.elements(up) if _is_price(n))
            if price is not None:
                return price
        if up.tag in ("main", "body", "html"):
            return None
    return None


def _is_next(n: Node) -> bool:
    return n.tag == "a" and n.has("next")


def listing_page(html: str) -> dict:
    page = Page(html)
    top = _first(page.elements(page.root, "main")) or page.root
    _drop_boilerplate(page, top)
    links, prices = [], {}
    for pos, a in enumerate(_product_links(page, _grid(page, top))):
        box = _tile_price(page, a)
        key = box.at if box else None
        if key not in prices:
            prices[key] = _price_facts(page, box)
        links.append({"pos": pos, "href": a.get("href"), "price": prices[key]})
    after = _first(n for n in page.elements(page.root, "a") if _is_next(n))
    rel = _first(n for n in page.elements(page.root, "link") if "next" in (n.get("rel") or "").split())
    return {
        "links": links,
        "next_anchor": after.get("href") if after else None,
        "next_link": rel.get("href") if rel else None,
    }


# --- product pages -----------------------------------------------------------------------


def _items(page: Page, ul: Node) -> list[str]:
    lines = (_one_line(page.text(li)) for li in page.elements(ul, "li"))
    return [line for line in lines if line]


def _key_items(page: Page) -> list[str]:
    mark = _first(n for n in page.below(page.root) if n.tag is None and _KEY_FEATURES.search(n.text))
    if mark is None:
        return []
    after = _first(n for n in page.nodes[mark.parent.at + 1 :] if n.tag == "ul" and not n.gone)
    return _items(page, after) if after else []


def _listed(page: Page) -> list[list[str]]:
    return [_items(page, ul) for ul in page.elements(page.root, "ul")]


def _stock_flags(page: Page) -> dict:
    text = page.text(page.root).lower()
    return {
        "says_gone": "sold out" in text or "out of stock" in text,
        "says_in_stock": _IN_STOCK.search(text) is not None,
    }


def _options(page: Page, form: Node) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for select in page.elements(form, "select"):
        name = _one_line(select.get("name") or select.get("id") or "")
        labels = (_one_line(page.text(o)) for o in page.elements(select, "option"))
        wanted = [label for label in labels if label and "choose an option" not in label.lower()]
        if name and wanted:
            found[name] = wanted
    return found


def product_page(html: str) -> dict:
    page = Page(html)
    everything = list(page.elements(page.root))
    crumb = _first(n for n in everything if n.has("woocommerce-breadcrumb"))
    heading = _first(n for n in everything if n.tag == "h1")
    form = _first(n for n in everything if n.tag == "form" and n.has("variations_form"))
    tab = _first(
        n
        for n in everything
        if n.get("id") == "tab-description" or n.has("woocommerce-Tabs-panel--description")
    )
    short = _first(
        n for n in everything if n.tag == "div" and n.has("woocommerce-product-details__short-description")
    )
    keyed = _key_items(page)
    facts = {
        "ok": True,
        "name": _one_line(page.text(heading)),
        "breadcrumb": _one_line(page.text(crumb)),
        **_stock_flags(page),
        "key_items": keyed,
        "lists": [] if keyed else _listed(page),
        "tab_text": _one_line(page.text(tab)),
        "short_text": _one_line(page.text(short)),
        "variations": form.get("data-product_variations") if form else None,
        "options": list(_options(page, form).items()) if form else [],
    }
    # Last, because it removes screen-reader text from the page.
    facts["price"] = _price_facts(page, _first(n for n in everything if _is_price(n)))
    return facts


def outline(html: str) -> dict:
    """Heading, link targets, lists and stock wording of any page."""
    page = Page(html)
    return {
        "heading": _one_line(page.text(_first(page.elements(page.root, "h1")))),
        "hrefs": [a.get("href") for a in page.elements(page.root, "a") if a.get("href") is not None],
        "lists": _listed(page),
        **_stock_flags(page),
    }


# --- Column functions --------------------------------------------------------------------


def _facts(read_page: Callable[[str], dict], ddl: str, on_error: dict | None = None):
    result = DataType.fromDDL(ddl)
    arrow_result = to_arrow_type(result)

    def batch(pages: pa.Array) -> pa.Array:
        rows = []
        for html in pages.to_pylist():
            try:
                rows.append(read_page(html) if html else None)
            except Exception:
                if on_error is None:
                    raise
                rows.append(on_error)
        return pa.array(rows, type=arrow_result)

    batch.__annotations__ = {"pages": pa.Array, "return": pa.Array}
    batch.__name__ = read_page.__name__
    return F.arrow_udf(batch, returnType=result)


def collection_facts(html: Column) -> Column:
    """NULL for a missing page; a page that could not be read has NULL ``tiles``."""
    return _facts(collection_page, COLLECTION_TYPE, on_error={})(html)


def listing_facts(html: Column) -> Column:
    """NULL for a missing page; a page that could not be read has NULL ``links``."""
    return _facts(listing_page, LISTING_TYPE, on_error={})(html)


def product_facts(html: Column) -> Column:
    """NULL for a missing page; ``ok = false`` for a page that could not be read."""
    return _facts(product_page, PRODUCT_TYPE, on_error={"ok": False})(html)


def outline_facts(html: Column) -> Column:
    return _facts(outline, OUTLINE_TYPE)(html)
