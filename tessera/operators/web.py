"""Extraction from stored web pages: links, link categories, item grids, headers, prices.

Pages are independent rows, so every job here is a chain of per-row expressions with no
shuffle at all.  Elements are found by their tags (``elements`` keeps nested tags of the same
name balanced) and selected by class and attribute (``has_class``, ``attribute``), as CSS
selectors would: ``tag.class``, ``[attr^=...]`` and ``[attr*=...]``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import strip_tags, trim_ws

#: The quoted value of an anchor's href, quotes included.
ANCHOR_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')"""
ANCHOR_OPEN = r"(?is)(<a(?:\s[^>]*)?>)"
# The published price pattern and the published selectors.
PRICE = r"\d+[\.,]?\d*\s*EUR"
SHARE = r"(\d+)\s*%\s*([^\W\d_][\w-]*)"
PRODUCT_CLASSES = ("product-grid-product", "_product")
PRODUCT_ID = "data-productid"
PRODUCT_LINK_CLASS = "product-link"
BLOCK_PREFIX, BLOCK_PART, MAIN_PART = "product-detail-view", "info", "main"
HEADER_PART, COMPOSITION_PART, NAME_PART = "header-name", "composition", "part-name"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

# Categories in priority order, each with its related terms (synonyms
# first, then the category name itself).
CATEGORIES: list[tuple[str, list[str]]] = [
    ("hombre", ["man"]),
    ("mujer", ["woman"]),
    ("ninos", ["kids"]),
]


def _nullif_empty(c: Column) -> Column:
    return F.when(c == "", F.lit(None)).otherwise(c)


def decode_entities(c: Column) -> Column:
    """The common named entities of a text; ``&amp;`` last, so nothing is decoded twice."""
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def unquoted(c: Column) -> Column:
    """An attribute's value from its quoted form."""
    return decode_entities(F.substring(c, F.lit(2), F.length(c) - 2))


def hrefs(html: Column) -> Column:
    """Non-empty links of a page's anchors in order, by either kind of quotes, entities decoded."""
    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(ANCHOR_HREF), 1), unquoted), lambda x: x != "")


def attribute(tag: Column, name: str) -> Column:
    """An attribute of an opening tag, null if it isn't there."""
    found = F.regexp_extract(tag, rf"""(?is)\s{re.escape(name)}\s*=\s*("[^"]*"|'[^']*')""", 1)
    return F.when(found != "", unquoted(found))


def has_class(tag: Column, *names: str) -> Column:
    """Whether an opening tag has all the classes."""
    words = F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+")
    out = F.lit(True)
    for name in names:
        out = out & F.array_contains(words, name)
    return out


def class_contains(tag: Column, part: str | None, prefix: str | None = None) -> Column:
    """Whether the class attribute holds ``part`` and starts with ``prefix`` (None: anything)."""
    value = F.coalesce(attribute(tag, "class"), F.lit(""))
    return (F.lit(True) if part is None else value.contains(part)) & (F.lit(True) if prefix is None else value.startswith(prefix))


def opening(element: Column) -> Column:
    """The opening tag of an element."""
    return F.regexp_extract(element, r"(?s)^<[^>]*>", 0)


def elements(html: Column, tag: str) -> Column:
    """The outermost elements of a tag, from opening to matching closing tag; an element that
    never closes is left out."""
    pieces = F.split(html, rf"(?i)(?=</?{tag}[\s>])")
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, p: Column) -> Column:
        opens, closes = p.rlike(rf"(?i)^<{tag}[\s>]"), p.rlike(rf"(?i)^</{tag}[\s>]")
        grown = F.concat(s["cur"], p)
        ended = F.concat(s["cur"], F.substring(p, F.lit(1), F.instr(p, ">")))
        return (F.when(opens, F.struct((s["depth"] + 1).alias("depth"), grown.alias("cur"), s["out"].alias("out")))
                .when(closes & (s["depth"] == 1), F.struct(F.lit(0).alias("depth"), F.lit("").alias("cur"),
                                                           F.concat(s["out"], F.array(ended)).alias("out")))
                .when(s["depth"] > 0, F.struct((s["depth"] - closes.cast("int")).alias("depth"), grown.alias("cur"), s["out"].alias("out")))
                .otherwise(s))

    return F.aggregate(pieces, start, step, lambda s: s["out"])


def text_of(element: Column) -> Column:
    """An element's text without tags, trimmed, null if empty."""
    return _nullif_empty(trim_ws(decode_entities(strip_tags(element))))


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All anchors with a non-empty href: ``(page_id, link_pos, href)`` (0-based among them)."""
    return pages.select(id_col, F.posexplode(hrefs(F.col(html_col))).alias("link_pos", "href"))


def distinct_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Distinct hrefs per page with the position of their first occurrence.

    Deduplicated inside each page row (``array_distinct`` keeps first occurrences), so
    no shuffle is needed.
    """
    return (
        pages.select(id_col, hrefs(F.col(html_col)).alias("_links"))
        .select(id_col, "_links", F.explode(F.array_distinct("_links")).alias("href"))
        .select(id_col, "href", (F.array_position("_links", F.col("href")) - 1).cast("int").alias("first_pos"))
    )


def _term_pattern(term: str, whole_word: bool) -> str:
    """Terms are patterns, as in the original; ``re.escape`` a literal one."""
    return f"(?i)\\b(?:{term})\\b" if whole_word else f"(?i){term}"


def category_of(href: Column, categories: Sequence[tuple[str, Sequence[str]]] = CATEGORIES,
                whole_word: bool = False) -> tuple[Column, Column]:
    """(category, matched term) of a link: first category in order with a matching term.

    Built at plan time as a ``CASE`` chain of literal patterns (compiled once, code-
    generated), instead of a join against a pattern table.
    """
    cat = None
    term = None
    for name, synonyms in categories:
        for t in [*synonyms, name]:
            cond = href.rlike(_term_pattern(t, whole_word))
            cat = F.when(cond, F.lit(name)) if cat is None else cat.when(cond, F.lit(name))
            term = F.when(cond, F.lit(t)) if term is None else term.when(cond, F.lit(t))
    return cat, term


def categorise_links(pages: DataFrame, categories: Sequence[tuple[str, Sequence[str]]] = CATEGORIES,
                     whole_word: bool = False, id_col: str = "page_id",
                     html_col: str = "html") -> DataFrame:
    """Every distinct link with its category or null: ``(page_id, href, first_pos,
    category, term)``.  A link is claimed by the first category that matches it."""
    cat, term = category_of(F.col("href"), categories, whole_word)
    return distinct_links(pages, id_col, html_col).select(
        id_col, "href", "first_pos", cat.alias("category"), term.alias("term"))


def links_by_category(pages: DataFrame, **kw) -> DataFrame:
    return categorise_links(pages, **kw).where(F.col("category").isNotNull())


def uncategorised_links(pages: DataFrame, **kw) -> DataFrame:
    return categorise_links(pages, **kw).where(F.col("category").isNull()).drop("category", "term")


def _first_link(element: Column, link_class: str | None) -> Column:
    tags = F.regexp_extract_all(element, F.lit(ANCHOR_OPEN), 1)
    if link_class is not None:
        tags = F.filter(tags, lambda t: has_class(t, link_class))
    return _nullif_empty(attribute(F.try_element_at(tags, F.lit(1)), "href"))


def _items(html: Column, tag: str, classes: Sequence[str], id_attr: str, link_class: str | None) -> Column:
    chosen = F.filter(elements(html, tag), lambda e: has_class(opening(e), *classes))
    rows = F.transform(chosen, lambda e, i: F.struct(
        i.alias("item_pos"), _nullif_empty(attribute(opening(e), id_attr)).alias("product_id"),
        _first_link(e, link_class).alias("product_link")))
    return F.filter(rows, lambda r: r["product_id"].isNotNull())


def page_items(pages: DataFrame, tag: str = "li", classes: Sequence[str] = PRODUCT_CLASSES, id_attr: str = PRODUCT_ID,
               link_class: str | None = PRODUCT_LINK_CLASS, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Item grid rows ``(page_id, item_pos, product_id, product_link)``: elements of a tag with all
    the classes.  Items without the id attribute are dropped; a missing link (of the link class,
    None: any anchor) stays null."""
    return pages.select(id_col, F.inline(_items(F.col(html_col), tag, classes, id_attr, link_class)))


def first_item(pages: DataFrame, tag: str = "li", classes: Sequence[str] = PRODUCT_CLASSES, id_attr: str = PRODUCT_ID,
               link_class: str | None = PRODUCT_LINK_CLASS, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The first item of each page's grid (first row of ``page_items``), found inside the page row."""
    first = F.try_element_at(_items(F.col(html_col), tag, classes, id_attr, link_class), F.lit(1))
    return pages.select(id_col, first.alias("f")).where(F.col("f").isNotNull()).select(id_col, "f.*")


def _inside(block: Column, tag: str, part: str | None) -> Column:
    """First element of a tag in a block whose class holds ``part``."""
    return F.try_element_at(F.filter(elements(block, tag), lambda e: class_contains(opening(e), part)), F.lit(1))


def page_headers(pages: DataFrame, tag: str = "div", prefix: str | None = BLOCK_PREFIX, part: str | None = BLOCK_PART,
                 main: str | None = MAIN_PART, header_part: str | None = HEADER_PART, price: str = PRICE,
                 id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Main blocks of a page: ``(page_id, block_pos, header, price)``; the header falls back to
    ``info_<pos>``, the first price to ``N/A``.

    A block is an element of ``tag`` whose class starts with ``prefix`` and holds ``part``; it is a
    main block if an inner ``div`` has ``main`` in its class (None: every block is)."""
    blocks = F.filter(elements(F.col(html_col), tag), lambda e: class_contains(opening(e), part, prefix))
    b = F.col("block")
    out = pages.select(id_col, F.posexplode(blocks).alias("block_pos", "block"))
    if main is not None:
        out = out.where(F.exists(F.regexp_extract_all(F.expr("substr(block, 2)"), F.lit(r"(?is)(<div\s[^>]*>)"), 1),
                                 lambda t: class_contains(t, main)))
    return out.select(
        id_col, "block_pos",
        F.coalesce(text_of(_inside(b, "h1", header_part)), F.concat(F.lit("info_"), F.col("block_pos").cast("string"))).alias("header"),
        F.coalesce(_nullif_empty(F.regexp_extract(strip_tags(b), price, 0)), F.lit("N/A")).alias("price"))


def price_value(price: Column) -> Column:
    """Numeric value of a price token such as ``12,50 EUR``."""
    num = F.regexp_extract(price, r"(\d+[\.,]?\d*)", 1)
    return F.regexp_replace(num, ",", ".").try_cast("double")


def composition(pages: DataFrame, tag: str = "li", part: str | None = COMPOSITION_PART, name_tag: str = "span",
                name_part: str | None = NAME_PART, entry_tag: str = "li", id_col: str = "page_id",
                html_col: str = "html") -> DataFrame:
    """Parts of a page's composition: ``(page_id, part_pos, part_name, shares)``.

    A part is an element of ``tag`` whose class holds ``part``; its name is the first ``name_tag``
    with ``name_part`` (``N/A`` without one), its shares are the texts of the entries inside it."""
    parts = F.filter(elements(F.col(html_col), tag), lambda e: class_contains(opening(e), part))
    inner = F.expr("substr(part, length(regexp_extract(part, '^<[^>]*>', 0)) + 1)")
    return (pages.select(id_col, F.posexplode(parts).alias("part_pos", "part")).select(
        id_col, "part_pos", F.coalesce(text_of(_inside(inner, name_tag, name_part)), F.lit("N/A")).alias("part_name"),
        F.filter(F.transform(elements(inner, entry_tag), text_of), lambda x: x.isNotNull()).alias("shares")))


def materials(shares: Column) -> Column:
    """Shares such as ``60% cotton`` as an array of (percent, material), in order; texts without a
    share give nothing, a text may hold several.  (The given pages hold no shares: tested on inline
    pages only.)"""
    found = F.flatten(F.transform(shares, lambda s: F.regexp_extract_all(s, F.lit(SHARE), 0)))
    return F.transform(found, lambda s: F.struct(F.regexp_extract(s, SHARE, 1).cast("int").alias("percent"),
                                                 F.regexp_extract(s, SHARE, 2).alias("material")))


def category_lists(categorised: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Links of each (page, category) as one list in page order, joined by a space:
    ``(page_id, category, n_links, links)``.  A group holds one page's links only."""
    return (
        categorised.where(F.col("category").isNotNull())
        .groupBy(id_col, "category")
        .agg(F.count(F.lit(1)).alias("n_links"),
             F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("first_pos", "href"))),
                                      lambda s: s["href"]), " ").alias("links"))
    )


NAV_BLOCK = r"(?s)<nav[^>]*>(.*?)</nav>"
ANCHOR_BODY = r"(?s)<a[^>]*>(.*?)</a>"


def _synonym_map(categories: Sequence[tuple[str, Sequence[str]]]) -> str:
    def quoted(t: str) -> str:
        return "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(f"{quoted(name)}, array({', '.join(map(quoted, syn))})" for name, syn in categories)
    return f"map({pairs})"


def categorise_by_page_menu(pages: DataFrame, categories: Sequence[tuple[str, Sequence[str]]] = CATEGORIES,
                            id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Categories named by the page itself, as in the original: the anchor texts of the
    page's navigation block (lower-cased, ``ñ`` folded to ``n``, first occurrence kept)
    are the category names, each with its synonyms from the fixed map plus the name.
    Every distinct link of the page goes to the first category (menu order) with a term
    contained in it, case-insensitively; the matched term is reported.

    Names and links of one page are compared inside the page row (array functions), so
    no category x link rows are produced.  Terms are matched as literal text.
    Output ``(page_id, href, first_pos, category, term)`` for categorised links.
    """
    syn = _synonym_map(categories)
    names = F.expr(f"""filter(transform(
        regexp_extract_all(regexp_extract({html_col}, '{NAV_BLOCK}', 1), '{ANCHOR_BODY}', 1),
        x -> translate(lower(regexp_replace(regexp_replace(x, '<[^>]*>', ''), '^\\\\s+|\\\\s+$', '')), 'ñ', 'n')),
        x -> x != '')""")
    cats = F.expr(f"""transform(filter(_names, (x, i) -> array_position(_names, x) = i + 1),
        (n, i) -> named_struct('cat_pos', i, 'category', n,
                               'terms', concat(coalesce(try_element_at({syn}, n), cast(array() as array<string>)), array(n))))""")
    hit = F.expr("try_element_at(filter(_cats, c -> exists(c.terms, t -> instr(lower(href), t) > 0)), 1)")
    term = F.expr("try_element_at(filter(_hit.terms, t -> instr(lower(href), t) > 0), 1)")
    links = hrefs(F.col(html_col))
    rows = (
        pages.select(id_col, html_col, names.alias("_names"))
        .select(id_col, cats.alias("_cats"), links.alias("_links"))
        .select(id_col, "_cats", "_links", F.explode(F.array_distinct("_links")).alias("href"))
        .select(id_col, "_cats", "href",
                (F.array_position("_links", F.col("href")) - 1).cast("int").alias("first_pos"))
    )
    return (
        rows.select(id_col, "href", "first_pos", hit.alias("_hit"))
        .where(F.col("_hit").isNotNull())
        .select(id_col, "href", "first_pos", F.col("_hit.category").alias("category"), term.alias("term"))
    )
