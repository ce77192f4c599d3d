"""Web extraction queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import base_name
from tessera.operators import web as W
from tessera.plans.registry import register
from tessera.sources import read_table


#: Categories by words that occur in the links of the given tables (the library's own default
#: names, Spanish shop sections, are in none of them).
CATEGORIES = [("articles", ["the", "der"]), ("verbs", ["ing"]), ("nouns", ["tion"])]


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]*>', '', 'g')"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _case(kind: str) -> str:
    parts = []
    for name, syn in CATEGORIES:
        for t in [*syn, name]:
            val = name if kind == "category" else t
            parts.append(f"WHEN regexp_matches(href, '(?i){t}') THEN '{val}'")
    return "CASE " + " ".join(parts) + " END"


# Patterns here are written on their own, not taken from the operators.
def _decoded(x: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                         ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


_Q = "chr(39)"
_HREF_SQL = f"""list_filter(list_transform(
    regexp_extract_all(html, '(?is)<a[[:space:]]+(?:[^>]*?[[:space:]])?href[[:space:]]*=[[:space:]]*("[^"]*"|' || {_Q} || '[^' || {_Q} || ']*' || {_Q} || ')', 1),
    lambda v: {_decoded("v[2:-2]")}), lambda v: v <> '')"""
_DISTINCT_SQL = f"""
a AS (
  SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT page_id, {_HREF_SQL} AS l FROM pages)),
d AS (SELECT page_id, href, CAST(min(pos) AS INTEGER) AS first_pos FROM a GROUP BY 1, 2),
c AS (SELECT page_id, href, first_pos, {_case('category')} AS category, {_case('term')} AS term FROM d)"""

def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "html")


@register("page_links", f"""
SELECT page_id, link_pos, href FROM (
  SELECT page_id, unnest(l) AS href, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS link_pos
  FROM (SELECT page_id, {_HREF_SQL} AS l FROM pages))""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.page_links(_pages(spark, sf_dir))


@register("page_links_by_category", f"""
WITH {_DISTINCT_SQL}
SELECT page_id, href, first_pos, category, term FROM c WHERE category IS NOT NULL""")
def page_links_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.links_by_category(_pages(spark, sf_dir), categories=CATEGORIES)


@register("page_links_uncategorised", f"""
WITH {_DISTINCT_SQL}
SELECT page_id, href, first_pos FROM c WHERE category IS NULL""")
def page_links_uncategorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.uncategorised_links(_pages(spark, sf_dir), categories=CATEGORIES)


def _elements_sql(x: str, tag: str) -> str:
    """Outermost elements: numbers of opening and closing tags up to each piece decide."""
    pieces = f"string_split(regexp_replace({x}, '(?i)(</?{tag}[[:space:]>])', chr(1) || '\\1', 'g'), chr(1))"
    return f"""list_reduce(list_transform({pieces}, lambda p: {{'d': 0, 'cur': p, 'out': []::VARCHAR[]}}), lambda s, p:
      CASE WHEN regexp_matches(p.cur, '(?i)^<{tag}[[:space:]>]') THEN {{'d': s.d + 1, 'cur': s.cur || p.cur, 'out': s.out}}
           WHEN regexp_matches(p.cur, '(?i)^</{tag}[[:space:]>]') AND s.d = 1
             THEN {{'d': 0, 'cur': '', 'out': list_append(s.out, s.cur || p.cur[:strpos(p.cur, '>')])}}
           WHEN s.d > 0 THEN {{'d': s.d - CASE WHEN regexp_matches(p.cur, '(?i)^</{tag}[[:space:]>]') THEN 1 ELSE 0 END,
                              'cur': s.cur || p.cur, 'out': s.out}}
           ELSE s END, {{'d': 0, 'cur': '', 'out': []::VARCHAR[]}}).out"""


def _plain(x: str) -> str:
    return f"nullif({_trim(_decoded(_strip(x)))}, '')"


_ITEMS_SQL = f"""
i AS (
  SELECT page_id, unnest(l) AS item, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_pos
  FROM (SELECT page_id, {_elements_sql('html', 'a')} AS l FROM pages)),
j AS (
  SELECT page_id, item_pos, nullif({_decoded("regexp_extract(item, '^<[^>]*[[:space:]]href=\"([^\"]*)\"', 1)")}, '') AS product_id
  FROM i)"""


@register("page_items", f"""
WITH {_ITEMS_SQL}
SELECT page_id, item_pos, product_id, product_id AS product_link FROM j WHERE product_id IS NOT NULL""")
def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages hold no product lists, so their anchors are the items, with the link as id;
    the published selectors (the defaults) are tested on inline pages."""
    return W.page_items(_pages(spark, sf_dir), tag="a", classes=(), id_attr="href", link_class=None)


@register("page_first_item", f"""
WITH {_ITEMS_SQL}
SELECT page_id, item_pos, product_id, product_id AS product_link FROM j WHERE product_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY item_pos) = 1""")
def page_first_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.first_item(_pages(spark, sf_dir), tag="a", classes=(), id_attr="href", link_class=None)


#: A number with a decimal part, which the pages do hold (they name no price in EUR).
DECIMAL = r"\d+\.\d+"


#: Elements of which only the advertisement blocks have a class.
_PARTS = "(?:div|nav|footer)"


@register("page_classed_items", f"""
WITH i AS (
  SELECT page_id, unnest(l) AS item, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_pos
  FROM (SELECT page_id, {_elements_sql('html', _PARTS)} AS l FROM pages))
SELECT page_id, item_pos, regexp_extract(item, '^<[^>]* class="([^"]*)"', 1) AS product_id,
       nullif(regexp_extract(item, '<a href="([^"]*)"', 1), '') AS product_link
FROM i WHERE regexp_matches(item, '^<[^>]* class="[^"]+"')""")
def page_classed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by an attribute that most elements lack: those without it are dropped."""
    return W.page_items(_pages(spark, sf_dir), tag=_PARTS, classes=(), id_attr="class", link_class=None)


@register("page_ads", f"""
WITH i AS (
  SELECT page_id, unnest(l) AS item, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS item_pos
  FROM (SELECT page_id, list_filter({_elements_sql('html', _PARTS)},
          lambda e: regexp_matches(e, '^<[^>]* class="([^"]* )?ad( [^"]*)?"')) AS l FROM pages))
SELECT page_id, item_pos AS block_pos, coalesce({_plain(f"({_elements_sql('item', 'h1')})[1]")}, 'info_' || item_pos) AS header,
       coalesce(nullif(regexp_extract({_strip('item')}, '[0-9]+[.][0-9]+', 0), ''), 'N/A') AS price
FROM i WHERE starts_with(regexp_extract(item, ' class="([^"]*)"', 1), 'a') AND contains(regexp_extract(item, ' class="([^"]*)"', 1), 'd')""")
def page_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks whose class starts with one text and holds another; menus and footers have none."""
    return W.page_headers(_pages(spark, sf_dir), _PARTS, "a", "d", None, None, DECIMAL)


def _headers_sql(tag: str) -> str:
    return f"""
WITH b AS (
  SELECT page_id, unnest(l) AS block, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS block_pos
  FROM (SELECT page_id, {_elements_sql('html', tag)} AS l FROM pages))
SELECT page_id, block_pos,
  coalesce({_plain(f"({_elements_sql('block', 'h1')})[1]")}, 'info_' || CAST(block_pos AS VARCHAR)) AS header,
  coalesce(nullif(regexp_extract({_strip('block')}, '[0-9]+[.][0-9]+', 0), ''), 'N/A') AS price
FROM b"""


@register("page_headers", _headers_sql("article"))
def page_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles have a header."""
    return W.page_headers(_pages(spark, sf_dir), "article", None, None, None, None, DECIMAL)


@register("page_block_headers", _headers_sql("div"))
def page_block_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisement blocks have none, so each falls back to its position."""
    return W.page_headers(_pages(spark, sf_dir), "div", None, None, None, None, DECIMAL)


@register("page_composition", f"""
WITH menus AS (
  SELECT page_id, unnest(l) AS part, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS part_pos
  FROM (SELECT page_id, {_elements_sql('html', 'nav')} AS l FROM pages))
SELECT page_id, part_pos, coalesce({_plain(f"({_elements_sql('part', 'a')})[1]")}, 'N/A') AS part_name,
       list_filter(list_transform({_elements_sql('part', 'li')}, lambda e: {_plain('e')}), lambda e: e IS NOT NULL) AS shares
FROM menus""")
def page_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' menus stand in for product compositions: name of the first entry, all entries."""
    return W.composition(_pages(spark, sf_dir), tag="nav", part=None, name_tag="a", name_part=None)


@register("page_category_lists", f"""
WITH {_DISTINCT_SQL}
SELECT page_id, category, count(*) AS n_links, string_agg(href, ' ' ORDER BY first_pos) AS links
FROM c WHERE category IS NOT NULL GROUP BY page_id, category""")
def page_category_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.category_lists(W.categorise_links(_pages(spark, sf_dir), CATEGORIES))


def _syn_case(x: str) -> str:
    whens = " ".join(f"WHEN '{name}' THEN [{', '.join(repr(t) for t in syn)}]" for name, syn in W.CATEGORIES)
    return f"CASE {x} {whens} ELSE []::VARCHAR[] END"


@register("page_links_by_page_menu", f"""
WITH pg AS (
  SELECT page_id, list_filter(list_transform(
      regexp_extract_all(regexp_extract(html, '{W.NAV_BLOCK}', 1), '{W.ANCHOR_BODY}', 1),
      lambda x: replace(lower({_trim(_strip('x'))}), 'ñ', 'n')),
    lambda x: x <> '') AS names
  FROM pages),
cat AS (
  SELECT page_id, list_transform(list_filter(names, lambda x, i: list_position(names, x) = i),
      lambda n, i: {{'cat_pos': i - 1, 'category': n, 'terms': list_concat({_syn_case('n')}, [n])}}) AS cats
  FROM pg),
a AS (
  SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT page_id, {_HREF_SQL} AS l FROM pages)),
d AS (SELECT page_id, href, CAST(min(pos) AS INTEGER) AS first_pos FROM a GROUP BY 1, 2),
m AS (
  SELECT d.page_id, d.href, d.first_pos,
         list_filter(cat.cats, lambda c: len(list_filter(c.terms, lambda t: instr(lower(d.href), t) > 0)) > 0)[1] AS hit
  FROM d JOIN cat USING (page_id))
SELECT page_id, href, first_pos, hit.category AS category,
       list_filter(hit.terms, lambda t: instr(lower(href), t) > 0)[1] AS term
FROM m WHERE hit IS NOT NULL""")
def page_links_by_page_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.categorise_by_page_menu(_pages(spark, sf_dir))


@register("page_names", "SELECT page_id, string_split(url, '/')[-1] AS name FROM pages")
def page_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last part of each page's address."""
    return read_table(spark, sf_dir, "pages").select("page_id", base_name(F.col("url")).alias("name"))
