from tessera.operators import web as W

PAGE = (
    '<html><body><nav><ul>'
    '<li><a href="/woman/new">Woman</a></li><li><a href="/man/shirts">Man</a></li>'
    '<li><a href="/KIDS">Kids</a></li><li><a href="">empty</a></li><li><a>no href</a></li>'
    '<li><a href="/woman/new">again</a></li><li><a href="/hombre">H</a></li>'
    '</ul></nav>'
    '<ul><li class="product" data-productid="P1"><a class="product-link" href="/p/1">Dress</a></li>'
    '<li class="product"><span>no link</span></li></ul>'
    '<article><h1 class="header-name">  Linen Dress </h1><p>Now 29,95 EUR instead of 40 EUR</p>'
    '<ul><li>60% cotton</li><li>40% linen</li></ul></article>'
    '<article><p>No header, no price</p></article>'
    '</body></html>'
)


def _pages(spark):
    return spark.createDataFrame([(1, PAGE)], "page_id BIGINT, html STRING")


def test_links_and_categories(spark):
    pages = _pages(spark)
    links = [r["href"] for r in W.page_links(pages).orderBy("link_pos").collect()]
    assert links == ["/woman/new", "/man/shirts", "/KIDS", "/woman/new", "/hombre", "/p/1"]
    cats = {r["href"]: (r["category"], r["term"], r["first_pos"]) for r in W.categorise_links(pages).collect()}
    # Unanchored, case-insensitive: "man" also matches "woman", and the first category wins.
    assert cats["/woman/new"] == ("hombre", "man", 0)
    assert cats["/man/shirts"][0] == "hombre"
    assert cats["/KIDS"] == ("ninos", "kids", 2)
    assert cats["/hombre"] == ("hombre", "hombre", 4)
    assert cats["/p/1"][0] is None
    whole = {r["href"]: r["category"] for r in W.categorise_links(pages, whole_word=True).collect()}
    assert whole["/woman/new"] == "mujer"
    left = {r["href"] for r in W.uncategorised_links(pages).collect()}
    assert left == {"/p/1"}
    assert len(cats) == W.links_by_category(pages).count() + len(left)


SHOP = (
    '<ul><li class="product-grid-product _product" data-productid="P1"><a class="x" href="/no"></a>'
    '<ul><li>inner</li></ul><a class="y product-link" href=\'/p/1?a=1&amp;b=2\'>Dress</a></li>'
    '<li class="product-grid-product _product other" data-productid="P2"><span>no link</span></li>'
    '<li class="product-grid-product _product"><a class="product-link" href="/p/3">no id</a></li>'
    '<li class="product-grid-product" data-productid="P4">one class only</li></ul>'
    '<div class="product-detail-view-x info"><div class="the-main"><h1 class="a header-name b">  Linen Dress </h1>'
    '<p>Now 29,95 EUR instead of 40 EUR</p></div></div>'
    '<div class="product-detail-view info2"><div class="main">none here</div></div>'
    '<div class="product-detail-view info3"><div class="secondary"><ul>'
    '<li class="composition-part"><span class="part-name">Outer</span><ul><li>60% cotton</li><li>40% linen</li></ul></li>'
    '<li class="composition-part">plain</li></ul></div></div>')


def test_items_headers_composition(spark):
    pages = spark.createDataFrame([(1, SHOP), (2, None), (3, "")], "page_id BIGINT, html STRING")
    items = [tuple(r) for r in W.page_items(pages).orderBy("item_pos").collect()]
    assert items == [(1, 0, "P1", "/p/1?a=1&b=2"), (1, 1, "P2", None)]
    assert [tuple(r) for r in W.first_item(pages).collect()] == items[:1]
    heads = [(r["block_pos"], r["header"], r["price"]) for r in W.page_headers(pages).orderBy("block_pos").collect()]
    assert heads == [(0, "Linen Dress", "29,95 EUR"), (1, "info_1", "N/A")]
    comp = [(r["part_name"], r["shares"]) for r in W.composition(pages).orderBy("part_pos").collect()]
    assert comp == [("Outer", ["60% cotton", "40% linen"]), ("N/A", [])]
    shares = [[tuple(m) for m in r[0]] for r in W.composition(pages).orderBy("part_pos").select(W.materials(W.F.col("shares"))).collect()]
    assert shares == [[(60, "cotton"), (40, "linen")], []]
    odd = spark.createDataFrame([(["95 % viscose, 5%elastane", "none", "7%"],)], "s ARRAY<STRING>").select(W.materials(W.F.col("s"))).first()[0]
    assert [tuple(m) for m in odd] == [(95, "viscose"), (5, "elastane")]
    val = spark.createDataFrame([("29,95 EUR",)], "p STRING").select(W.price_value(W.F.col("p")).alias("v")).first()
    assert abs(val["v"] - 29.95) < 1e-9


def test_links_of_either_quotes_only_from_anchors(spark):
    html = ('<article data-href="/no"></article><area href="/no"><abbr href="/no"></abbr><a data-href="/no" '
            "href='/one'>x</a><A\nHREF = \"/two?a=1&amp;b=2\">y</A><a href=''>z</a>")
    pages = spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING")
    assert [r["href"] for r in W.page_links(pages).orderBy("link_pos").collect()] == ["/one", "/two?a=1&b=2"]


def test_nested_elements_stay_whole(spark):
    html = "<li>a<ul><li>b</li></ul>c</li><li>d</li><lithium>e</lithium><li>open"
    row = spark.createDataFrame([(html,)], "h STRING").select(W.elements(W.F.col("h"), "li").alias("e")).first()
    assert row["e"] == ["<li>a<ul><li>b</li></ul>c</li>", "<li>d</li>"]


def test_category_lists_and_folding(spark):
    pages = _pages(spark)
    lists = {r["category"]: (r["n_links"], r["links"]) for r in W.category_lists(W.categorise_links(pages)).collect()}
    assert lists["hombre"] == (3, "/woman/new /man/shirts /hombre") and lists["ninos"] == (1, "/KIDS")
    from tessera.functions import fold_lower_ascii
    assert spark.createDataFrame([("NIÑOS",)], "c STRING").select(fold_lower_ascii(W.F.col("c"))).first()[0] == "ninos"


def test_categories_named_by_the_page_menu(spark):
    page = ('<html><nav><ul><li><a href="/c/mujer">Mujer</a></li><li><a href="/c/hombre"> Hombre </a></li>'
            '<li><a href="/c/ninos">NIÑOS</a></li><li><a href="/c/mujer">Mujer</a></li></ul></nav>'
            '<div><a href="/woman/dress">x</a><a href="/man/shirt">y</a><a href="/kids/toy">z</a>'
            '<a href="/sale">s</a></div></html>')
    pages = spark.createDataFrame([(1, page)], "page_id BIGINT, html STRING")
    got = {r["href"]: (r["category"], r["term"]) for r in W.categorise_by_page_menu(pages).collect()}
    assert got == {
        "/c/mujer": ("mujer", "mujer"), "/c/hombre": ("hombre", "hombre"), "/c/ninos": ("ninos", "ninos"),
        "/woman/dress": ("mujer", "woman"), "/man/shirt": ("hombre", "man"), "/kids/toy": ("ninos", "kids"),
    }
