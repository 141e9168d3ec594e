import pytest

from tidedesk.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script><style>p{}</style></head><body class="home">
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
<article><h1>Title &amp; more</h1><p><b>First line<br>second<p>Third &lt;3  x&nbsp;y</p><form><p>Mail</p></form>
<div class="comments"><p>first!</p></div><ul><li>one<li>two</ul></article>
<aside>side</aside><footer>&copy; host</footer></body></html>"""


def test_article():
    assert html.main_text(PAGE) == "Title & more First line second Third <3 x y one two"


@pytest.mark.parametrize("source,want", [
    (None, ""), ("", ""), ("plain", "plain"), ("a < b <b>c", "a < b c"), ("<p>a<p>b", "a b"), ("<article>x", "x"),
    ("<p>a</div></p>b", "a b"), ("<script>x", ""), ("<p class='x\">a</p>", "a"), ("<article></article><p>rest</p>", "rest"),
    ("<main><header><h1>H</h1></header>t</main>", "H t"), ("<header>h</header><div id=content>c</div>", "c"),
    ("<article>a<article class=comment>c</article></article>", "a"), ("a&ampb &am", "a&b &am"), ("<div>a<span>b</span>c</div>d", "abc d"),
])
def test_cases(source, want):
    assert html.main_text(source) == want


def test_long_pages_take_linear_time():
    assert html.main_text("<p>" * 20000 + "x") == "x"
    assert html.main_text('<a b="' * 20000) is not None
    assert len(html.main_text("<div>" * 3000 + "x y " * 100000)) == 399999


def test_site_templates_go_and_articles_stay(spark, tuples):
    def page(i, host, extra=""):
        return (i, f"https://{host}/{i}", f"<body><div><b>Welcome</b> to {host}</div><div><p>Body {i} {extra}</p></div></body>", 1)

    rows = [page(i, "a.com", "shared") for i in range(8)] + [page(100, "b.com")]
    rows += [(200 + i, "http://c.com/", "<body><div>same page</div></body>", 1) for i in range(8)]
    rows += [(300 + i, "http://d.com/", f"<article><p>License text</p><p>{i}</p></article>", 1) for i in range(8)]
    rows += [(400, None, None, 1)]
    got = dict(tuples(html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, subtrees int")), "page_id", "text"))
    assert got[3] == "Body 3 shared"
    assert got[100] == "Welcome to b.com Body 100"
    assert got[200] == "same page"
    assert got[305] == "License text 5"
    assert got[400] == ""
    assert len(got) == len(rows)


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_boxes_that_recur_in_articles_go():
    def page(i, box="<div class='box'>Like us on <b>Chirp</b></div>"):
        return f"<body><article><h1>Title {i}</h1><p>Own text of number {i}, long enough</p><p>License</p>{box}</article></body>"

    seen = [set(html.subtree_hashes(html.parse(page(i))).values()) for i in range(4)]
    template = set.intersection(*seen)
    assert html.main_text(page(7), template) == "Title 7 Own text of number 7, long enough License"
    # the body of near copies is no box
    copies = [f"<article><h1>{i}</h1><div>The whole story stands here</div></article>" for i in range(4)]
    shared = set.intersection(*[set(html.subtree_hashes(html.parse(c)).values()) for c in copies])
    assert html.main_text(copies[2], shared) == "2 The whole story stands here"


def site(hosts=3, pages=9):
    """Pages without article markup: menus whose links differ, a box on some pages, own text."""
    rows = []
    for h in range(hosts):
        for i in range(pages):
            menu = "".join(f"<li><a href='/{i}-{k}'>Go to {i} {k}</a></li>" for k in range(2 + i % 3))
            box = f"<section class='k'>Season notice of {h}</section>" if i < 4 else "<section class='k'>Only here {i}</section>"
            rows.append((h * 100 + i, f"http://h{h}.org/{i}", f"<body><div class='m'><ul>{menu}</ul></div><p>Own text {h} {i}</p>{box}</body>"))
    return [*rows, *rows[:5], (900, None, None), (901, "http://h0.org/x", "")]


def test_counting_against_brute_force(spark):
    rows = site()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    seen = {}
    for _, url, source in set((None, u.split("/")[2], s) for _, u, s in rows if u and s):
        for hs in html.all_hashes(html.parse(source)).values():
            for h in hs:
                seen.setdefault((url, h), set()).add(source)
    want = {k for k, pages in seen.items() if len(pages) >= html.MIN_PAGES}
    got = {(r.host, r.subtree) for r in html.site_templates(html.page_subtrees(df)).collect()}
    assert got == want and len(want) > 6


@pytest.mark.parametrize("limit", [html.BROADCAST_ROWS, -1])
def test_templates_decide_without_article_markup(spark, tuples, monkeypatch, limit):
    monkeypatch.setattr(html, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame(site(), "page_id long, url string, html string")
    out = html.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(site())
    got = dict(tuples(out, "page_id", "text"))
    assert got[102] == "Own text 1 2" and got[108] == "Own text 1 8 Only here {i}" or got[108] == "Own text 1 8"
    assert got[900] == "" and got[901] == ""
    assert html.main_text(site()[2][2]).startswith("Go to 2 0")


def test_what_recurs_does_not_depend_on_the_size_of_the_host(spark, tuples):
    box = "<div class='k'>Notice of the season</div>"
    rows = [(i, f"http://big.org/{i}", f"<body><p>Own {i}</p>{box if i < 5 else ''}</body>") for i in range(400)]
    got = dict(tuples(html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")), "page_id", "text"))
    assert got[3] == "Own 3" and got[399] == "Own 399"


def test_names_count_as_a_whole():
    page = ("<article><h1>T</h1><div class='share-price-table'><p>Prices</p></div><section id='search-theory'><p>Theory</p></section>"
            "<div class='share-buttons'>Share</div><div class='box cookie_bar'>Cookies</div><div id='related-posts-2'>More</div></article>")
    assert html.main_text(page) == "T Prices Theory"


def test_one_article_by_its_text():
    page = "<article class='teaser'>Short teaser</article><article><p>The long story</p><article>with a part</article></article><article>Another</article>"
    assert html.main_text(page) == "The long story with a part"


def test_menus_are_told_by_shape():
    def page(i):
        menu = "".join(f"<li class='x'><a href='/{i}{k}'>Link {i} {k}</a></li>" for k in range(3 + i))
        return f"<body><div><ul>{menu}</ul></div><p>Story {i} with <a href='#'>a link</a></p></body>"

    shared = set.intersection(*[{h for hs in html.all_hashes(html.parse(page(i))).values() for h in hs} for i in range(4)])
    assert html.main_text(page(9), shared) == "Story 9 with a link"
