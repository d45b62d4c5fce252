import html
import re

import pytest

from eventide.llm import style_tree as S


def text(page, low=()):
    return S.text_of(S.parse(page), set(low))


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain text", "plain text"), ("<p>a\n  b<p>c", "a b c"), ("<p>a &amp;&lt; &eacute;&#33;</p>", "a &< é!"),
    ("<article>x<b>y</b>z</article>", "xyz"), ("<div>a<br>b</div>", "a b"), ("<nav>menu</nav><p>x</p>", "x"),
    ("<div class='ad'>buy</div><p>x</p>", "x"), ("<div class=\"main-content\">x</div>", "x"), ("<p>x</p><!-- c --><p>y", "x y"),
    ("<script>var t='</p>';</script><p>x", "x"), ("<style>p{}</style>x<textarea>f</textarea>", "x"), ("<p>1 < 2 & 3", "1 < 2 & 3"),
    ("<ul><li>a<li>b</ul>", "a b"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("</div><p>x</span></p>", "x"),
    ("<div id=comments><p>no</p></div><main><p>yes</p><div class='share'>no</div></main><p>out</p>", "yes"),
    ("<article><h1>T</h1><p>one</p><footer>f</footer></article><footer>g", "T one"), ("<p title=\"a>b\">x</p>", "x"),
    ("<html><body><form>f</form><p>a</p><aside>s</aside><noscript>n</noscript>", "a"), ("<P CLASS=Sidebar>no<P>yes", "yes"), ("<p", ""),
    ("<div class='cookie-notice'>c</div>t", "t"), ("a<span> b</span> c", "a b c"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 5000 + "deep", "deep")])
def test_text_of_pages(page, want):
    assert text(page) == want


def site(n, host="a.example"):
    """Pages without semantic tags: chrome only shows by repeating."""
    pages = []
    for i in range(n):
        body = f"<div class='x1'><span>Home</span></div><div class='x2'><p>Story {host} {i} tells of {i * 7}</p>" + \
            "".join(f"<p>part {i}.{k}</p>" for k in range(i % 4)) + "</div><div class='x3'>All rights reserved</div>"
        want = " ".join([f"Story {host} {i} tells of {i * 7}"] + [f"part {i}.{k}" for k in range(i % 4)])
        pages.append((i, f"http://{host}/{i}", f"<html><body>{body}</body></html>", want))
    return pages


def test_repeated_branches_of_a_site_go(spark):
    pages = site(12) + [(100 + i, u, h, w) for i, u, h, w in site(9, "b.example")]
    single = (500, "http://lone.example/", "<body><div class='x1'><span>Home</span></div><p>t</p></body>", "Home t")
    copies = [(600 + k, "http://copy.example/", "<body><div><p>The same page</p></div></body>", "The same page") for k in range(8)]
    odd = [(700, None, None, ""), (701, "", "", ""), (702, "http://a.example/z", None, ""), (None, "http://q/", "<p>x", "x")]
    rows = [(i, u, h, 3, "t") for i, u, h, _ in pages + [single] + copies + odd]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string").repartition(5)
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in S.main_text(df).collect()}
    assert got == {i: (u, w, len(w)) for i, u, _h, w in pages + [single] + copies + odd}


def test_importance_of_branches(spark):
    """Own entropy by hand: 4 pages, branch c shows two texts equally often."""
    pages = [(i, "http://h/", f"<body><p class='c'>{'xy'[i % 2]}</p><p class='d'>same</p><p class='e'>{i}</p></body>", ) for i in range(4)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", S.url_host(S.F.col("url")))
    counts = S.branch_counts(df)
    low = lambda x: {r["node"] for r in S.low_branches(counts, x, 0.9, 3).collect()}
    c, d, e = (S.key(f"/body/p.{k}") for k in "cde")
    assert d in low(0.4) and c not in low(0.4) and c in low(0.6) and e not in low(0.99)


def kept(spark, pages):
    df = spark.createDataFrame([(i, "http://h.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in S.main_text(df.repartition(4)).collect()}


def test_repeated_block_inside_an_article_goes(spark):
    """A neutral class that shows the same on every page; emphasis inside a text stays whole."""
    page = "<body><article><h1>Title {0}</h1><div class='x1'>Read our other stories</div><p>Text <b>of</b> {0}</p></article></body>"
    assert kept(spark, [page.format(i) for i in range(12)]) == {i: f"Title {i} Text of {i}" for i in range(12)}
    alike = "<body><p class='day{0}'>{0}</p><article><p>One article under many addresses</p></article></body>"
    assert set(kept(spark, [alike.format(i) for i in range(12)]).values()) == {"One article under many addresses"}


@pytest.mark.parametrize("n", [3, 100, 10_000])
def test_texts_stay_on_hosts_of_any_size(spark, n):
    """A text cut by line breaks, and one 30 levels below a frame that every page shares."""
    deep = "<div class='a'>" * 30 + "<p>leaf {0}</p>" + "</div>" * 30
    page = "<body><div class='x1'>Home</div><div class='c'>unique {0}<br>more</div>" + deep + "</body>"
    assert kept(spark, [page.format(i) for i in range(n)]) == {i: f"unique {i} more leaf {i}" for i in range(n)}


@pytest.mark.parametrize("n", [3, 100, 3000])
def test_repeated_paragraph_among_others_goes(spark, n):
    """An unmarked notice between paragraphs, at another place on each page; unique ones stay, and on a host of
    three pages all of it, as three pages tell too little."""
    def page(i, with_notice=True):
        ps = [f"Part {i}.{k} of the story" for k in range(2 + i % 3)]
        if with_notice:
            ps.insert(i % len(ps), "Share this <b>story</b> with friends")
        return f"<body><article><h1>Title {i}</h1>" + "".join(f"<p>{x}</p>" for x in ps) + "</article></body>"
    want = {i: " ".join([f"Title {i}"] + re.findall("<p>(.*?)</p>", page(i, n < 7).replace("<b>", "").replace("</b>", ""))) for i in range(n)}
    assert kept(spark, [page(i) for i in range(n)]) == want


def test_paragraphs_that_half_of_the_pages_share_stay(spark):
    """Near copies under several addresses are no chrome; a page whose only paragraph is the notice loses it."""
    shared = "".join(f"<p>Common paragraph {k}</p>" for k in range(3))
    pages = [f"<article>{shared if i % 2 else ''}<p>Own {i}</p><p>More {i}</p><p>Notice</p></article>" for i in range(40)]
    got = kept(spark, pages + ["<article><p>Notice</p></article>"])
    common = "Common paragraph 0 Common paragraph 1 Common paragraph 2 "
    assert got == {i: f"{common if i % 2 else ''}Own {i} More {i}" for i in range(40)} | {40: ""}


def test_block_key_is_the_one_of_the_list(spark):
    df = spark.createDataFrame([(5, 9), (S.key("/a/p"), S.key("x")), (0, 0)], "node long, seen long")
    got = df.select("node", "seen", (-S.F.col("node").bitwiseXOR(S.F.shiftright("seen", 1)) - 1).alias("k")).collect()
    assert all(r["k"] == S.block_key(r["node"], r["seen"]) < 0 for r in got)


def test_empty_table(spark):
    assert S.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_table_holds_the_articles(spark, sf):
    got = {r["page_id"]: r["text"] for r in S.op5_style_tree(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        blocks = re.sub(r"<[^>]*>", "\x00", re.sub(r"</?b>", "", body)).split("\x00")
        want = " ".join(x for x in (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks) if x)
        assert got[r["page_id"]] == want


def test_a_hot_host_is_dealt_over_parts_with_its_whole_list(spark):
    """One host holds nearly all pages: its rows carry many parts, and all get its list."""
    pages = site(300) + [(1000 + i, u, h, w) for i, u, h, w in site(3, "b.example")]
    rows = spark.createDataFrame([(i, u, h) for i, u, h, _ in pages], "_id long, _url string, html string").withColumn("host", S.url_host(S.F.col("_url")))
    low = spark.createDataFrame([("a.example", [1, 2]), ("gone.example", [3])], "host string, low array<long>")
    out = S.dealt(rows, low).collect()
    assert len(out) == len(rows.collect()) and len({r["_part"] for r in out if r["host"] == "a.example"}) > 100
    assert all((r["low"] == [1, 2]) if r["host"] == "a.example" else r["low"] is None for r in out)
    assert {r["_id"] for r in out} == {p[0] for p in pages}
