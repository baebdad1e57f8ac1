import collections
import math
import time

import helpers
import pytest

from cohortmine.llm import html_text as ht


def main(html):
    return "\n".join(ht.blocks(ht.parse(html)))


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("plain text", "plain text"),
    ("<p>a&amp;b &lt;i&gt; &eacute;&#233;&#xe9;</p>", "a&b <i> ééé"),
    ("<p>one\n  two\t<b>th</b>ree</p><p> </p><p>four", "one two three\nfour"),
    ("<body><nav><p>menu</p></nav><header>top</header><article><h1>T</h1><p>x<p>y</article><footer>end</footer>", "T\nx\ny"),
    ("<article><p>a<script>if (a<b) '</p>'</script>b<style>p{}</style><!-- <p>c</p> -->d</p></article>", "abd"),
    ("<article><p>text</p><div class='ad'>buy</div><form><p>mail</p></form><aside>side</aside></article>", "text"),
    ("<article><p>text</p><section id='comments'><article class='comment'><p>reader</p></article></section></article>", "text"),
    ("<div class='cookie-notice'>ok?</div><main><p>m</p></main><div class=sidebar><p>s</p></div>", "m"),
    ("<article><p>cut off<p>in the <b>midd", "cut off\nin the midd"),
    ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\nc\nd\n1\n2\n3"),
    ("<p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p>", "yes"),
    ("<article>before<br>after<hr>end</article>", "before\nafter\nend"),
    ("<p title=\"a>b\">x</p><p class='header'>h</p>", "x"),
    ("<article><header><h1>Title</h1></header><p>p</p><footer>f</footer></article>", "Title\np"),
    ("a <![CDATA[ b < c ]]> d <?php x ?> e", "a b < c d e"),
    ("</p></div><p>stray ends</p></article>", "stray ends"),
    ("<div class='readers'>kept</div><div class='adventure'>kept too</div>", "kept\nkept too"),
    ("1 < 2 and 3 > 2 <", "1 < 2 and 3 > 2 <"),
])
def test_pages(html, want):
    assert main(html) == want


def _site(spark, n=12):
    pages = []
    for i in range(n):
        body = (f"<div class=top><p>Welcome to the site</p></div><div class=story><p>Story {i} about {i * i}.</p>"
                f"<p>More on {i}.</p></div><div class=bottom><p>All rights reserved</p></div>")
        pages.append((i, f"http://a.example.com/{i}", f"<html><body>{body}</body></html>"))
    pages.append((90, "http://b.example.com/1", "<html><body><div class=top><p>Welcome to the site</p></div></body></html>"))
    return spark.createDataFrame(pages, "page_id long, url string, html string")


def test_template_parts_of_a_site_are_cut(spark):
    got = {r["page_id"]: r["text"] for r in ht.extract(_site(spark)).collect()}
    assert got[3] == "Story 3 about 9.\nMore on 3."
    assert got[90] == "Welcome to the site"  # one page says nothing about its site


def test_copies_do_not_make_a_template(spark):
    one = ("http://c.example.com/x", "<html><body><div class=story><p>The same story</p></div></body></html>")
    df = spark.createDataFrame([(i, *one) for i in range(30)], "page_id long, url string, html string")
    assert {r["text"] for r in ht.extract(df).collect()} == {"The same story"}


def test_article_is_never_thinned(spark):
    rows = [(i, f"http://d.example.com/{i}", f"<body><article><p>Shared line</p><p>own {i}</p></article></body>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in ht.extract(df).collect()}
    assert got[7] == ("Shared line\nown 7", 17)


def test_entropies(spark):
    tree = {(r["host"], r["path"]): r for r in ht.style_tree(_site(spark)).collect()}
    top = tree["a.example.com", "/html/body/div.top"]
    assert top["pages"] == 12 and top["content"] == 0 and top["presentation"] == 0
    assert tree["a.example.com", "/html/body/div.story"]["content"] == pytest.approx(1)
    assert tree["b.example.com", "/html/body/div.top"]["content"] == 1


def test_hosts(spark):
    urls = ["http://www.A.example.com:80/x?y", "https://u:p@b.example.org#t", "//c.example.net", "nothing", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(ht.host_of(df["url"])).collect()] == ["a.example.com", "b.example.org", "c.example.net", "", ""]


def test_query(spark, sf):
    rows = ht.op5_html_extraction(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) and "<" not in r["text"] and "©" not in r["text"] for r in rows)


@pytest.mark.parametrize("html, want", [
    ("<div class='content no-sidebar'><article><p>text</p></article></div>", "text"),
    ("<div id='post-with-comments'><article><p>text</p></article><p>more</p></div>", "text"),
    ("<section class='main widget-area'><div><main><p>text</p></main></div></section>", "text"),
    ("<main><div class='widget-area'><article><p>text</p></article></div></main>", "text"),
    ("<div class=widget><article><p>text</p></article></div>", "text"),
    ("<article><p>text</p></article><div class='related'><article><p>teaser</p></article></div>", "text"),
    ("<article><p>text</p></article><section id=comments><article><p>reader</p></article></section>", "text"),
    ("<aside class='no-sidebar'><article><p>teaser</p></article></aside><p>text</p>", "text"),
])
def test_wrappers_of_the_article_are_not_cut_by_name(html, want):
    assert main(html) == want


@pytest.mark.parametrize("name", ["class='comment'", "class='reply even'", "id='comment-12'"])
def test_comments_nested_in_the_article_are_cut(name):
    assert main(f"<article><p>text</p><article {name}><p>reader</p></article></article>") == "text"
    assert main("<article><p>text</p><article class='part'><p>second</p></article></article>") == "text\nsecond"
    assert main(f"<main><article {name}><p>text</p></article></main>") == "text"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_template_branches_inside_the_article_are_cut(spark, tag):
    rows = [(i, f"http://e.example.com/{i}", f"<body><{tag}><div class=body><p class=lead>Shared line</p><p>own {i}</p></div>"
             f"<div class=writer><p>By the desk</p><p>Write to us</p></div></{tag}></body>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in ht.extract(df).collect()}
    assert got == {i: f"Shared line\nown {i}" for i in range(20)}


@pytest.mark.parametrize("html, text", [
    ("<a " * 330_000 + '"', None),
    ("<![CDATA[>" * 100_000, ""),
    ("<div>" * 200_000 + "deep", "deep"),
    ("<p><table>" + "<div>" * 200_000 + "deep", "deep"),
    ("<div>" * 80_000 + "</span>" * 80_000 + "x", "x"),
    ('<a "x" ' * 140_000 + "'", None),
    ('<div class="' + "a" * 500_000 + '">' + "<b>x</b>" * 60_000, "x" * 60_000),
])
def test_hostile_pages_take_linear_time(html, text):
    start = time.process_time()
    top = ht.parse(html)
    got = "\n".join(ht.blocks(top))
    ht.style_nodes(top)
    assert time.process_time() - start < 20  # minutes to hours in quadratic time
    assert got == (html.strip() if text is None else text)


def test_long_paths_still_tell_elements_apart():
    deep = "".join(f"<div class=c{i}>" for i in range(400))
    paths = ht.style_nodes(ht.parse(deep + "<i>a</i><b>b</b>"))
    assert len(paths) == 402 and max(map(len, paths)) < 2 * ht.LONG_PATH


def _plain_tree(pages):
    """(host, path) -> (pages, presentation, content) from texts and tags themselves, no hashes."""
    seen = {}
    for host, html in {(p["url"].split("/")[2].removeprefix("www."), p["html"] or "") for p in pages}:
        page = {}

        def walk(node, html_path, page=page):
            texts = []
            path = f"{html_path}/{node.path.rsplit('/', 1)[-1]}"
            at = len(page.setdefault(path, []))
            page[path].append(None)
            for c in node.children:
                if isinstance(c, str):
                    texts += [t for t in [" ".join(c.split())] if t]
                elif not c.noise:
                    texts += walk(c, path)
            page[path][at] = (tuple(c.tag for c in node.children if not isinstance(c, str)), tuple(texts))
            return texts

        for c in ht.parse(html).children:
            if not isinstance(c, str) and not c.noise:
                walk(c, "")
        for path, found in page.items():
            shape, words = tuple(s for s, _ in found), tuple(t for _, w in found for t in w)
            seen.setdefault((host, path), []).append((shape, words))

    def share(values):
        n = len(values)
        counts = collections.Counter(values).values()
        return 1.0 if n == 1 else -sum(c / n * math.log2(c / n) for c in counts) / math.log2(n)

    return {k: (len(v), share([s for s, _ in v]), share([w for _, w in v])) for k, v in seen.items()}


def test_style_tree_equals_a_plain_one(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {(r.host, r.path): (r.pages, r.presentation, r.content) for r in ht.style_tree(pages).collect()}
    want = _plain_tree(helpers.table(sf, "pages"))
    assert got.keys() == want.keys() and want
    for k, (n, shape, words) in want.items():
        assert got[k][0] == n and got[k][1:] == pytest.approx((shape, words), abs=1e-9)


def test_extraction_cuts_what_the_plain_tree_rates_low(spark):
    pages = [{"page_id": i, "url": f"http://h.example.org/{i}", "html":
              f"<html><body><div class=k1><p>Same on all</p></div><div class=k2><p>Own text {i}</p></div></body></html>"}
             for i in range(16)]
    tree = _plain_tree(pages)
    low = {p for (_, p), (n, s, w) in tree.items() if n >= ht.MIN_PAGES and max(s, w) < ht.MIN_IMPORTANCE} - {"/html"}
    want = {p["page_id"]: "\n".join(ht.blocks(ht.parse(p["html"]), frozenset(low))) for p in pages}
    rows = ht.extract(spark.createDataFrame([(p["page_id"], p["url"], p["html"]) for p in pages], "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in rows.collect()} == want == {i: f"Own text {i}" for i in range(16)}
