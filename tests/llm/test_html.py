import pytest

from layerwright.llm import html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>T &eacute;&#39;s</h1></header><p>One <a href=x>two</a>
 three<br>four<span class="ad">Buy</span><div class="share">Share</div><ul><li>a<li>b</ul><pre>x
 y</pre><script>var a = "</p>";</script><section id="comments"><article class="comment"><p>c!</p></article></section>
</article></main><aside>side</aside><form>f<input></form><footer>ft</footer></body></html>"""


def text_of(page, constant=None):
    root = html.parse(page)
    html.skeleton(root)
    return "\n".join(html.main_blocks(root, constant or {}))


def test_article_only():
    assert text_of(PAGE) == "T é's\nOne two three four\na\nb\nx y"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("plain text", "plain text"),
        ("", ""),
        ("<p>a<p>b</p></p>c", "a\nb\nc"),
        ("<p><b>a<br><p>b", "a\nb"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("a &lt;b&gt; &amp;amp &nope; &#x41;", "a <b> &amp &nope; A"),
        ("<p title='a>b'>x</p><p unclosed", "x"),
        ("<script>never closed <p>x", ""),
        ("<!-- <p>x</p> -->y<!-- open", "y"),
        ("<td>a<td>b", "a\nb"),
        ("</p></div>a", "a"),
        ("<P>A</P><DIV CLASS=Sidebar>b</DIV>", "A"),
        ("<p>a  b</p>", "a b"),
        ('<p hidden>a</p><p style="display: none">b</p>c', "c"),
    ],
)
def test_broken_and_odd_pages(page, text):
    assert text_of(page) == text


def brute_matching(one, other):
    """Simple tree matching by plain recursion over all alignments."""
    if one[0] != other[0]:
        return 0

    def best(left, right):
        if not left or not right:
            return 0
        return max(best(left[1:], right), best(left, right[1:]), brute_matching(left[0], right[0]) + best(left[1:], right[1:]) if left[0][0] == right[0][0] else 0)

    return 1 + best(one[1], other[1])


def test_matching_equals_plain_recursion():
    import random

    rng = random.Random(3)

    def tree(depth):
        return [rng.choice("ab"), [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []]

    for _ in range(60):
        a, b = tree(2), tree(2)
        assert html.simple_tree_matching(a, b, {}) == brute_matching(a, b)


def page(i, extra=""):
    return (
        f"<html><body><div><p>Read our terms</p>{extra}<p>story {i} words</p></div><div><p>more {i}</p></div>"
        f"<div><div><p>Read also the archive</p></div></div></body></html>"
    )


def test_constant_texts_of_a_host_are_template(spark):
    rows = [(i, f"http://a.example/{i}", page(i, "<h2>new</h2>" if i % 3 == 0 else "")) for i in range(12)]
    rows += [(100, "http://b.example/1", page(1)), (101, None, page(2)), (102, "http://a.example/x", None), (103, "::bad url", "")]
    frame = spark.createDataFrame([(*r, 1, "h") for r in rows], "page_id long, url string, html string, tree int, host string")
    out = {r.page_id: r for r in html.extracted(frame).collect()}
    assert out[1].text == "story 1 words\nmore 1"
    assert out[3].text == "new\nstory 3 words\nmore 3" or out[3].text == "story 3 words\nmore 3"
    assert out[100].text.startswith("Read our terms\nstory 1")  # one page tells nothing about its host
    assert out[101].text.endswith("more 2\nRead also the archive")
    assert (out[102].text, out[102].n_chars, out[103].text) == ("", 0, "")
    assert all(r.n_chars == len(r.text) for r in out.values())


def texts_by_page(spark, rows):
    frame = spark.createDataFrame([(i, "http://a.example/x", p) for i, p in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.extracted(frame).collect()}


def test_constant_texts_beside_many_others(spark):
    items = "".join(f"<li>entry {k}</li>" for k in range(30))  # a long constant list
    varying = lambda i: "".join(f"<p>story {i} part {k}</p>" for k in range(20))
    out = texts_by_page(spark, [f"<ul>{items}</ul><div><p>Read our terms</p>{varying(i)}</div>" for i in range(40)])
    assert out == {i: "\n".join(f"story {i} part {k}" for k in range(20)) for i in range(40)}


def test_constant_texts_of_nodes_beyond_the_template(spark, monkeypatch):
    rows = [f"<div><p>Read our terms</p><p>story {i}</p></div>" for i in range(12)]
    # pages whose places have other names each, so that the template is full; body classes that vary
    rows = [f"<body class={'ab'[i % 2]}>" + "".join(f"<div class=c{'xyz'[k % 3]}{'q' * k}>{r}</div>" for k in range(30)) for i, r in enumerate(rows * 2)]
    monkeypatch.setattr(html, "MAX_NODES", 10)
    out = texts_by_page(spark, [r.replace("story", f"story {i} of") for i, r in enumerate(rows)])
    assert not any("terms" in t for t in out.values()) and all(t.count("story") == 30 for t in out.values())


def test_copies_of_one_article_are_no_template(spark):
    rows = [(i, f"http://a.example/{i}", f"<nav>{i}</nav><article><p>same story</p></article>") for i in range(30)]
    out = html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in out} == {"same story"}


def test_empty_table(spark):
    assert html.extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_both_ways_to_the_templates_agree(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    first = sorted(html.extracted(pages).collect())
    monkeypatch.setattr(html, "BROADCAST_BYTES", -1)
    assert sorted(html.extracted(pages).collect()) == first and len(first) == pages.count()


DEEP = {
    "nested": "<div>" * 100_000 + "deep text" + "</div>" * 100_000,
    "unclosed": "<div>" * 100_000 + "deep text",
    "mixed": "<div><p><ul><li>" * 25_000 + "deep text",
    "tables": "<table><tr><td>" * 20_000 + "deep text",
    "ends without start": "<div>" * 50_000 + "</p></td></li>" * 20_000 + "deep text",
    "inline": "<b>" * 50_000 + "deep text",
}


def test_pages_of_any_depth(spark):
    rows = [(i, f"http://deep.example/{i}", page) for i, page in enumerate(DEEP.values())]
    rows += [(100 + i, f"http://deep.example/x{i}", f"<div>page {i}</div>") for i in range(10)]
    found = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == "deep text" for i in range(len(DEEP))) and found[103] == "page 3"


def test_text_around_deep_elements_keeps_its_order():
    n = 700
    page = "".join(f"<div>a{i} " for i in range(n)) + "".join(f"b{i} </div>" for i in reversed(range(n)))
    root = html.parse(page)
    html.skeleton(root)
    wanted = [f"a{i}" for i in range(n - 1)] + [f"a{n - 1} b{n - 1}"] + [f"b{i}" for i in reversed(range(n - 1))]
    assert html.main_blocks(root, {}) == wanted


def test_what_is_dropped_stays_dropped_however_deep():
    page = "<div>" * 300 + "<nav>menu<div>more <div>menu</div> still</div></nav>text<div class='ad'>buy<div>now</div></div>" + "</div>" * 300 + "end"
    root = html.parse(page)
    html.skeleton(root)
    assert html.main_blocks(root, {}) == ["text", "end"]


@pytest.mark.parametrize("name", ["post-comment-policy-article", "ad-hoc", "share-price", "relatedness", "headline", "adsorption"])
def test_class_words_count_as_a_whole(name):
    root = html.parse(f"<div class='{name}'>text</div>")
    html.skeleton(root)
    assert html.main_blocks(root, {}) == ["text"]


@pytest.mark.parametrize("name", ["ad", "site-footer", "cookieBanner", "ad-slot-3", "comment_list", "x sidebar", "nav-left"])
def test_classes_of_no_article(name):
    root = html.parse(f"<div class='{name}'>text</div>")
    html.skeleton(root)
    assert html.main_blocks(root, {}) == []


def test_a_template_alone_removes_what_its_pages_share(spark):
    """Neutral tags and classes: only the template tells menu and notice from the article, and a page's own text stays."""
    page = "<div class=x1>Home Products About</div><div class=x2><p>Own words of page {i} number {i}</p><p>second {j}</p></div><div class=x3>All of this is ours</div>"
    rows = [(i, f"http://same.example/{i}", page.format(i=i, j=i * 7)) for i in range(20)]
    frame = spark.createDataFrame(rows + [rows[0]], "page_id long, url string, html string")
    for name in ("host", "tree", "same", "salt"):
        frame = frame.selectExpr("*", f"'7' as {name}") if name not in frame.columns else frame
    found = html.extracted(frame).collect()
    assert len(found) == 21 and all(r.text == f"Own words of page {r.page_id} number {r.page_id}\nsecond {r.page_id * 7}" for r in found)
    alone = html.extracted(frame.limit(1)).first().text
    assert alone.startswith("Home Products About\n") and alone.endswith("All of this is ours")
    assert html.extracted(frame.limit(0)).count() == 0
