from html.parser import HTMLParser

import pytest

from postflow.llm.html_text import BLOCK, VOID, extract_main_text, node_importance, page_blocks

SITE = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav>{}"
        "<footer>&copy; x</footer></body></html>")


def text_of(page, url="http://h/1"):
    return "\n".join(b["text"] for b in page_blocks(page, url)[0])


@pytest.mark.parametrize("page,wanted", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"),
    ("<article><h1>A&nbsp; b</h1><p>one<br>two <b>th</b>ree<p>four</article>", "A b\none two three\nfour"),
    ("<p>out<article><p>in</p><aside>no</aside><div class='ad-box x'>no</div><p>too</article><p>out", "in\ntoo"),
    ("<article>a<script>if (a<b) '</p>'</script>b<!-- <p>c -->d<style>x</style></article>", "abd"),
    ("<article><header><h1>Head</h1></header><section id=comments><p>me</p></section><p>x</article>", "Head\nx"),
    ("<main><p>m</p><form><input>f</form></main><div>o</div>", "m"),
    ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul>e</article>", "a\nb\nc\nd\ne"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<article><p>a < b & c &lt;i&gt; &#x41;&#66; &amp <p title='>'>d", "a < b & c <i> AB &\nd"),
    ("<div role=navigation>n</div><article>one</article><article>two</article>", "one\ntwo"),
    ("<article><p>unclosed <b>bold<p>next</article>after", "unclosed bold\nnext"),
    ('<div class="layout no-sidebar"><article><p>text</article></div><div class=sidebar>s</div>', "text"),
    ('<article><div class="post-content share-enabled"><p>one<p>two</div></article>', "one\ntwo"),
    ('<article><div class="entry-header"><h1>Title</h1></div><p>text</article>', "Title\ntext"),
    ('<article><div class="post-header"><h1>Title</h1></div><p>text<div class="post-comments">me</div></article>', "Title\ntext"),
    ('<div class="sidebar page"><main><p>text</main><p class=ad>buy</div>', "text"),
    ('<form id=aspnet><article><p>text</article><div class=menu>m</div></form>', "text"),
    ('<div class="content share">the only long text</div><div class="menu">m</div>', "the only long text"),
    ('<article>.<div class="related">a long list of other texts</div></article>', ".\na long list of other texts"),
    ('<div class=ad>longer than the article</div><article>x</article>', "x"),
    ("<article><p>x<unknown-tag a=\"1>2\">y</unknown-tag>z</article>", "xyz"),
])
def test_blocks(page, wanted):
    assert text_of(page) == wanted


def test_pages_keep_their_rows(spark):
    rows = [(1, "http://a/1", SITE.replace("{}", "<article><p>one</article>")), (1, "http://a/1", None), (None, None, ""),
            (2, "not a url [", SITE.replace("{}", "<article>" + "<p>w" * 20_000 + "</article>"))]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows],
                               "page_id long, url string, html string, text string, n_chars int")
    got = extract_main_text(df).collect()
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    assert sorted((repr(r.page_id), repr(r.url), r.text, r.n_chars) for r in got) == sorted(
        [("1", "'http://a/1'", "one", 3), ("1", "'http://a/1'", "", 0), ("None", "None", "", 0),
         ("2", "'not a url ['", "\n".join("w" * 20_000), 39_999)])
    assert extract_main_text(df.filter("page_id = 0")).collect() == []


def test_site_style_tree_drops_what_pages_share(spark):
    """Without semantic markup: the block that every page repeats goes, the text of its own stays."""
    def page(i):
        own = "".join(f"<p>page {i} line {j}</p>" for j in range(1 + i % 5))
        return f"<body><div class=top><span>Welcome to the site</span></div><div class=text>{own}</div></body>"

    rows = [(i, f"http://h/{i}", page(i)) for i in range(12)] + [(99, "http://alone/", "<body><div>single</div></body>")]
    got = {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == "\n".join(f"page {i} line {j}" for j in range(1 + i % 5))
    assert got[99] == "single"


def extracted(spark, rows):
    return {r.page_id: r.text for r in extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_what_every_page_repeats_inside_its_article_goes(spark):
    """Also where it has the path of the text's own paragraphs; a text that few pages share stays."""
    def page(i):
        own = f"<p>page {i} text</p><p>told twice {i // 2}</p>"
        return SITE.replace("{}", f"<article><h1>Title {i}</h1>{own}<p>Follow us for more</p></article>")

    rows = [(i, f"http://h/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://h/{i}", page(3)) for i in range(40)]  # copies are no site-wide text
    rows += [(200 + i, "http://two/", "<article><p>same text</p><p>%d</p></article>" % i) for i in range(2)]
    got = extracted(spark, rows)
    for i in range(12):
        assert got[i] == f"Title {i}\npage {i} text\ntold twice {i // 2}"
    assert {got[100 + i] for i in range(40)} == {got[3]}
    assert [got[200 + i] for i in range(2)] == ["same text\n0", "same text\n1"]


def test_text_beside_teaser_cards_stays(spark):
    def page(i):
        return ("<body><div class=top><span>Welcome to the site</span></div><div class=text>"
                + "".join(f"<p>page {i} line {j} of a text that is long</p>" for j in range(4))
                + f"</div><article><p>teaser {i}</p></article></body>")

    def marked(i):
        return (f"<body><div class=top><span>Welcome {i}</span></div><article><p>"
                + f"page {i} of a long text </p>" * 9 + "</article></body>")

    rows = [(i, f"http://h/{i}", page(i)) for i in range(12)] + [(50 + i, f"http://k/{i}", marked(i)) for i in range(12)]
    got = extracted(spark, rows)
    for i in range(12):
        lines = [f"page {i} line {j} of a text that is long" for j in range(4)]
        assert got[i] == "\n".join([*lines, f"teaser {i}"])
        assert "Welcome" not in got[50 + i] and got[50 + i].startswith(f"page {i} of")


def test_importance_of_shared_and_own_texts(spark):
    features = [(r, [(1, True, 5)] + [(2, True, 100 + r)] + [(3, False, r % 2)]) for r in range(8)]
    parsed = spark.createDataFrame(features, "rid long, features array<struct<node:long,kind:boolean,feature:long>>")
    content, style = node_importance(parsed)
    found = {r.node: r.content for r in content.collect()}
    assert found[1] == pytest.approx(0) and found[2] == pytest.approx(1)
    assert {r.node: r.style for r in style.collect()}[3] == pytest.approx(1 / 3)


class Reference(HTMLParser):
    """A second extraction, for pages as the tables hold them: the text of ``article``, one line per block."""

    def __init__(self):
        super().__init__()
        self.open, self.lines, self.skipped = [], [""], 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK or tag == "p":
            self.lines.append("")
        if tag == "br":
            self.lines[-1] += " "
        if tag in VOID or tag == "p":
            return
        bad = tag in ("nav", "aside", "footer", "form", "script", "style", "button") or ("class", "ad") in attrs or (
            "comments" in str(dict(attrs).get("class")) + str(dict(attrs).get("id")))
        self.open.append((tag, bad))

    def handle_endtag(self, tag):
        if tag in BLOCK or tag == "p":
            self.lines.append("")
        names = [t for t, _ in self.open]
        if tag in names:
            del self.open[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.open) and not any(bad for _, bad in self.open):
            self.lines[-1] += data


def test_all_pages_of_a_table(spark):
    """Against a second parser, on every page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        parser = Reference()
        parser.feed(r.html)
        parser.close()
        want[r.page_id] = "\n".join(filter(None, (" ".join(line.split()) for line in parser.lines)))
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    assert len(got) > 100 and sum(got[i] == want[i] for i in want) == len(want)
