"""Main text: cases of HTML, planted templates, counts by a plain version, odd rows."""

from collections import Counter, defaultdict

import pytest

from dealscope.llm import html_text
from dealscope.llm.queries import QUERIES

ARTICLE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<form id=f><div class="content with-sidebar"><article class=post><header class="entry-header"><h1>Title &amp; more</h1>
<p class=byline>by X</p></header><p>Para <b>one</b> <span class="share">Tweet</span> goes<br>on<p>Two &lt;b&gt; &eacute; &#8212; x</p>
<ul><li>a<li>b</ul><div class="ad">Buy</div><table><tr><td>c1<td>c2</table>
<section id="comments"><article class="comment">First!</article></section></article></div></form>
<aside><article>teaser</article></aside><footer>f</footer><script>var t="</p>";</script></body>"""


@pytest.mark.parametrize("source, blocks", [
    (ARTICLE, ["Title & more", "Para one goes on", "Two <b> é — x", "a", "b", "c1", "c2"]),
    ("<div class=menu><a>Home</a></div><p>Hello <i>w</i>orld and\n\tmore</p>x < y &copy 5<div>z", ["Hello world and more", "x < y © 5", "z"]),
    ("<main><nav>n</nav><p>m</p></main><p>out</p>", ["m"]),
    ("<div itemprop=articleBody><p>m<p hidden>no</div><p>out</p>", ["m"]),
    ("<!-- <p>no</p> --><p title='a>b'>yes<!-- open", ["yes"]),
    ("<body><div class='comment-list'>c c c c c c c c</div><p>short</p>", ["short"]),
    ("<p title=\"a>b>c", ["b>c"]), ("plain", ["plain"]), ("", []), ("<script>x", []), ("</p></div>", []),
])
def test_blocks(source, blocks):
    assert html_text.parsed(source).blocks == blocks


@pytest.mark.parametrize("source", ["<div>" * 50_000 + "x", "<b>" * 50_000, '<p title="' * 20_000, "<a '" * 20_000,
                                    "<script>" * 20_000, "<!--" * 20_000, "<" * 100_000, "<ul><li><b>x" * 20_000])
def test_odd_and_long_pages_end(source):
    html_text.parsed(source)


def page(body):
    return f"<html><body>{body}</body></html>"


def test_templates_of_a_host_go_and_copies_stay(spark):
    menu, note = "<div><i>Home</i> <i>News</i></div>", "<p>Read our weekly letter</p>"
    rows = [(i, f"https://a.example/{i}", page(f"{menu}<p>Text number {i} of this host</p>{note}")) for i in range(12)]
    # The same page again under many addresses is one page; another host has its own counts.
    rows += [(100 + i, f"https://b.example/{i}", page(f"{menu}<p>One story</p>")) for i in range(12)]
    rows += [(200 + i, f"https://c.example/{i}", page(f"<article><p>Story {i}</p>{note if i < 6 else ''}</article>")) for i in range(12)]
    rows += [(300, None, page(menu + "<p>x</p>")), (301, "https://a.example/n", None), (301, "https://a.example/n", ""),
             (None, "nowhere", page("<p>y</p>"))]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'k' AS key", "1 AS subtree", "2 AS marks")).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"Text number {i} of this host" for i in range(12))
    assert all(text[100 + i] == "Home News\nOne story" for i in range(12))
    assert text[203] == "Story 3\nRead our weekly letter" and text[209] == "Story 9"
    assert (text[300], text[301], text[None]) == ("Home News\nx", "", "y")
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty_table(spark):
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def plain(rows, least, share, loose):
    """Counts by a dictionary of all pages, without hashes of hosts."""
    pages = [(i, u, html_text.host_of(u), html_text.parsed(h or "")) for i, u, h in rows]
    texts, seen, count = defaultdict(set), set(), Counter()
    for _, _, host, p in pages:
        same = (host, "\n".join(p.blocks))
        if host and p.subtrees:
            texts[host].add(same)
            if same not in seen:
                seen.add(same)
                count.update({(host, mark) for mark, _, _ in p.subtrees})
    for i, u, host, p in pages:
        gone = set()
        for mark, a, b in p.subtrees:
            n = count[host, mark]
            if host and n >= least and n >= (share if p.marked else loose) * len(texts[host]):
                gone |= set(range(a, b))
        yield i, u, "\n".join(t for k, t in enumerate(p.blocks) if k not in gone)


def test_against_plain_counts(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [tuple(r) for r in frame.select("page_id", "url", "html").collect()]
    # Half of the pages without their marks, so that the counts alone decide; and with low shares.
    rows = [(i, u, h.replace("article>", "div>") if i % 2 else h) for i, u, h in rows]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.url, r.text) for r in html_text.main_text(frame, 2, 0.2, 0.05).collect())
    assert got == sorted(plain(rows, 2, 0.2, 0.05))
    assert got != sorted(plain(rows, 10**9, 1, 1))


def test_query_keeps_articles_whole(spark, sf_dir):
    for r in QUERIES["op11_html_text"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id").collect():
        article = r.html[r.html.index("<article>"):r.html.index("</article>")]
        assert r.text.replace("\n", " ").split() == html_text.html.unescape(html_text.re.sub(r"</?[a-z]\w*>", " ", article)).split()
