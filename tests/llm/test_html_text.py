"""op6: blocks of hand-written pages and the differencing of unmarked ones."""

import pytest

from .conftest import rows, with_clashes
from trackmart.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li>Two</ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><div id='cookie-notice'>We use</div><aside>Side</aside>
<article class="post"><header><h1>Head &amp; line</h1></header><p><b>First&nbsp;  para<br>with break.<p>Second <i>in</i>line
&#x41;&#66;&copy;</p><div class="ad-box advert">Ad</div><ul><li>one<li>two</ul><pre>a
 b</pre><form><p>Send</p><input></form><noscript>no</noscript><section class="comments"><article>Nice!</article></section>
<p hidden>secret</p><footer>by me</footer></article><div class="related">More</div><footer>&copy; 2020</footer></body></html>"""


def test_blocks_of_an_article():
    inside, outside, marked = H.blocks(PAGE)
    assert marked
    assert inside == ["Head & line", "First para with break.", "Second inline AB©", "one", "two", "a b"]
    assert outside == []


@pytest.mark.parametrize("page, inside, outside", [
    ("", [], []), ("plain text", [], ["plain text"]), ("<p>a<p>b", [], ["a", "b"]), ("<main>x<div>y</div>z</main>w", ["x", "y", "z"], ["w"]),
    ("<article><p>a <b>bold</p><p>c</article>", ["a bold", "c"], []), ("<nav><p>x</nav><article>y", ["y"], []),
    ("<article>1 &lt; 2 <!-- x --> 3<script>if (a < b) {}</script></article>", ["1 < 2 3"], []), ("<article><p>a</article", ["a"], []),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [], ["a", "b", "c"]), ("<article><span class='ad'>x</span>y</article>", ["y"], []),
    ("<div class=sidebar><div>x</div></div><p>y", [], ["y"]), ("a < b and c > d", [], ["a < b and c > d"]), ("<article> </article><p>x", [], ["x"]),
])
def test_odd_markup(page, inside, outside):
    assert H.blocks(page) == (inside, outside, "<article" in page or "<main" in page)


def test_pages_with_nulls_repeats_and_clashing_columns(spark):
    table = [(1, "http://h/a", PAGE), (1, "http://h/a", PAGE), (2, None, None), (None, "http://h/b", ""), (4, "http://h/a", PAGE + " ")]
    df = spark.createDataFrame(table, "page_id bigint, url string, html string")
    text = "Head & line\nFirst para with break.\nSecond inline AB©\none\ntwo\na b"
    got = rows(H.main_text(with_clashes(df)))
    assert got == sorted([(1, "http://h/a", text, len(text))] * 2 + [(2, None, "", 0), (None, "http://h/b", "", 0), (4, "http://h/a", text, len(text))],
                         key=lambda r: tuple((x is None, str(x)) for x in r))
    assert H.main_text(df.limit(0)).count() == 0


def test_unmarked_pages_lose_what_the_nearest_page_shares(spark):
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"
    table = [(k, f"https://news.example/{'sport' if k < 6 else 'arts'}/{k:03d}?q={k}", page("Welcome", f"Story {k}", "Read more", f"End {k}", "Imprint")) for k in range(12)]
    table += [(50, "https://other.example/x", page("Welcome", "Only here")), (51, "https://twin.example/a", page("Same", "lines")),
              (52, "https://twin.example/b", page("Same", "lines")), (53, "nonsense", page("No host")), (54, None, page("No url"))]
    df = spark.createDataFrame(table, "page_id bigint, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in H.main_text(df).collect()}
    assert {k: got[k] for k in range(12)} == {k: f"Story {k}\nEnd {k}" for k in range(12)}
    assert (got[50], got[51], got[52], got[53], got[54]) == ("Welcome\nOnly here", "Same\nlines", "Same\nlines", "No host", "No url")


def test_unshared_lines():
    assert H.unshared(list("abcde"), list("axcye")) == ["b", "d"]
    assert H.unshared(["a"], []) == ["a"] and H.unshared([], ["a"]) == [] and H.unshared(["a", "b"], ["a", "b"]) == ["a", "b"]


def test_alignments_are_longest_common_subsequences(monkeypatch):
    import random
    rng = random.Random(7)
    for k in range(600):
        monkeypatch.setattr(H, "OFTEN", k % 3)
        own, other = ([rng.randrange(1 + k % 7) for _ in range(rng.randrange(24))] for _ in range(2))
        one, two = H.aligned(own, other), H.aligned_rows(own, other)
        assert len(one) == len(two)
        for shared in (one, two):
            rest = iter(other)
            assert all(own[i] in rest for i in sorted(shared))


def test_pages_of_many_equal_lines(spark):
    """Pairs of equal lines would be 36 million a page."""
    cells = "".join("<tr><td>0<td>-</tr>" for _ in range(3000))
    table = [(k, f"https://h.example/{k}", f"<article><p>Table {k}</p><table>{cells}</table><p>End {k}</p></article>") for k in range(4)]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(table, "page_id bigint, url string, html string")).collect()}
    assert got == {k: "\n".join([f"Table {k}", *["0", "-"] * 3000, f"End {k}"]) for k in range(4)}


def test_every_given_page_against_the_standard_parser(spark):
    """Python's own parser over the article element of all pages."""
    from html.parser import HTMLParser

    from .conftest import SF01
    from trackmart.llm.common import table
    block = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "div", "section", "article", "pre", "blockquote", "table", "tr", "td", "th", "figure", "header"}

    class Article(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.hidden, self.parts = False, 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            names = set((dict(attrs).get("class") or "").split())
            if self.hidden or tag in {"nav", "footer", "aside", "form", "script", "style", "noscript"} or names & {"ad", "sidebar", "comments", "notice"}:
                self.hidden += tag not in {"br", "img", "input", "hr", "meta", "link"}
            if tag in block:
                self.parts.append("")
            elif tag == "br":
                self.parts[-1] += " "

        def handle_endtag(self, tag):
            self.hidden -= bool(self.hidden)
            if tag == "article":
                self.inside = False
            if tag in block:
                self.parts.append("")

        def handle_data(self, data):
            if self.inside and not self.hidden:
                self.parts[-1] += data
    pages = table(spark, SF01, "pages").collect()
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in H.op6_html_text(spark, SF01).collect()}
    for page in pages:
        parser = Article()
        parser.feed(page["html"])
        text = "\n".join(x for x in (" ".join(p.split()) for p in parser.parts) if x)
        assert got[page["page_id"]] == (text, len(text))
    assert len(got) == len(pages) == 250


def test_template_lines_of_main_elements_are_differenced(spark):
    """Lines of a main element outside its article go if the nearest page shares them; mirrored text stays."""
    def page(k):
        return (f"<nav>Menu</nav><main><div>Home / News</div><h1>Story {k}</h1><article><p>Read more</p><p>Text of story {k}, which goes on for some words.</p></article>"
                "<div>Read more</div></main><div>Imprint</div>")

    def copy(k):
        return f"<main><p>One text on two pages of a host</p><p>with a second line</p><p>Seen {k} times</p></main><div>Site {k}</div>"
    table = [(k, f"https://news.example/arts/{k:02d}", page(k)) for k in range(8)]
    table += [(20 + k, f"https://twin.example/{k}", copy(k)) for k in range(2)] + [(30, "https://one.example/", page(30))]
    table += [(40 + k, f"https://copy.example/{k}", f"<p>Part {k}</p><article><p>Same</p><p>article</p></article>") for k in range(2)]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(table, "page_id bigint, url string, html string").repartition(4)).collect()}
    assert {k: got[k] for k in range(8)} == {k: f"Story {k}\nRead more\nText of story {k}, which goes on for some words." for k in range(8)}
    assert [got[20], got[21]] == [f"One text on two pages of a host\nwith a second line\nSeen {k} times" for k in range(2)]
    assert got[30] == "Home / News\nStory 30\nRead more\nText of story 30, which goes on for some words.\nRead more"
    assert got[40] == got[41] == "Same\narticle"


def test_every_given_page_is_paired_and_aligned(spark):
    """All pages of hosts with several, against plain Python; given pages mark
    one article each, which the check by markup keeps whole."""
    from os.path import commonprefix
    from urllib.parse import urlsplit

    from .conftest import SF01
    from trackmart.llm.common import table

    def common(a, b):  # length of the longest common subsequence
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for k, y in enumerate(b):
                row[k + 1] = last[k] + 1 if x == y else max(last[k + 1], row[k])
        return row[-1]
    rows = H.numbered(table(spark, SF01, "pages"))
    pages = {r["uid"]: r for r in rows.collect()}
    hosts = {}
    for uid, r in pages.items():
        url = urlsplit(r["url"])
        hosts.setdefault(url.netloc.lower(), []).append((url.path, uid))
    lines = {uid: [x for part in H.blocks(r["html"])[:2] for x in part] for uid, r in pages.items()}
    wanted = {}
    for order in hosts.values():
        order.sort()
        for k, (path, uid) in enumerate(order):
            near = [(len(commonprefix([path, p])), u) for p, u in order[max(0, k - 1):k] + order[k + 1:k + 2]]
            if near:
                wanted[uid] = common(lines[uid], lines[max(near)[1]])
    assert {r["uid"]: (r["n_shared"], r["gone"]) for r in H.differenced(rows).collect()} == {uid: (n, []) for uid, n in wanted.items()}
    assert len(wanted) > 100
