"""URL filter and HTML extraction."""

from __future__ import annotations

import itertools
import math
import re

import pytest
from pyspark.sql import functions as F

from rivulet.llm import html_extract, url_filter
from rivulet.llm.html_extract import parse

PAGES = "page_id long, url string, html string"


def _rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", "", None, None
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1])
    fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES
            if (host == h or host.endswith("." + h)) and m[2].startswith(p)]
    return host, m[2], *(max(fits)[1:] if fits else (None, None))


URLS = ["https://Example.COM/en/1", "http://www.example.com/en/2?x=1", "http://a.www.example.com/en/3", "http://example.com/en",
        "https://notexample.com/en/1", "http://x.example.net/es/5#t", "http://example.net/fr/", "http://net/es/", "http://net.org/es/",
        "http://com", "http://com/", "http://b.com?x=/en/", "ftp://u:p@Ä.example.com:80/en/", "example.com/en/1", "", None, "://", "x://y://com/",
        "http://sub.ads-track.example.org/en/1", "http://h.net/FR/1", "http://a.com/a\nb?c", "http://w.example.org/it/7"]


def test_rules_hosts_and_paths(spark):
    df = spark.createDataFrame([(i, u, "<p>words track ads here</p>", "x") for i, u in enumerate(URLS)] + [
        (None, URLS[0], None, "y"), (0, URLS[0], "", "z")], PAGES + ", verdict string")
    got = url_filter.judge(df).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = _rule(URLS[r.page_id] if r.page_id is not None else URLS[0])
        assert (r.host, r.path, r.rule) == (host, path, rule), r
        assert r.verdict == verdict if verdict else r.verdict == ("block" if r.block_odds > 0 else "allow")
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_viterbi_is_the_best_of_all_splits():
    counts = {"the": 50, "th": 5, "rest": 20, "there": 9, "st": 3, "he": 8, "re": 4, "news": 6, "new": 9, "stand": 2}
    total = sum(counts.values())

    def cost(words):
        return sum(-math.log(counts[w] / total) if w in counts else math.log(total) + len(w) * math.log(10) for w in words)

    for piece in ("therest", "thestand", "newstand", "xqz", "thenewsrest", "a"):
        every = []
        for cuts in itertools.product((0, 1), repeat=len(piece) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(piece)]
            every.append([piece[a:b] for a, b in zip(at, at[1:])])
        got = url_filter.segment(piece, counts, total)
        assert "".join(got) == piece and cost(got) == pytest.approx(min(map(cost, every)))
    assert url_filter.segment("", counts, total) == []
    assert url_filter.segment("thenewsrest", counts, total) == ["the", "news", "rest"]


def test_bayes_matches_brute_force(spark):
    text = "news sport shop cheap deals daily casino win free bonus " * 20
    urls = [f"http://{h}.{t}/{p}/{i}" for i, (h, t, p) in enumerate(itertools.product(
        ("dailynews", "cheapdeals", "casinowin", "freebonus"), ("com", "net", "org"), ("es", "en", "fr")))]
    df = spark.createDataFrame([(i, u, text) for i, u in enumerate(urls)], PAGES)
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    words = {}
    for i, u in enumerate(urls):
        host, path, _, _ = _rule(u)
        name, tld = host.split(".")
        parts = next([name[:k], name[k:]] for k in range(1, len(name)) if name[:k] in text.split() and name[k:] in text.split())
        words[i] = ["h:" + w for w in (*parts, tld)] + ["p:" + path.split("/")[1], "p:0"]
    seen, n = {"block": {}, "allow": {}}, {"block": 0, "allow": 0}
    for i, u in enumerate(urls):
        v = _rule(u)[3]
        if v:
            n[v] += 1
            for w in words[i]:
                seen[v][w] = seen[v].get(w, 0) + 1
    vocabulary = len(set(seen["block"]) | set(seen["allow"])) + 1
    for i in words:
        odds = math.log(n["block"] / n["allow"])
        for w in words[i]:
            odds += math.log((seen["block"].get(w, 0) + 1) / (sum(seen["block"].values()) + vocabulary))
            odds -= math.log((seen["allow"].get(w, 0) + 1) / (sum(seen["allow"].values()) + vocabulary))
        assert got[i].block_odds == pytest.approx(odds, abs=1e-9)


@pytest.mark.parametrize("page, text", [
    ("<p>a  b\n c</p><p>d</p>", "a b c\n\nd"),
    ("<body><nav>x</nav><article><h1>T</h1><p>One &amp; two<br>three</p></article><footer>f</footer>", "T\n\nOne & two three"),
    ("<article><p><b>bold<br><p>next</article>", "bold\n\nnext"),
    ("<article><p>x<script>var a='</p>'; if (1<2) {}</script>y</p></article>", "xy"),
    ("<article><p>a<!-- <p>no</p> -->b</p></article>", "ab"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "one\n\ntwo\n\nc1\n\nc2"),
    ("<article>x<div class='comments'><p>me too</p></div><section id=related-posts>r</section>y</article>", "x\n\ny"),
    ("<article><header><h1>T</h1></header><p>b</p><form>f<input></form></article>", "T\n\nb"),
    ("<div class='cookie-notice'>c</div><div class=ad>buy</div><div>kept</div>", "kept"),
    ("<div style='display: none'>h</div><div hidden>h</div><p aria-hidden='true'>h</p>t", "t"),
    ("<p>1 < 2 &lt;b&gt; &#65;&#x42; &copy; &nosuch;</p>", "1 < 2 <b> AB \u00a9 &nosuch;"),
    ("</div></p>stray", "stray"), ("", ""), ("plain", "plain"), ("<p title='a > b'>q</p>", "q"),
    ('<p title="a > b">q</p>', "q"), ("<article><p>cut &am</p", "cut &am"), ("<main><p>m</p></main><article class=comment>c</article>", "m"),
    ("<style>p{}</style><title>t</title><p>x</p>", "x"), ("<p>a</p><script>never closed <p>b</p>", "a"),
    ("<article><pre>k\n  l</pre><blockquote>q</blockquote></article>", "k l\n\nq"),
])
def test_parse(page, text):
    assert parse(page) == text


@pytest.mark.parametrize("name", [
    "class='comments-area'", "class='commentlist'", "id='comments-section'", "class='comment'", "class='reader-comments'",
    "class='sidebar-right'", "class='promo'", "class='advertisement-block'", "class='cookie-banner-wrap'", "class='x user_comments'",
    "class='social-media-links'", "class='related-news'"])
def test_comments_and_adverts_inside_the_article_go(name):
    assert parse(f"<article><p>Story</p><div {name}><p>me too</p><p>and me</p></div><p>End</p></article>") == "Story\n\nEnd"


@pytest.mark.parametrize("page, text", [
    ("<article><div class='cookie-recipe'>Flour</div><div class='social-media'>Posts</div><div class='promotion-rules'>Chess</div></article>",
     "Flour\n\nPosts\n\nChess"),
    ("<article><pre>x = 1 <span class='comment'># one</span></pre><p class=comment>c</p></article>", "x = 1 # one\n\nc"),
    ("<article><p>a</p><label>Email</label><p>b</p></article>", "a\n\nb"),
    ("""<p title='a > b' alt="it's > that">q</p>""", "q"),
    ("""<p title="she said 'a > b'">q</p><p data-1="class='ad' > x">r</p>""", "q\n\nr"),
    ("<p>it's 1 > 0</p><p alt=it's>s</p>", "it's 1 > 0\n\ns"),
    ("<p title='never closed>q</p><p>r</p>", "q\n\nr"),
    ("""<p title="never closed>q</p><p>r</p>""", "q\n\nr"),
])
def test_names_by_their_words_and_both_quotes(page, text):
    assert parse(page) == text


@pytest.mark.parametrize("piece", ["<p a=\">\"", "<p a='>", "<p a=\"'>", "<p a='\">", "<p a=", "<p a=\"<p b='", "<p a='x' b=\"", "<p ' \" ="])
def test_broken_quotes_are_read_in_linear_time(piece):
    import time

    def seconds(n):
        start = time.perf_counter()
        parse(piece * n + "x")
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20000) < 40 * max(seconds(2000), 0.02)


def test_deep_and_broken_pages_end():
    assert parse("<div>" * 20000 + "x") == "x"
    assert parse("<b>" * 20000 + "</i>" * 20000 + "<p>" * 20000 + "x") == "x"
    assert parse("<" * 5000) == "<" * 5000
    assert parse('<p a="' * 2000).count("x") == 0


def _site(spark, pages):
    return spark.createDataFrame(pages, PAGES + ", host string")


def test_templates_are_what_many_pages_of_a_host_share(spark):
    box, note = "<div class=x7><p>Read our weekly digest</p></div>", "<div class=q>Site of the year</div>"
    pages = [(i, f"http://A.example/{i}", f"<body>{box}<div><p>Story {i} is long</p>{'<p>shared passage</p>' if i < 3 else ''}</div>{note}</body>", "h")
             for i in range(40)]
    pages += [(100 + i, f"http://b.example/{i}", f"<body>{box}<p>Other {i}</p></body>", "h") for i in range(3)]
    pages += [(200 + i, f"http://c.example/{i}", f"<article><p>Text {i}</p>{box}{'<p>All rights reserved</p>' if i % 3 else ''}</article>", "h")
              for i in range(60)]
    pages += [(300, None, f"<body>{box}<p>no host</p></body>", None), (301, "http://a.example/x", None, None), (302, "http://d.example/", "", "d")]
    got = {r.page_id: r for r in html_extract.extract(_site(spark, pages)).collect()}
    assert len(got) == len(pages)
    for i in range(40):
        assert got[i].text == f"Story {i} is long" + ("\n\nshared passage" if i < 3 else "")
    assert got[100].text == "Read our weekly digest\n\nOther 0"  # three pages are not many
    for i in range(60):  # in an article more than half the pages must have it
        assert "weekly" not in got[200 + i].text
        assert ("All rights reserved" not in got[200 + i].text)
    assert got[300].text == "Read our weekly digest\n\nno host" and got[301].text == "" == got[302].text
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_extracts_the_article_of_every_test_page(spark):
    sf = "/root/testdata/sf0.001"
    squeeze = lambda t: " ".join(t.split())
    known = {squeeze(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = html_extract.extract(pages).collect()
    bodies = [squeeze(" ".join(r.text.split("\n\n")[1:])) for r in got]
    assert len(got) == pages.count() and sum(b in known for b in bodies) == len(bodies)


def _texts(spark, pages):
    return [r.text for r in sorted(html_extract.extract(spark.createDataFrame(
        [(i, "http://h.example/%d" % i, p) for i, p in enumerate(pages)], PAGES)).collect(), key=lambda r: r.page_id)]


def test_copies_of_an_article_are_one_content(spark):
    body = "<h1>Title</h1><p>The same long story on many pages</p><ul><li>first point of it</li></ul>"
    whole = "Title\n\nThe same long story on many pages\n\nfirst point of it"
    for wrap in ("<article>%s</article>", "<body><div>%s</div></body>"):
        texts = _texts(spark, [wrap % body] * 30 + [wrap % f"<p>Another story, number {i}</p>" for i in range(20)])
        assert texts[:30] == [whole] * 30
        assert texts[30:] == [f"Another story, number {i}" for i in range(20)]


def test_near_copies_keep_their_shared_paragraphs(spark):
    shared = "".join(f"<p>{'word%d ' % k * 20}</p>" for k in range(5))
    texts = _texts(spark, [f"<article><p>edition {i} of this</p>{shared}</article>" for i in range(40)])
    assert all(f"edition {i} of this" in t and "word0" in t and "word4" in t for i, t in enumerate(texts))


def test_recurrence_spares_parts_of_running_text(spark):
    part = ("<h2>References</h2><p>Story %d has <b>Name</b> and <em>not</em> <a href=/d>Docs</a></p><p>Yes.</p>"
            "<table><tr><td>Yes</td><td>%d</td></tr></table>")
    want = "References\n\nStory %d has Name and not Docs\n\nYes.\n\nYes\n\n%d"
    menu = "<ul class=k><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><b>Now %d</b></li></ul>"
    box = "<div class=z><h2>Most read</h2><div><p>One recurring teaser</p></div></div>"
    for page in (f"<article>{part}</article>", f"<body>{menu}<div>{part}</div>{box}</body>"):
        n = page.count("%d")
        texts = _texts(spark, [page % ((i,) * n) for i in range(40)])
        assert texts == [("Now %d\n\n" % i if n == 3 else "") + want % (i, i) for i in range(40)]


@pytest.mark.parametrize("page, text", [
    ("<main></main><div><p>Story</p></div>", "Story"),
    ("<main> <p> </p></main><p>Story</p>", "Story"),
    ("<div><p>A story told at length</p></div><article>Teaser</article>", "A story told at length\n\nTeaser"),
    ("<div><a href=/>A long list of links, longer than the text</a></div><main><p>Short text</p></main><p>more</p>", "Short text"),
])
def test_main_elements_must_hold_most_of_the_text(page, text):
    assert parse(page) == text


@pytest.mark.parametrize("page, text", [
    ("<article><h2 id='how-to-search'>How</h2><section id='related-work'>Work</section><p class='share-price'>Up</p></article>",
     "How\n\nWork\n\nUp"),
    ("<article><div class='social-history'>Past</div><figure class='banner'>Flag</figure><h3 id='notice-period'>Term</h3></article>",
     "Past\n\nFlag\n\nTerm"),
    ("<div><h2 id='how-to-search'>How</h2><section id='related-work'>Work</section><p class='share-price'>Up</p></div>", "How\n\nWork\n\nUp"),
    ("<article>x<div class='share-buttons'>s</div><div class='related_posts'>r</div><div id='respond'>c</div></article>", "x"),
    ("<body><form><nav>n</nav><div><p>The whole page</p><select><option>o</select></div></form></body>", "The whole page"),
    ("<form id=a><div role=main><p>m</p></div></form>", "m"),
    ("<p>longer text</p><form>f</form>", "longer text"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> holds</p></article>", "so x=2 holds"),
])
def test_names_and_forms_do_not_take_the_text(page, text):
    assert parse(page) == text


def test_names_inside_the_article_lower_the_bar(spark):
    block = "<div class='%s'>Follow our channel for more</div>"
    pages = [f"<article><p>Story {i} of many</p>{block % 'social-hint' if i < 10 else block % 'x' if i < 20 else ''}</article>" for i in range(30)]
    texts = _texts(spark, pages)
    assert all(("Follow" in t) == (10 <= i < 20) for i, t in enumerate(texts))


def test_the_bar_does_not_grow_with_the_host(spark):
    notice = "<div class=q>Read the new terms of use</div>"
    texts = _texts(spark, [f"<body><p>Story {i} is long</p>{notice if i < 50 else ''}</body>" for i in range(600)])
    assert texts == [f"Story {i} is long" for i in range(600)]
    bars = spark.createDataFrame([(n,) for n in (40, 1000, 300000)], "n long").select(
        html_extract._bar(F.col("n"), F.lit(False)), html_extract._bar(F.col("n"), F.lit(True))).collect()
    assert bars[0][0] == 5 and bars[0][1] == 20 and bars[1][0] < 30 and bars[2][0] < 100 and bars[2][1] < 300


def test_adverts_that_rotate_in_the_article_go(spark):
    texts = _texts(spark, [f"<article><p>Story {i} is long</p><div class=q>Buy our product {'abc'[i % 3]}</div></article>" for i in range(60)])
    assert texts == [f"Story {i} is long" for i in range(60)]
