import collections
import math

from shopspan.llm import styletree
from shopspan.llm.styletree import main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<header><p>Site</p></header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
<article><header><h1>Head &amp; <i>tail</i></h1></header><p><b>One&nbsp;two<br>three<br><p>Four
  five &lt;six&gt;</p><div class="related-links">See</div><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>
<form><p>Mail</p></form><section id="comments"><p>First!</p></section><aside>Side</aside></article>
<div id="cookieNotice">Cookies</div><footer>&copy; us</footer>"""


def test_article_without_what_stands_beside():
    assert main_text(PAGE) == "Head & tail\n\nOne two three\n\nFour five <six>\n\na\n\nb\n\nc\n\nd"


def test_odd_markup():
    assert main_text("") == "" and main_text("plain  text") == "plain text"
    assert main_text("<p>a<p>b</div>c") == "a\n\nb\n\nc" or main_text("<p>a<p>b</div>c") == "a\n\nbc"
    assert main_text("<article>x <script>if (a<b) {</script> y</article>") == "x y"
    assert main_text("<article>1 < 2 &amp 3 <</article>") == "1 < 2 & 3 <"
    assert main_text("<article><p title='a>b'>t</p>") == "t"
    assert main_text("<article>a<!-- never closed") == "a" and main_text("<p>a<script>b") == "a"
    assert main_text("<p>" + "w " * 200_000) == " ".join(["w"] * 200_000)
    assert len(main_text("<div>" * 5000 + "deep").split()) == 1


def test_names_on_wrappers():
    inside = '<article class="post tags"><div class="post-header"><h1>H</h1></div><p>T</p></article>'
    assert main_text(f'<body class="nav-open has-sidebar"><div class="with-sidebar">{inside}</div></body>') == "H\n\nT"
    assert main_text(f'<div class="sidebar">{inside}<p>x</p></div><div class="comments"><article><p>c</p></article></div>') == "H\n\nT"
    assert main_text('<article><p>T</p><article class="comment"><p>c</p></article></article>') == "T"
    assert main_text("<nav><article><p>menu</p></article></nav><p>T</p>") == "T"


def entropy(values):
    counts, n = collections.Counter(values), len(values)
    return 1.0 if n == 1 else -sum(c / n * math.log(c / n) for c in counts.values()) / math.log(n)


def test_importance_by_hand(spark):
    pages = [("h", f"<div class='body'><p>Text {k}</p></div><div class='strip'>Same on all</div>") for k in range(12)]
    pages += [("one", "<div class='strip'>Lonely</div>")]
    got = {(r.host, r.path): r for r in styletree.style_tree(spark.createDataFrame(pages, "host string, html string")).collect()}
    body, strip, lonely = got["h", "/div.body/p"], got["h", "/div.strip"], got["one", "/div.strip"]
    assert body.pages == 12 and abs(body.content - entropy(list(range(12)))) < 1e-9 and body.shape == 0
    assert strip.content == strip.shape == 0 and lonely.content == lonely.shape == 1
    prior = (0 * 12 + 1.0 * 1) / 13
    assert abs(strip.importance - prior * 8 / 20) < 1e-9 and abs(lonely.importance - (1 + prior * 8) / 9) < 1e-9


def test_pages(spark, with_clashes):
    strip = "<div class='strip'>Same on all</div>"
    rows = [(k, "http://A.com/x", f"<div class='body'><p>Text {k} here</p></div>{strip}") for k in range(20)]
    rows += [(100, None, None), (101, "http://b.org/", ""), (None, "no host", f"<p>q</p>{strip}"), (0, "http://a.com/y", PAGE),
             (102, "http://c.org/", strip)]
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = styletree.extract_pages(pages).collect()
    assert sorted((r.page_id or -1, r.url or "", r.text) for r in got) == sorted(
        [(k or -1, "http://A.com/x", f"Text {k} here") for k in range(20)]
        + [(100, "", ""), (101, "http://b.org/", ""), (-1, "no host", "q"), (-1, "http://a.com/y", main_text(PAGE)),
           (102, "http://c.org/", "")]
    )
    assert all(r.n_chars == len(r.text) for r in got)
    assert styletree.extract_pages(pages.limit(0)).count() == 0


def texts_of(spark, bodies, host="a.com"):
    pages = spark.createDataFrame([(k, f"http://{host}/{k}", b) for k, b in enumerate(bodies)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in styletree.extract_pages(pages).collect()}


def test_tree_alone_decides_on_pages_with_an_article(spark):
    for tag in ("article", "main"):
        got = texts_of(spark, [
            f"<body><div class='lead'><p>Lead {k}</p></div><div class='strip'>Same</div><{tag}><h1>Head {k}</h1><p>Text {k}</p>"
            f"<div class='box'><p>Join our list</p></div><div class='body'><p>More {k}</p></div></{tag}></body>" for k in range(60)])
        assert got == {k: f"Lead {k}\n\nHead {k}\n\nText {k}\n\nMore {k}" for k in range(60)}
    copies = texts_of(spark, ["<nav>Menu</nav><article><h1>H</h1><p>All the same</p></article>"] * 60)
    assert set(copies.values()) == {"H\n\nAll the same"}


def test_names_are_a_prior(spark):
    kept = ("<section id='discussion'><p>D</p></section><h2 id='related-work'>R</h2><h2 id='search-algorithms'>S</h2>"
            "<section id='form-validation'><p>F</p></section><div data-id='comments' data-role='form' title='x class=ad'>N</div>")
    assert main_text(f"<article><p>T</p>{kept}</article>") == "T\n\nD\n\nR\n\nS\n\nF\n\nN"
    inside = "<article class='post has-comments'><p>T</p><div class='ad'>Buy</div></article>"
    for wrapper in ("div class='page-with-comments'", "div class='social'", "div class='ad-free'", "form action='x'", "div id='search'"):
        assert main_text(f"<body><{wrapper}>{inside}</{wrapper.split()[0]}></body>") == "T", wrapper
    for wrapper in ("nav", "aside", "footer", "div class='comments'", "div id='comment-list'"):
        assert main_text(f"<{wrapper}>{inside}</{wrapper.split()[0]}><p>x</p>") == "x", wrapper
    got = texts_of(spark, [f"<article><p>T {k}</p><div class='notice'>Note {k}</div><div class='related'>Same links</div>"
                           f"<div class='ad'>Buy {k}</div><div class='comments'>C {k}</div></article>" for k in range(20)])
    assert got == {k: f"T {k}\n\nNote {k}" for k in range(20)}
