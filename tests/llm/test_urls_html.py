"""URL rules against a plain scan over all rules; HTML text on written pages."""

import random

from citystream.llm import html_text, url_filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
         ("block", "a.example.org/"), ("allow", "a.example.org/x/y/z"), ("block", "a.example.org/x/"), ("allow", "b.com/"), ("block", "b.com/")]


def brute(host, path):
    fits = [(len(e.partition("/")[0].split(".")), len(e), v == "block", v, e) for v, e in RULES
            if (host == (h := e.partition("/")[0]) or host.endswith("." + h)) and path.startswith(e[len(h):])]
    return max(fits)[3:] if fits else None


def test_trie_equals_a_scan():
    trie, rnd = url_filter.Trie(RULES), random.Random(2)
    for _ in range(4000):
        host = ".".join(rnd.choice("a b example org com net x".split()) for _ in range(rnd.randrange(1, 5)))
        path = "".join(rnd.choice(["/", "en", "es", "1", "de", "fr", "x", "y", "z", ""]) for _ in range(rnd.randrange(0, 8)))
        assert trie.find(host, path) == brute(host, path), (host, path)


def test_urls(spark):
    rows = [(1, "HTTP://WWW.Example.ORG/es/1?q#f", 0), (2, None, 0), (3, "no scheme", 0), (4, "http://x.com", 0), (None, "x://c.com?/de/", 0),
            (4, "http://x.com", 0), (5, "a://É.org/#", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, host int")
    out = sorted(map(tuple, url_filter.judge_urls(df, RULES).collect()), key=str)
    assert out == sorted([
        (1, "www.example.org", "/es/1", "example.org/es/", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "x.com", "", None, "allow"), (None, "c.com", "", None, "allow"), (4, "x.com", "", None, "allow"),
        (5, "É.org", "/", "org/", "allow")], key=str)
    assert url_filter.judge_urls(df.limit(0), RULES).count() == 0


LONG = "The quick brown fox jumps over the lazy dog, and then it rests a while in the long grass of the field."


def test_article_with_all_kinds_of_boilerplate():
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style></head><body>
    <header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice">We use cookies</div><script>var x = "<p>no</p>";</script>
    <main><article><header><h1>Title &amp; more</h1></header><p>{LONG}<br>Second&nbsp; line, a&lt;b.</p><aside>Related: x</aside>
    <p>Yes.</p><form><input name=q>Search</form><!-- <p>hidden</p> --></article>
    <section id="comments"><article class="comment"><p>{LONG} says a reader.</p></article></section></main>
    <div id="sidebar"><p>{LONG}</p></div><div class="ad">Buy now</div><footer>&copy; Site</footer></body></html>"""
    assert html_text.main_text(page) == f"Title & more {LONG} Second line, a<b. Yes."


def test_names_of_blocks():
    keep = ["post-header", "entry-content", "articleHeader", "adelaide", "main", "lead"]
    drop = ["post-comments", "articleFooter", "main-menu", "content_sidebar", "story-ad", "pageHeader", "cookieBanner", "Comments"]
    for name in keep + drop:
        page = f"<body><div class='x {name}'><p>{LONG} block</p></div><div><p>{LONG}</p></div></body>"
        assert html_text.main_text(page) == (f"{LONG} block {LONG}" if name in keep else LONG), name


def test_surge_and_dive_without_article_elements():
    page = f"<body><div>Menu</div><ul><li><a href=a>One</a><li><a href=b>Two</a></ul><div><h2>Head</h2><p>{LONG}<p>{LONG} x</div><footer>f</footer></body>"
    assert html_text.main_text(page) == f"Menu Head {LONG} {LONG} x" or html_text.main_text(page) == f"Head {LONG} {LONG} x"


def test_teaser_articles_beside_the_body():
    body = " ".join([LONG] * 4)
    teaser = "<article><h3>Read next</h3><p>Bridge closed</p></article>"
    for page in (f'<div class="text"><p>{body}</p><p>{body}</p></div>{teaser}', f'{teaser}<div class="text"><p>{body}</p><p>{body}</p></div>',
                 f'<div class="text"><p>{body}</p>{teaser}<p>{body}</p></div>'):
        assert html_text.main_text(f"<body>{page}</body>") == f"{body} {body}"


def test_short_paragraphs_far_from_the_body():
    """Boilerplate lines between don't count as empty ones."""
    junk = "<aside>One</aside><aside>Two</aside><div class=ad>Three</div>"
    first, last = "A first paragraph of sixty characters, more or less so.", "And a short last one, also of sixty characters or so."
    page = f"<body><nav>Menu</nav><p>{first}</p>{junk}<p>{LONG} {LONG}</p>{junk}<p>{last}</p><footer>End</footer></body>"
    assert html_text.main_text(page) == f"{first} {LONG} {LONG} {last}"


def test_surges_equal_sums_over_windows():
    rnd = random.Random(8)
    for _ in range(300):
        weight = [rnd.choice([-100, 3, 10, 30, 90, 400]) for _ in range(rnd.randrange(12))]
        block = lambda i: sum(w for k, w in enumerate(weight) if i <= k < i + html_text.WIDTH)
        want = []
        for i, w in enumerate(weight):  # the last surge point up to i, and no dive point since
            start = max((k for k in range(i + 1) if block(k) >= html_text.SURGE), default=None)
            want.append(w > 0 and start is not None and all(block(k) >= html_text.DIVE for k in range(start, i + 1)))
        if not any(block(i) >= html_text.SURGE for i in range(len(weight))):
            want = [w > 0 for w in weight]
        assert html_text.surges(weight) == want


def test_every_page_of_the_table():
    """No page loses its article: the text is that of the one article's lines outside boilerplate."""
    import pyarrow.parquet as pq

    for html in pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"]).column(0).to_pylist():
        lines = html_text.Lines(html or "").lines
        assert html_text.main_text(html) == " ".join(t for t, _, article, junk in lines if article and not junk)


def test_broken_pages():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x") == ""
    assert html_text.main_text("a < b and c > d") == "a < b and c > d"
    assert html_text.main_text('<article><p class="x>one<p>two') == "one two"
    assert html_text.main_text('<p>whole</p><p class="cut') == "whole"
    assert html_text.main_text("<article><p>fo<b>re</b>st</p><p> \n </p><p>&#233;&#x41;") == "forest éA"
    assert html_text.main_text("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert html_text.main_text("<a " * 200000).startswith("<")


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", "<article>A &lt; B</article>", 1), (None, None, None, 2), (1, "u", "<article>A &lt; B</article>", 1)],
                               "page_id long, url string, html string, n_chars int")
    out = [tuple(r) for r in html_text.extract(df).collect()]
    assert sorted(out, key=str) == sorted([(1, "u", "A < B", 5)] * 2 + [(None, None, "", 0)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0
