"""Extraction of hand-made pages and consensus over hosts."""

import pytest

from docflow.llm import html_extract as h

LONG = "This is the main text of the page and it is long enough to win."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        (f"<body><nav><a>Menu</a></nav><article><h1>T &amp; x</h1><p>{LONG}\n  two<br>three<p>Four</article><footer>(c)</footer>", f"T & x\n{LONG} two three\nFour"),
        (f"<div class='top-menu'>m</div><div class='content'><p>{LONG}</p><div class='ad-box ads'>buy</div><form>f</form><p>a<b>b</b>c</p></div><div id='comments'><p>{LONG * 3}</p></div>", f"{LONG}\nabc"),
        (f"<main><script>var x='</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}</p><aside>{LONG}</aside><ul><li>a<li>b</ul></main>", f"{LONG}\na\nb"),
        (f"<article><p>{LONG}<b>bold<i>both</b></i> after</p><table><tr><td>1<td>2</table></article>", f"{LONG}boldboth after\n1\n2"),
        (f"<article><p>{LONG} 1 &lt; 2 &eacute; &#8364; &nbsp;x &unknown;</p>", f"{LONG} 1 < 2 é € x &unknown;"),
        ("<p>" * 5000 + LONG, LONG),
        ("<div>" * 3000 + LONG + "</div>" * 3000, LONG),
        (f"<article><p>{LONG}</p><div role='navigation'>x</div><p hidden>y</p><textarea>z</textarea></article>", LONG),
        (f"<article><header><p>by me</p></header><p>{LONG}</p><section class='reader-comments'><p>{LONG}</p></section></article", LONG),
    ],
)
def test_pages(html, want):
    assert h.extract(html, []) == want


@pytest.mark.parametrize(
    "kept",
    ["<h2 id='related-work'>Related work</h2>", "<p id='search'>Search</p>", "<div class='social'>A social theory</div>", "<p class='ad'>An ad hoc rule</p>", "<h3 class='comments'>Comments on this</h3>", "<section class='legal'><p>The law says so</p></section>", "<div class='side-notes'>Note <a href='x'>one</a></div>", "<div id='search-results'>Found</div>"],
)
def test_article_text_stays(kept):
    text = __import__("re").sub(r"<[^>]*>", "", kept)
    assert h.extract(f"<article><p>{LONG}</p>{kept}<p>{LONG}</p></article>", []) == f"{LONG}\n{text}\n{LONG}"


@pytest.mark.parametrize("gone", ["<div class='social'><a href='a'>Share this</a> <a href='b'>Tell all</a></div>", "<ul class='related'><li><a href='a'>More</a></ul>", "<div id='comments'><p>I think</p></div>", "<section class='reader-comments'>I think</section>", "<div class='cookie-notice'>We use cookies</div>", "<div class='post-ads x'>Buy</div>", "<aside>Aside</aside>"])
def test_the_rest_goes(gone):
    assert h.extract(f"<article><p>{LONG}</p>{gone}<p>{LONG}</p></article>", []) == f"{LONG}\n{LONG}"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("AT&<b>amp;</b>T", "AT&amp;T"),
        ("a &am<!-- x -->p; b", "a &am p; b".replace("m p", "mp")),
        ("<a title=\"foo>text</a> after", "text after"),
        ("<a title='foo>text</a> after", "text after"),
        ("<a title=it's>text</a> it's <i>so</i>", "text it's so"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<b>x<p>y</b>z<p>w", "x\nyz\nw"),
        ("<ul><li>a<p>b<li>c</ul>", "a\nb\nc"),
        ("<table><tr><td>a<p>b<td>c<tr><td>d</table>", "a\nb\nc\nd"),
        ("x</div></b></article>y", "xy"),
    ],
)
def test_broken_markup(html, want):
    assert h.extract(html, []) == want


def test_paths():
    page = h.parse("<body><div class='e d c Post12 b a w-1/2'><article>x</article></div></body>")
    node = page.root.children[0].children[0].children[0]
    path = "div.a.b.c.d.e.post0.w-0_0/article"
    assert page.path_of(node) == path and h.text_of(h._on_path(page, path)) == "x"
    assert h._on_path(page, "div.a/article") == [] and page.number_of("body") == 0
    # Containers that differ in one class of many are different.
    other = h.parse("<body><div class='e d c Post12 b z w-1/2'><article>x</article></div></body>")
    assert h._on_path(other, path) == []


@pytest.mark.parametrize(
    "html",
    [
        "<div class='a b'>" * 20_000 + LONG + "</div>" * 20_000,
        "<b>" * 10_000 + f"<div>{LONG}</div>" * 3 + "</i>" * 20_000,
        "<b><article>" + "<i>" * 10_000 + "</b>" * 10_000 + LONG,
        "<b>" * 10_000 + "<div>x</div>" * 10_000,
        "<p><a title='" * 10_000 + LONG,
        "<table><tr><td>" * 5_000 + LONG,
    ],
)
def test_linear_time(html):
    begin = __import__("time").perf_counter()
    page = h.parse(html)
    best = h.best_container(page)
    paths = [page.path_of(best)] if best else []
    h.extract(html, [*paths, "div.a", "div.a.b/article"])
    assert __import__("time").perf_counter() - begin < 2.0


def made(rng):
    """(html, main text): a page made at random, whose text follows from how it was made."""
    word = lambda: rng.choice(["alpha", "beta", "caf&eacute;", "x &lt; y", "R&amp;D", "delta", "é", "one&nbsp;two"])
    plain = lambda w: w.replace("&eacute;", "é").replace("&lt;", "<").replace("&amp;", "&").replace("&nbsp;", " ")
    blocks = []

    def inline():
        html, text = [], []
        for _ in range(rng.randint(4, 30)):
            w = word()
            tag = rng.choice(["", "", "", "b", "i", "a href='x'", "span class='note'", "em id='search'"])
            html.append(f"<{tag}>{w}</{tag.split()[0]}>" if tag else w)
            text.append(plain(w))
        blocks.append(" ".join(text))
        return rng.choice([" ", "\n ", "  "]).join(html)

    def body(depth):
        out = []
        for _ in range(rng.randint(2, 5)):
            kind = rng.choice(["p", "p", "h2", "ul", "div", "table", "quote", "gone"])
            if kind == "p":
                out.append(f"<p class='{rng.choice(['', 'ad', 'lead', 'related'])}'>{inline()}{rng.choice(['</p>', ''])}")
            elif kind == "h2":
                out.append(f"<h2 id='{rng.choice(['search', 'footer', 'x'])}'>{inline()}</h2>")
            elif kind == "ul":
                out.append("<ul>" + "".join(f"<li>{inline()}{rng.choice(['</li>', ''])}" for _ in range(2)) + "</ul>")
            elif kind == "table":
                out.append(f"<table><tr><td>{inline()}</td><td>{inline()}</table>")
            elif kind == "quote":
                out.append(f"<blockquote>{inline()}</blockquote>")
            elif kind == "gone":
                out.append(rng.choice(["<nav><a href='x'>Menu</a></nav>", "<div class='ad-box'>Buy</div>", "<!-- <p>no</p> -->", "<script>'</p>'</script>", "<form>Name <input></form>", "<div id='comments'>I say</div>", "<aside>More</aside>"]))
            elif depth < 3:
                out.append(f"<div class='{rng.choice(['box', 'c1', 'c2 d'])}'>{body(depth + 1)}</div>")
        return rng.choice(["", "\n"]).join(out)

    article = f"<article>{body(0)}<p>{LONG * 3}</p></article>"
    blocks.append(LONG * 3)
    html = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header><nav><ul><li><a href='x'>Home</a></ul></nav><div class='banner'>News</div>{article}<footer>(c) us</footer></body></html>"
    return html, "\n".join(blocks)


def test_pages_made_at_random():
    rng = __import__("random").Random(4)
    for _ in range(300):
        html, want = made(rng)
        assert h.extract(html, []) == want
        assert h.extract(html, ["article"]) == want


PAGES = "page_id long, url string, html string, text string, host int"


def rows():
    story = lambda k: f"<div class='story s{k}'><p>{LONG} {k}</p></div><div class='more'><p>{'Elsewhere on this site. ' * (40 if k == 3 else 1)}</p></div>"
    out = [(k, f"https://A.example/{k}?x", story(k), "t", 0) for k in range(9)]
    return out + [(20, None, f"<article>{LONG}</article>", "t", 0), (21, "nohost", None, "t", 0), (22, "https://b.example/", "", "t", 0), (0, "https://A.example/0?x", story(0), "t", 0)]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_hosts_agree(spark, limit):
    df = spark.createDataFrame(rows(), PAGES)
    out = h.extract_pages(df, max_broadcast_bytes=limit)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text, r.n_chars) for r in out.collect()), key=repr)
    # Page 3 has more text elsewhere; the host's other pages outvote it.
    want = [(k, f"{LONG} {k}") for k in [*range(9), 0]] + [(20, LONG), (21, ""), (22, "")]
    assert got == sorted(((k, t, len(t)) for k, t in want), key=repr)
    assert h.extract_pages(df.limit(0)).count() == 0


def test_more_paths_and_large_hosts(spark):
    df = spark.createDataFrame(rows(), PAGES)
    one = h.extract_pages(df, paths=1, max_broadcast_bytes=0)
    assert sorted((r.page_id, r.n_chars) for r in one.collect()) == sorted((r.page_id, r.n_chars) for r in h.extract_pages(df, paths=9).collect())


@pytest.mark.parametrize("empty", [False, True])
def test_query(spark, tmp_path, empty):
    """The registered query over null, empty, repeated and very long pages, null ids and clashing names."""
    rng = __import__("random").Random(9)
    pages = [(k, f"http://h{k % 3}.example/{k}", *made(rng)) for k in range(30)]
    long = "<article>" + f"<p>{LONG}</p>" * 40_000 + "</article>"
    pages += [(30, None, None, ""), (31, "http://h1.example/", "", ""), (None, "http://h1.example/x", *pages[4][2:]), (4, "http://h1.example/4", *pages[4][2:]), (32, "x", long, "\n".join([LONG] * 40_000))]
    df = spark.createDataFrame([(*r, 1, "h") for r in pages], "page_id long, url string, html string, text string, n_chars int, host string")
    (df.limit(0) if empty else df).write.parquet(str(tmp_path / "pages.parquet"))
    out = h.op6_html_text(spark, str(tmp_path))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, map(tuple, out.collect()))) == ([] if empty else sorted(repr((i, u, t, len(t))) for i, u, _, t in pages))
