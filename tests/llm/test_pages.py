import pytest

from loanlake.llm import host_suffixes as hs

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body class="x"><nav><ul><li><a href="/a">Menu one</a></li><li>Menu two</li></ul></nav><!-- <p>hidden</p> -->
<div class="ad slot">Buy now</div><article><h1>The  title</h1><p>First&nbsp;par &lt;b&gt; <b>bo</b>ld &amp more &am
<p>Second<br>line<div class="share-buttons">Share</div><aside>Side</aside><section id="comments"><p>Nice!</p></section>
<form><input value="p">Mail<button>Send</button></form><p>Last &copy; &#233;&#x41;</article><footer>&copy; host</footer>"""


def text_of(source):
    return hs.parse(source).text()


def test_article_text():
    assert text_of(ARTICLE) == "The title\nFirst par <b> bold & more &am\nSecond\nline\nLast © éA"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<main><p>a</p><nav>n</nav><p>b</p></main><p>c</p>", "a\nb"),
        ("<main>x<article>y</article></main>", "y"),
        ("<div role='main'><p>a</p></div><p>b</p>", "a"),
        ("<article><header><h1>Title</h1><p>By someone</p></header>Body</article>", "Title\nBody"),
        ("<article><p>unclosed <i>tags <div>here", "unclosed tags\nhere"),
        ("<article>a <span class='ad'>buy</span> b</article>", "a\nb"),
        ("<article>a < b and <3 c > d</article>", "a < b and <3 c > d"),
        ("<article><p>one</p></article><article class='comment'>two</article><article>three</article>", "one\nthree"),
        ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
        ("<article><p title=\"a > b\">attr</p></article>", "attr"),
        ("<article></article>", None),
        ("", None),
        (None, None),
    ],
)
def test_shapes(source, text):
    assert text_of(source) == text


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "old", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")


def test_boilerplate_of_a_host_without_articles(spark):
    """Open text that repeats across pages of a host goes; the unique runs stay, and other hosts do not count."""
    own = lambda k: " ".join(f"word{k * 31 + j}" for j in range(12))
    menu = "<div>Home News Sport Weather About Contact Help Terms</div>"
    tail = "<div>All rights of this site are reserved by its owner since 1999</div>"
    rows = [
        (k, f"https://a.example/{k}", f"{menu}<p>{own(k)}</p>{tail}")
        for k in range(6)
    ]
    rows.append((50, "https://b.example/", f"{menu}<p>Alone</p>"))
    got = {r["page_id"]: r for r in hs.extract(spark, pages_frame(spark, rows)).collect()}
    for k in range(6):
        assert got[k]["text"] == own(k)
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[50]["text"] == "Home News Sport Weather About Contact Help Terms\nAlone"


def suffix_array_cover(streams, least):
    """Tokens of every page under an interval of the sorted suffixes that holds distinct pages."""
    suffixes = sorted((s[k:], page, k) for page, s in enumerate(streams) for k in range(len(s)))
    covered = [set() for _ in streams]
    start = 0
    while start < len(suffixes):
        width = least
        end = start + 1
        while end < len(suffixes) and suffixes[end][0][:width] == suffixes[start][0][:width]:
            end += 1
        group = [x for x in suffixes[start:end] if len(x[0]) >= width]
        if len({page for _, page, _ in group}) > 1:
            for _, page, k in group:
                covered[page].update(range(k, k + width))
        start = end
    return covered


@pytest.mark.parametrize("seed", range(3))
def test_against_a_full_suffix_array(spark, seed):
    import random

    rng = random.Random(seed)
    phrases = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 14))) for _ in range(8)]
    rows = []
    for k in range(25):
        blocks = [rng.choice(phrases) if rng.random() < 0.6 else " ".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(5)]
        rows.append((k, "http://h.example/", "".join(f"<p>{b}</p>" for b in blocks)))
    pages = [hs.parse(r[2]) for r in rows]
    covered = suffix_array_cover([p.stream() for p in pages], hs.LEAST)
    got = {r["page_id"]: r for r in hs.extract(spark, pages_frame(spark, rows)).collect()}
    for k, page in enumerate(pages):
        assert got[k]["text"] == page.unique(covered[k])
    counts = [r["n_covered"] for r in hs.boilerplate(spark, pages_frame(spark, rows)).collect()]
    assert sorted(counts) == sorted(len(c) for c in covered if c)


def test_articles_are_protected(spark):
    rows = [(k, "http://h.example/", "<article><p>The very same passage of an article that is told on every page</p></article>") for k in range(4)]
    assert {r["text"] for r in hs.extract(spark, pages_frame(spark, rows)).collect()} == {
        "The very same passage of an article that is told on every page"
    }


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "http://[bad", ""), (None, "x", "<article>t</article>"), (3, "http://h/", "no markup at all"),
        (3, "http://h/", "no markup at all"), (4, "http://h/", "<" * 5000), (5, "http://h/", "<p a='" * 300), (6, "http://h/", "<article>" + "w " * 50_000),
    ]
    got = hs.extract(spark, pages_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r["text"] for r in got}
    assert by_id[1] == by_id[2] == "" and by_id[None] == "t" and by_id[3] == "no markup at all" and by_id[6] == ("w " * 50_000).strip()
    assert hs.extract(spark, pages_frame(spark, [])).collect() == []


def test_every_page_meets_the_intervals(spark, monkeypatch):
    """Pages with an article took their text from markup alone before; now each is looked up in what the suffix array found."""
    menu = "<div><p>one two three four five six seven eight nine ten</p></div>"
    rows = [(k, "http://h/x", f"<article><p>Text {k} of its own</p></article>{menu}") for k in range(6)]
    pages = spark.createDataFrame([*rows, (6, "http://h/y", f"<p>open {'words ' * 12}here</p>{menu}"), (7, None, None)], "page_id long, url string, html string")
    found = hs.extract(spark, pages)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join LeftOuter") == 1
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert got == {k: f"Text {k} of its own" for k in range(6)} | {6: "open " + "words " * 12 + "here", 7: ""}
