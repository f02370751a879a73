"""Markup that names parts of a page, and what counts as boilerplate of a host."""

import pytest

from loanlake.llm import host_suffixes as hs
from test_pages import pages_frame


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ('<article style="overflow:hidden"><p title="the hidden truth">a</p><p data-id="comment">b</p></article>', "a\nb"),
        ('<article>see <a href="/posts/hidden-gems">gems</a> or <a href="/p?id=menu">more</a></article>', "see gems or more"),
        ('<body class="single no-sidebar"><article>a</article></body>', "a"),
        ('<main class="with-sidebar">a</main>', "a"),
        ('<article class="post sponsored has-comments">a</article>', "a"),
        ('<article>a<div class="no-ads">b</div><div class="post-comments">c</div><div class="ad-slot">d</div></article>', "a\nb"),
        ('<article>a<div id="comments">b</div><p hidden>c</p><div class="site-footer">d</div></article>', "a"),
        ('<article id="comment-3">a</article><article>b</article>', "b"),
        ("<article><figure><img src=x><figcaption>caption</figcaption></figure></article>", "caption"),
        ("<article><style-guide>a</style-guide><p>b</p></article>", "a\nb"),
        ('<div title="role=main">x</div><main>a</main>', "a"),
        ('<article><h2 id="notice">Notice periods</h2><p>a</p><h3 id="social-effects">Effects</h3></article>', "Notice periods\na\nEffects"),
        ('<article>see <a id="related-work">the earlier work</a> and <span class="ad-hoc">ad hoc</span> fixes</article>', "see the earlier work and ad hoc fixes"),
        ('<article><section id="comments-on-the-law">a</section><div class="share-price-table">b</div></article>', "a\nb"),
        ('<article><table><tr><td class="social">a</td></tr></table><p class="notice">b</p></article>', "a\nb"),
        ('<article>a<div class="share-buttons">b</div><ul class="related_posts">c</ul><p class="advertisement">d</p>e</article>', "a\ne"),
        ('<article>a<div class="cookie-notice">b</div><section id="comments"><h2>c</h2><p>d</p></section></article>', "a"),
    ],
)
def test_markup_names_what_goes(source, text):
    assert hs.parse(source).text() == text


def test_deep_nesting_is_read_in_one_pass():
    """Unclosed elements and closing tags without an opening one, tens of thousands deep."""
    deep = "<div>x" * 30_000 + "</section>" * 30_000
    page = hs.parse("<article>" + deep + "</article>")
    assert page.text() == "\n".join(["x"] * 30_000)


def own(k):
    return " ".join(f"word{k * 31 + j}" for j in range(12))


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in hs.extract(spark, pages_frame(spark, rows)).collect()}


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(k, f"https://a.example/{k}", f"<p>{own(0)}</p>") for k in range(3)]
    rows += [(k, None if k % 2 else "http://[bad", f"<p>{own(1)}</p><p>own {k}</p>") for k in range(10, 14)]
    got = texts(spark, rows)
    assert [got[k] for k in range(3)] == [own(0)] * 3
    assert [got[k] for k in range(10, 14)] == [f"{own(1)}\nown {k}" for k in range(10, 14)]


def test_a_passage_of_two_pages_is_no_boilerplate_of_a_large_host(spark):
    menu = "<div>Home News Sport Weather About Contact Help Terms</div>"
    rows = [(k, f"https://a.example/{k}", f"{menu}<p>{own(k)}</p>" + f"<p>{own(1000)}</p>" * (k < 2)) for k in range(60)]
    got = texts(spark, rows)
    assert all(got[k] == (f"{own(k)}\n{own(1000)}" if k < 2 else own(k)) for k in range(60))


def test_intervals_decide_outside_the_article_too(spark):
    menu = "<div>Home News Sport Weather About Contact Help Terms</div>"
    rows = [
        (k, f"https://a.example/{k}", f"{menu}<main><p>{own(k)}</p><article>story {k}</article></main><div>aside {k}</div>") for k in range(4)
    ]
    rows += [(k, f"https://a.example/{k}", f"{menu}<article>teaser {k}</article><div>{own(k)}</div>") for k in range(4, 8)]
    got = texts(spark, rows)
    assert all(got[k] == f"{own(k)}\nstory {k}" for k in range(4))
    assert all(got[k] == f"teaser {k}\n{own(k)}" for k in range(4, 8))
