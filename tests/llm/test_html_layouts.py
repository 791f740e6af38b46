"""Pages laid out by hand, as common site generators do it, none of them drawn by the labeller's own generator."""

import pytest

from tidegauge.llm import html

H = "The harbour reopens after eleven months"
P = [
    "After eleven months of repairs the old harbour reopened on Monday morning, and the first ferry left at seven.",
    "The town council had closed the quay last spring when divers found cracks in two of the stone piers, some of them a metre deep.",
    "“We lost a whole season,” said the owner of the fish market, “but the new wall should stand for another century.”",
]
ARTICLE = "".join(f"<p>{p}</p>" for p in P)
NAV = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li><li><a href="/about">About us</a></li></ul>'
FOOT = "<p>© 2021 The Quay Gazette. All rights reserved.</p>"
#: name -> (page, blocks of main text beside H and P, blocks that are not)
PAGES = {
    "article": (f"<html><body><article><h1>{H}</h1>{ARTICLE}</article></body></html>", [], []),
    "body names": (f'<html class="no-js"><body class="header-fixed menu-open"><nav>{NAV}</nav><article><h1>{H}</h1>{ARTICLE}</article><footer>{FOOT}</footer></body></html>', [], ["Home", "News", "Sport", "About us", FOOT[3:-4]]),
    "misleading name": (f'<html><body><article class="article social-feed"><h1>{H}</h1>{ARTICLE}</article></body></html>', [], []),
    "wrapper form": (f'<html><body><form id="aspnetForm" method="post"><div id="content"><h1>{H}</h1>{ARTICLE}</div></form></body></html>', [], []),
    "no names": (f"<html><body><div><div><h1>{H}</h1>{ARTICLE}</div></div></body></html>", [], []),
    "icon": (f'<html><body><article><h1>{H}</h1><p>{P[0]}</p><svg width="1"/><p>{P[1]}</p><p>{P[2]}</p></article></body></html>', [], []),
    "open title": (f"<html><head><title>Quay<body><main><h1>{H}</h1>{ARTICLE}</main></body></html>", [], []),
    "blog": (f'<html><body class="single single-post logged-out"><div id="page" class="hfeed site"><header id="masthead" class="site-header"><p class="site-title"><a href="/">The Quay Gazette</a></p><nav id="site-navigation" class="main-navigation">{NAV}</nav></header><div id="primary" class="content-area"><main id="main" class="site-main"><article id="post-17" class="post-17 post type-post hentry category-news"><header class="entry-header"><h1 class="entry-title">{H}</h1></header><div class="entry-content">{ARTICLE}</div></article><div id="comments" class="comments-area"><ol class="comment-list"><li class="comment"><article class="comment-body"><p>Good news at last, my boat has been on land since March.</p></article></li></ol><div id="respond" class="comment-respond"><h3>Leave a reply</h3><form id="commentform"><p>Your email address will not be published.</p></form></div></div></main></div><aside id="secondary" class="widget-area"><section class="widget widget_recent_entries"><h2>Recent posts</h2><ul><li><a href="/a">Rain in the hills</a></li></ul></section></aside><footer id="colophon" class="site-footer">{FOOT}</footer></div></body></html>', [], ["The Quay Gazette", "Home", "News", "Sport", "About us", "Good news at last, my boat has been on land since March.", "Leave a reply", "Your email address will not be published.", "Recent posts", "Rain in the hills", FOOT[3:-4]]),
    "bootstrap": (f'<html><body><nav class="navbar navbar-expand-lg"><div class="container">{NAV}</div></nav><div class="container mt-4"><div class="row"><div class="col-md-8"><h1>{H}</h1>{ARTICLE}</div><div class="col-md-4 sidebar"><div class="card"><p>Subscribe to our newsletter</p></div></div></div></div><footer class="footer py-3">{FOOT}</footer></body></html>', [], ["Home", "News", "Sport", "About us", "Subscribe to our newsletter", FOOT[3:-4]]),
    "tables": (f'<html><body><table><tr><td class="menu"><a href="/">Home</a></td><td class="menu"><a href="/news">News</a></td></tr></table><table><tr><td class="content"><h1>{H}</h1>{ARTICLE}</td></tr></table><table><tr><td class="footer">{FOOT}</td></tr></table></body></html>', [], ["Home", "News", FOOT[3:-4]]),
    "news site": (f'<html><body class="with-ads has-sidebar"><div class="cookie-banner"><p>We use cookies to improve our site.</p><button>Accept all</button></div><header class="SiteHeader"><div class="SiteHeader-nav">{NAV}</div></header><main><div class="AdSlot"><p>Advertisement</p></div><article class="Story"><h1 class="Story-headline">{H}</h1><div class="Story-body">{ARTICLE}<aside class="RelatedLinks"><h3>Related stories</h3><p><a href="/b">Fishermen count their losses</a></p></aside><blockquote><p>The sea takes what it wants, and gives back what it likes.</p></blockquote></div></article></main><footer><div class="legal">{FOOT}</div></footer></body></html>', ["The sea takes what it wants, and gives back what it likes."], ["We use cookies to improve our site.", "Accept all", "Home", "News", "Sport", "About us", "Advertisement", "Related stories", "Fishermen count their losses", FOOT[3:-4]]),
    "docs": (f'<html><body><div class="sidebar-tree"><ul><li><a href="1">Install</a></li><li><a href="2">Configure</a></li></ul></div><div class="document" role="main"><section id="harbour"><h1>{H}</h1><p>{P[0]}</p><pre>quay open --pier 2</pre><p>{P[1]}</p><ul><li>Check the tide table before you sail.</li><li>Keep to the marked channel.</li></ul><p>{P[2]}</p></section></div><div class="footer" role="contentinfo">{FOOT}</div></body></html>', ["quay open --pier 2", "Check the tide table before you sail.", "Keep to the marked channel."], ["Install", "Configure", FOOT[3:-4]]),
    "many comments": (f'<html><body><article><h1>{H}</h1>{ARTICLE}</article><section class="comments"><h2>12 comments</h2>' + "".join(f'<div class="comment"><p>I have waited for this day number {i} and I am glad that it has come, since the walk round the bay took me an hour each way.</p></div>' for i in range(12)) + "</section></body></html>", [], ["12 comments"] + [f"I have waited for this day number {i} and I am glad that it has come, since the walk round the bay took me an hour each way." for i in range(12)]),
    "content wrapper": (f'<html><body><div class="no-sidebar menu-closed"><div class="main-content"><h1>{H}</h1>{ARTICLE}</div></div><div id="footer">{FOOT}</div></body></html>', [], [FOOT[3:-4]]),
    "plain with links": (f"<html><body><div>{NAV}</div><div><h1>{H}</h1>{ARTICLE}</div><div>{FOOT}</div></body></html>", [], ["Home", "News", "Sport", "About us"]),
    "main with nav first": (f'<html><body><div id="app"><div class="topbar"><a href="/">Quay</a><a href="/in">Log in</a></div><div class="breadcrumbs"><a href="/">Home</a> / <a href="/news">News</a></div><main class="page"><h1>{H}</h1>{ARTICLE}<div class="share-buttons"><a href="#">Share this</a></div></main></div></body></html>', [], ["QuayLog in", "Home / News", "Share this"]),
    "recipe": (f'<html><body><header class="site"><nav>{NAV}</nav></header><main><h1>{H}</h1><p>{P[0]}</p><h2>Ingredients</h2><ul class="ingredients"><li>2 eggs</li><li>100 g flour</li><li>a pinch of salt</li><li>half a litre of milk</li></ul><h2>Method</h2><ol><li>Beat the eggs.</li><li>Add flour and salt.</li><li>Stir in the milk and let it rest for an hour.</li></ol><p>{P[1]}</p><p>{P[2]}</p></main><footer>{FOOT}</footer></body></html>', ["2 eggs", "100 g flour", "a pinch of salt", "half a litre of milk", "Beat the eggs.", "Add flour and salt.", "Stir in the milk and let it rest for an hour."], ["Home", "News", FOOT[3:-4]]),
    "table": (f'<html><body><nav>{NAV}</nav><article><h1>{H}</h1><p>{P[0]}</p><table><tr><th>Key</th><th>Value</th></tr><tr><td>Length</td><td>240 m</td></tr><tr><td>Depth at low water</td><td>6 m</td></tr></table><p>{P[1]}</p><p>{P[2]}</p></article><footer>{FOOT}</footer></body></html>', ["Key", "Value", "Length", "240 m", "Depth at low water", "6 m"], ["Home", "News", FOOT[3:-4]]),
    "question": (f'<html><body><nav class="topbar">{NAV}</nav><div id="content"><div class="question"><h1>{H}</h1><p>{P[0]}</p></div><div class="answer"><p>{P[1]}</p></div><div class="answer"><p>{P[2]}</p></div></div><footer>{FOOT}</footer></body></html>', [], ["Home", "News", FOOT[3:-4]]),
    "glossary": (f'<html><body><nav>{NAV}</nav><main class="content"><h1>{H}</h1><p>{P[0]}</p><dl><dt>Pier</dt><dd>A wall that runs out into the sea.</dd><dt>Quay</dt><dd>A wall along the shore, where ships lie.</dd></dl><p>{P[1]}</p><p>{P[2]}</p></main></body></html>', ["Pier", "A wall that runs out into the sea.", "Quay", "A wall along the shore, where ships lie."], ["Home", "News"]),
    "photo story": (f'<html><body><header><nav>{NAV}</nav></header><article class="post"><h1>{H}</h1><p>{P[0]}</p><figure><img src="1.jpg"><figcaption>The first ferry, Monday.</figcaption></figure><p>{P[1]}</p><figure><img src="2.jpg"><figcaption>Divers at the north pier</figcaption></figure><p>{P[2]}</p></article><footer>{FOOT}</footer></body></html>', ["The first ferry, Monday.", "Divers at the north pier"], ["Home", "Sport", FOOT[3:-4]]),
}


@pytest.fixture(scope="module")
def net():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    return html.train(tuple(pages), html.DRAWN, html.SEED)


def kept(net, page):
    return next(html.extract_pages(net, [(1, "u", page)], html.Reader()))[2].split("\n")


@pytest.mark.parametrize("name", PAGES)
def test_article_is_whole(net, name):
    page, more, _ = PAGES[name]
    got = kept(net, page)
    assert [x for x in (P if name == "open title" else [*P, *more]) if x not in got] == []


def test_blocks_are_told_apart(net):
    right = wrong = 0
    for page, more, others in PAGES.values():
        got = kept(net, page)
        for text in (H, *P, *more):
            right, wrong = right + (text in got), wrong + (text not in got)
        for text in others:
            right, wrong = right + (text not in got), wrong + (text in got)
    assert right / (right + wrong) >= 0.97


def test_odd_markup_takes_linear_time():
    import time

    began = time.time()
    for piece in ("<!x", "<div>x", "<a ", "</b>", '<p "', "<svg", "<title>", "&#", "<li>y"):
        html.leaves(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 60


def test_labeller_is_kept(spark, tmp_path, net):
    folder = "file://" + str(tmp_path / "weights")
    first = html.kept_labeller(spark, folder, lambda: net)
    again = html.kept_labeller(spark, folder, lambda: 1 / 0)
    assert all((first.w[k] == again.w[k]).all() for k in first.w)
