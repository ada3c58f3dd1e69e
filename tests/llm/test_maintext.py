"""Main text of pages: written cases, and the supplied pages against a plain cut at their article element."""

import html
import re

import pytest

from calltrail.llm import maintext

LONG = "A long sentence of the story, with commas, and more words than a menu has, goes on for a while until it ends."
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style>{head}</head><body>{body}</body></html>"


CASES = {
    "article_element": (page(f"<nav>{MENU}</nav><article><h1>Head</h1><p>{LONG}</p><p>Short.</p></article><footer>Foot</footer>"), f"Head\n{LONG}\nShort."),
    "containers": (page(f'<div id="top">{MENU}</div><div class="x"><h1>Head</h1><div class="y"><p>{LONG}</p><p>{LONG}</p><p>Ok.</p></div></div><div>Call us, now</div>'), f"Head\n{LONG}\n{LONG}\nOk."),
    "one_paragraph": (page(f"<p>{LONG}</p>"), LONG),
    "siblings": (page(f"<div><div><p>{LONG}</p></div><div><p>{LONG}</p></div><div><p>{LONG}</p></div><div><a href=x>one,</a> <a href=x>two</a> <a href=x>three</a></div></div>"), "\n".join([LONG] * 3)),
    "sections": (page(f"<main><section><h2>One</h2><p>{LONG}</p></section><section><h2>Two</h2><p>Few words.</p></section></main>"), f"One\n{LONG}\nTwo\nFew words."),
    "names": (page(f'<div class="cookie-notice"><p>{LONG}</p></div><div id="sidebarLeft"><p>{LONG}</p></div><article><p>{LONG} x</p><div class="ad">Buy, now, this.</div></article><section id="comments"><article><p>{LONG}</p></article></section>'), LONG + " x"),
    "wrapper_with_odd_name": (page(f'<div class="sidebar-layout"><article><p>{LONG}</p></article></div>'), LONG),
    "teasers_in_sidebar": (page(f'<article><p>{LONG}</p></article><div class="sidebar"><article><p>{LONG} teaser</p></article></div>'), LONG),
    "names_that_deny": (page(f'<div class="no-sidebar has-menu"><p>{LONG}</p></div>'), LONG),
    "article_header": (page(f'<header><p>{LONG}</p></header><article class="post comments-open"><header class="entry-header"><h1>Head</h1></header><p>{LONG}</p></article>'), f"Head\n{LONG}"),
    "form_around_all": (page(f"<form><div><p>{LONG}</p></div></form>"), LONG),
    "form_inside": (page(f"<article><p>{LONG}</p><form><label>Name</label><p>Send, now, this, to, us.</p></form></article>"), LONG),
    "hidden": (page(f'<article><p>{LONG}</p><p style="display: none">no</p><p hidden>no</p><div aria-hidden="true">no</div><div role="search">no</div></article>'), LONG),
    "link_list_inside": (page(f"<article><p>{LONG}</p>{MENU}<p>See <a href=x>this</a>.</p></article>"), f"{LONG}\nSee this."),
    "scripts": (page(f'<article><script>var t="</p><p>no</p>";</script><p>{LONG}</p><noscript>no</noscript><style>no</style><textarea>no</textarea><svg><text>no</text></svg></article>', "<script>x<y</script>"), LONG),
    "references": (page(f"<article><p>{LONG} &amp;lt; &eacute;&#233;&#x1F600; &copy 1&nbsp;2 a&b</p></article>"), LONG + " &lt; éé😀 © 1 2 a&b"),
    "white_space": (page(f"<article><p>\n {LONG}\t\n and<br>more <b>b</b>old <i> it</i></p><pre>a\n  b</pre></article>"), f"{LONG} and more bold it\na b"),
    "unclosed": (page(f"<article><p><b>{LONG}<br><p>Two<p>Three</i></p></article>Tail"), f"{LONG}\nTwo\nThree"),
    "lists_and_tables": (page(f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>"), f"{LONG}\none\ntwo\na\nb\nc"),
    "tag_in_attribute": (page(f'<article><p title="a > b" data-x=it\'s>{LONG}</p></article>'), LONG),
    "comments_of_markup": (page(f"<article><!-- <p>no</p> --><p>{LONG}<!-- x --></p><!--></article><p>no</p>-->"), LONG),
    "menus_only": (page(f"<nav>{MENU}</nav><footer>{LONG}</footer>"), ""),
    "link_around_blocks": (page(f'<article><p>{LONG}</p><a href="x"><div>Linked, block</div></a><p>{LONG}</p></article>'), f"{LONG}\nLinked, block\n{LONG}"),
    "plain_text": (f"{LONG} 1 < 2 and 3 > 2", f"{LONG} 1 < 2 and 3 > 2"),
    "cut_off": (f"<article><p>{LONG}</p><p>Then <a href='x", f"{LONG}\nThen"),
    "nothing": ("", ""),
    "blank": (" \n<p> &nbsp; </p>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_written_cases(name):
    raw, want = CASES[name]
    assert maintext.extract(raw) == want


def test_supplied_pages_are_cut_at_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        own = re.search("<article>(.*)</article>", r.html, re.S)[1]
        found = [" ".join(html.unescape(re.sub("</?b>", "", b).replace("<br>", " ")).split()) for b in re.split("</?(?:p|h1)>", own)]
        want[r.page_id] = (r.url, "\n".join(b for b in found if b))
    got = maintext.main_text(pages).collect()
    assert len(got) == len(want) and all((r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_odd_rows_and_columns(spark):
    long = page("<article>" + "".join(f"<p>{LONG} {k}</p>" for k in range(20_000)) + "</article>")
    deep = "<div>" * 3000 + f"<p>{LONG}</p>"
    rows = [(1, "u", None, "x", "y"), (2, None, "", "x", "y"), (None, "u", long, None, None), (3, "u", deep, "x", None), (3, "u", deep, "x", None), (4, "u", "<b>" * 5000 + "<p>" * 5000 + "</i>" * 5000, None, None)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, text STRING, n_chars STRING")
    got = maintext.main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {(r.page_id, r.url): r for r in got.collect()}
    assert got.count() == 6 and found[1, "u"].text == found[2, None].text == found[4, "u"].text == ""
    assert found[None, "u"].text == "\n".join(f"{LONG} {k}" for k in range(20_000)) and found[3, "u"].text == LONG
    assert maintext.main_text(pages.limit(0)).collect() == []
