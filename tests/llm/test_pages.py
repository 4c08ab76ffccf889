"""Main text of pages: written pages with known articles, and awkward ones."""

import pytest

from stratavox.llm import extract

FIRST = "The first paragraph of the article says what it is about, and it has as many of the usual words as prose has."
SECOND = "The second one goes on with the same matter & a <quoted> tag, so that there is more than one block to be kept."
SHORT = "A short line of it."
PAGE = f"""<!DOCTYPE html><html><head><title>Title</title><style>p {{ color: red }}</style><script>var a = "<p>no</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">More of it</a></li></ul></nav>
<div class="cookie-banner">We use cookies, and by going on you agree to the use of all of them on this site of ours.</div>
<article><h2>Head line</h2><p>{FIRST.replace(" about", "&nbsp;about")}</p><!-- <p>hidden</p> -->
<p>The second one goes  on
with the same <b>matter</b> &amp; a &lt;quoted&gt; tag, so that there is more than one block to be kept.</p><p>{SHORT}</p>
<div class="advert">Buy the best of all things, and it is yours for the least that was ever asked for it by any of them.</div></article>
<aside>Elsewhere, there are some other articles that are not this one but that you might like to read as well as it.</aside>
<div id="comments"><p>I read the whole of it and I do not agree with what it says, as it was not like that at all for us.</p></div>
<form><label>Your mail</label><input name="m"></form><footer>© 2024 The owner of the site</footer></body></html>"""


def test_an_article_without_its_surroundings():
    assert extract.main_text(PAGE) == "\n\n".join(["Head line", FIRST, SECOND, SHORT])


def test_a_page_without_an_article_element():
    body = PAGE.replace("<article>", '<div class="content">').replace("</article>", "</div>")
    assert extract.main_text(body) == "\n\n".join(["Head line", FIRST, SECOND, SHORT])


def test_furniture_words_in_real_content():
    inner = [
        f'<div class="search-result"><p>{SECOND.replace("<", "&lt;").replace("&", "&amp;", 1)}</p></div>',
        f'<h2 id="discussion">Discussion</h2><section class="legal-history"><p>{FIRST}</p></section>',
        '<p>So <math><mi>x</mi> = 2</math> it is, as all of those who have read the first part of this will know by now.</p>',
        f'<p>The <a href="/a">{"links of this line " * 4}</a> are what it is made of.</p>',
    ]
    page = "<article><p>" + FIRST + "</p>" + "".join(inner) + '<div class="ad-slot">' + FIRST + '</div><ul class="share"><li>' + FIRST + "</li></ul></article>"
    found = extract.main_text(page).split("\n\n")
    assert found[0] == FIRST and found[-1].startswith("The links of this line") and found.count(FIRST) == 2
    assert "Discussion" in found and any("x = 2 it is" in x for x in found) and len(found) == 6
    bare = page.replace("<article>", "<div>").replace("</article>", "</div>")
    assert {FIRST, found[1]} <= set(extract.main_text(bare).split("\n\n"))
    assert extract._first_pass("data " * 40, 0, 2, False) == 0 and extract._first_pass(FIRST, 0, 2, False) == 1 and extract._first_pass("data " * 40, 0, 1, True) == -1


@pytest.mark.parametrize("source", ["", " ", "<", "<p", "<p>", "</p></div>", "<!--", "<script>", "<a href='", "&", "&#x110000;", "<" * 3000, "<div>" * 3000])
def test_broken_pages_do_not_crash(source):
    assert isinstance(extract.main_text(source), str)


def test_open_blocks_take_the_nearest_label():
    assert extract._second_pass([1, 0, 0, 0, -1], [1] * 5) == [1, 1, 1, -1, -1]
    assert extract._second_pass([0, 0], [1, 1]) == [-1, -1]
    assert extract._second_pass([0, -1], [2, 2]) == [1, -1]


def test_rows_of_pages(spark):
    rows = [(1, "u", PAGE, 3), (1, "u", PAGE, 3), (2, None, None, 3), (None, "v", "", 3), (4, "w", f"<p>{FIRST} </p>" * 2000, 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = extract.extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in found) == sorted((i or 0, u or "", len(extract.main_text(h or ""))) for i, u, h, _ in rows)
    assert all(r.n_chars == len(r.text) for r in found)
    assert {r.n_chars for r in found if r.page_id == 4} == {2000 * len(FIRST) + 2 * 1999}
    assert extract.extract_pages(pages.limit(0)).count() == 0
