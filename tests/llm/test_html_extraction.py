"""Main text of pages: blocks by hand, the labeller's slopes, whole pages of several makes."""

import html
import random
import re

import numpy as np
import pytest

from statement_lake.llm import block_labeller, html_extraction
from statement_lake.llm.block_labeller import Labeller, sequenced
from statement_lake.llm.html_blocks import read_blocks
from statement_lake.llm.page_layouts import Layouts, told_labels

FOLDER = "/root/testdata/sf0.001"


def texts(page):
    return [b.text for b in read_blocks(page)]


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("", []),
        ("  \n ", []),
        ("plain text", ["plain text"]),
        ("<p>a<b>b</b>c<p>d", ["abc", "d"]),
        ("<p>x &amp; y &lt;z&gt; &eacute;&#233;&nbsp;&copy 5</p>", ["x & y <z> éé © 5"]),
        ("<div>a<br>b<br/>c</div>", ["a b c"]),
        ("a<script>var t='</p>';</script>b<style>p{}</style>c", ["a", "b", "c"]),
        ("a<!-- no <p> -->b", ["ab"]),
        ("a<!-- never ended <p>b", ["a"]),
        ("a<script>never ended <p>b", ["a"]),
        ("<ul><li>1<li>2</ul><dl><dt>t<dd>d</dl>", ["1", "2", "t", "d"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("3 < 4 and 5 > 2", ["3 < 4 and 5 > 2"]),
        ("a <b class='never", ["a"]),
        ("<p title='a > b'>t</p></div></p>u", ["t", "u"]),
        ("<TITLE>no</TITLE><P CLASS=x>Y</P>", ["Y"]),
        ("<select><option>1</select><textarea>x</textarea><svg><text>s</text></svg>y", ["y"]),
        ("<p><b>open<br><p>next</p>", ["open", "next"]),
    ],
)
def test_blocks(page, wanted):
    assert texts(page) == wanted


def test_paths_and_links():
    page = "<div class='post siteMenu' id=main><p>a <a href=x>link</a></p><p><b>c<p>d</div>e"
    first, second, third, last = read_blocks(page)
    assert [f.tag for f in first.path] == ["div", "p"] and first.path[0].words == ("post", "site", "menu", "main")
    assert (first.linked, first.links) == (4, 1)
    assert [f.tag for f in second.path] == ["div", "p", "b"] and [f.tag for f in third.path] == ["div", "p"]
    assert last.path == ()


def test_slopes_equal_differences():
    """The network's slopes against small steps, for weights of every kind."""
    model = Labeller(3)
    draw = Layouts(["some words of prose here and there"], 5)
    pages = [sequenced(*draw.page()) for _ in range(3)]
    for name in model.values:
        model.values[name] = model.values[name].astype(np.float64)
    _, slopes = model.slopes(pages)
    pick = random.Random(1)
    for name, value in model.values.items():
        used = np.argwhere(slopes[name] != 0)
        for _ in range(4):
            at = tuple(used[pick.randrange(len(used))])
            before, step = value[at], 1e-2
            value[at] = before + step
            above = model.slopes(pages)[0]
            value[at] = before - step
            below = model.slopes(pages)[0]
            value[at] = before
            assert slopes[name][at] == pytest.approx((above - below) / (2 * step), rel=0.05, abs=2e-4), name


@pytest.fixture(scope="module")
def model(spark):
    pages = [r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    return html_extraction.learn(pages)


def test_held_out_layouts(model):
    draw = Layouts([" ".join(f"word{i}{c}" for i in range(200)) for c in "abcdef"], 77)
    pages = [draw.page() for _ in range(150)]
    found = np.concatenate(model.probabilities([sequenced(b) for b, _ in pages])) >= 0.5
    assert (found == np.concatenate([labels for _, labels in pages])).mean() >= 0.97


def test_batches_do_not_change_labels(model, monkeypatch):
    draw = Layouts(["a few words of prose to set"], 8)
    pages = [sequenced(draw.page()[0]) for _ in range(20)] + [sequenced([])]
    whole = model.probabilities(pages)
    monkeypatch.setattr(block_labeller, "GATHERED", 5)
    monkeypatch.setattr(block_labeller, "TOGETHER", 1)
    for one, all_ in zip(model.probabilities(pages), whole):
        np.testing.assert_allclose(one, all_, atol=1e-4)


OTHER = """<!doctype html><html><head><title>T</title></head><body class="home">
<div class="cookie-banner"><p>We use cookies.</p><button>Accept all</button></div>
<div id="header"><h1>Site name</h1><ul class="menu"><li><a href=/>Home</a></li><li><a href=/x>World</a></li></ul></div>
<div class="post-content"><h1>The title</h1><p>First <a href=z>linked</a> paragraph of the story, with some words in it.</p>
<div class="advert">Buy this thing now, it is the best thing.</div>
<p>Second paragraph &amp; more words, for the reader to read.</p><ul><li>one point to make</li><li>another point</li></ul>
<blockquote>A quotation that somebody said some time ago.</blockquote></div>
<div class="sidebar"><h3>Related</h3><ul><li><a href=a>Other story</a></li><li><a href=b>One more</a></li></ul></div>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>I read the whole story and I do not agree with it.</p></div>
<form><label>Name</label><label>Your message</label></form></div>
<div class="footer"><p>&copy; 2023 All rights reserved.</p></div></body></html>"""


def test_a_page_without_telling_tags(model):
    found = html_extraction.main_texts([read_blocks(OTHER)], model)[0]
    assert found == (
        "The title First linked paragraph of the story, with some words in it. Second paragraph & more words, "
        "for the reader to read. one point to make another point A quotation that somebody said some time ago."
    )


def article(page):
    """What stands between the article's tags, by one search."""
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    return " ".join(html.unescape(re.sub("</?[a-z0-9]+[^>]*>", " ", inside)).split())


def test_whole_table(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = html_extraction.extract(pages, layouts=400, rounds=5)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    wanted = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    assert {r.page_id: (r.url, r.text) for r in found.collect()} == wanted
    assert found.where("n_chars <> length(text)").count() == 0


def test_odd_rows(spark, model):
    long = "<article>" + "<p>words of a long page</p>" * 20_000 + "</article>"
    rows = [
        (1, "u", None), (1, "u", None), (2, None, ""), (None, None, "<article><p>x y z</p></article>"), (3, "u", long),
        (4, "v", "<nav><a href=/>Home</a></nav>"), (5, "v", "<div>" * 3_000 + "deep" + "</div>" * 3_000),
    ]
    frame = spark.createDataFrame([(*r, "t", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = sorted(((r.page_id, r.url, r.text) for r in html_extraction.extract(frame, model=model).collect()), key=repr)
    assert len(found) == len(rows)
    assert (3, "u", " ".join(["words of a long page"] * 20_000)) in found
    assert (None, None, "x y z") in found and found.count((1, "u", "")) == 2 and (4, "v", "") in found
    empty = frame.where("false")
    assert html_extraction.extract(empty, layouts=3, rounds=1).count() == 0


def test_pages_that_tell_their_parts():
    blocks = read_blocks("<nav>n</nav><main><p>a</p><aside>s</aside><div class=comments>c</div></main><footer>f</footer>")
    assert told_labels(blocks) == [0, 1, 0, 0, 0] and told_labels(read_blocks("<p>a</p>")) is None
