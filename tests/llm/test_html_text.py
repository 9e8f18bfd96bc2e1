from __future__ import annotations

import random
from html.parser import HTMLParser

import numpy as np
import pytest

from marketloom.llm import html_text as ht
from marketloom.llm.labelled_blocks import PAGES


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("<article><h1>T &amp; U</h1><p>one\n  two<br>three<p>f<b>ou</b>r</article>", "T & U one two three four"),
        ("<nav><a href=x>Home</a></nav><article><p>Body.</p></article><footer>&copy; us</footer>", "Body."),
        ("<div class=\"ad\">Buy this now and be happy ever after, we promise.</div><article>Text</article>", "Text"),
        ("<title>No</title><script>var t='</p><article>no</article>'</script><article>Yes<!-- <p>no --></article>", "Yes"),
        ("<article><p>a &lt; b &#233; &eacute;&nbsp;x</p></article>", "a < b é é x"),
        ("<article>open <script>never closed", "open"),
        ("<article>open <!-- never closed", "open"),
        ("<article><aside>side</aside><p>main</p><div id=comments><p>I think so too, and so do many others here.</p></div></article>", "main"),
        ("<div class=ad><article>inner article wins</article>", "inner article wins"),
        ("<article><p title='a > b'>quoted</p></article>", "quoted"),
        ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
        ("<main><form><p>Name of the person who fills in this form</p></form><p>after</p></main>", "after"),
        ("</div></nav><article>stray</article>", "stray"),
    ],
)
def test_pages(page, want):
    assert ht.main_text(page) == want


def test_the_tree_knows_its_table():
    for page in PAGES:
        found = ht.blocks("".join(piece for _, piece in page))
        marks = [mark == "+" for mark, piece in page for _ in ht.blocks(piece)]
        assert ht.predict(ht.trained(), ht.features(found)).tolist() == marks


@pytest.mark.parametrize(("hints", "least"), [(True, 0.9), (False, 0.8)])
def test_pages_left_out_of_training(hints, least):
    """Each labelled page classified by a tree of the others, with its hints and without any."""
    x, y = [], []
    for page in PAGES:
        x.append(ht.features(ht.blocks("".join(piece for _, piece in page))))
        y.append([float(mark == "+") for mark, piece in page for _ in ht.blocks(piece)])
    right = total = 0
    for k in range(len(PAGES)):
        rows = [part for j, own in enumerate(x) if j != k for part in [own] * ht.WITH_HINTS + [ht.without_hints(own)]]
        marks = [mark for j, own in enumerate(y) if j != k for mark in own * (ht.WITH_HINTS + 1)]
        tree = ht.grow(np.concatenate(rows), np.array(marks))
        right += (ht.predict(tree, x[k] if hints else ht.without_hints(x[k])) == np.array(y[k], bool)).sum()
        total += len(y[k])
    assert right >= least * total


STORY = "The first paragraph of the story is long enough to be taken for one by anybody who reads it."
MORE = "And the second paragraph goes on about the same thing for a while before it ends."


@pytest.mark.parametrize(
    "inside",
    [
        "<svg class='icon'/>", "<svg><path d='M0 0'/><text>no</text></svg>", "<iframe src=x />", "<iframe src='x'></iframe>", "<object/>", "<title/>", "<select>", "<select><option>no<option>no</select>",
        "<textarea>", "<template><p>no</p></template>", "<canvas>", "<noscript>no</noscript>", "<script src='x'/>", "<style/>", "<div hidden>no</div>", "<p style='color:red; display: none'>no</p>",
        "<span aria-hidden=true>no</span>", "<video controls>no</video>", "<!-- no -->", "<div/>", "<br/>",
    ],
)
def test_an_element_loses_no_text_around_it(inside):
    assert ht.main_text(f"<article><p>{STORY}</p>{inside}<p>{MORE}</p></article>") == f"{STORY} {MORE}"


@pytest.mark.parametrize(
    "attributes",
    ["aria-hidden='false'", "data-id='comment-12'", "data-role=navigation", "data-class='ad'", "class='related-work'", "title=don't", "title='a > b'", "class='legal-history'", "style='display:block'", "alt=\"it's\"", "data-x=/a/b/", "id='shared-values'"],
)
def test_attributes_that_tell_nothing(attributes):
    assert ht.main_text(f"<article><p>{STORY}</p><div {attributes}><p>{MORE}</p></div></article>") == f"{STORY} {MORE}"
    assert ht.main_text(f"<article><p>{STORY}</p><p {attributes}>{MORE}</article>") == f"{STORY} {MORE}"


@pytest.mark.parametrize(
    "noise",
    [
        "<p class='ad'>Buy shoes now and get a third pair free in all our shops.</p>", "<ul><li class='comment'>I think so too, and so do many others here.</li></ul>",
        "<span class='advert'>Buy shoes now and get a third pair free in all our shops.</span>", "<div id=cookie-banner><p>We use cookies to make this site work for you.</p></div>",
        "<table><tr><td class=sponsored>Paid for by the makers of fine shoes everywhere.</td></tr></table>", "<p class='newsletter-signup'>Get our letter every week, with the best of the site.",
    ],
)
def test_names_of_surroundings_count_on_any_element(noise):
    assert ht.main_text(f"<article><p>{STORY}</p>{noise}<p>{MORE}</p></article>") == f"{STORY} {MORE}"


class Reader(HTMLParser):
    """Flat blocks of a well-formed page, read by the standard parser: text, words and words in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.text, self.linked, self.link, self.skip = [], "", 0, False, 0

    def cut(self):
        words = self.text.split()
        if words:
            self.found.append((" ".join(words), len(words), min(len(words), self.linked)))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "svg"):
            self.skip += 1
            self.text += " " if tag != "svg" else ""
            if tag == "svg":
                self.cut()
        elif tag == "br":
            self.text += " "
        elif tag == "a":
            self.link = True
        elif tag in ht.BLOCKS:
            self.cut()
            self.link = False

    def handle_endtag(self, tag):
        if tag in ("script", "style", "svg"):
            self.skip -= 1
            if tag == "svg":
                self.cut()
        elif tag == "a":
            self.link = False
        elif tag in ht.BLOCKS:
            self.cut()

    def handle_data(self, data):
        if not self.skip:
            self.text += data
            self.linked += len(data.split()) if self.link else 0


def random_page(r, depth=0):
    out = []
    for _ in range(r.randrange(1, 5)):
        kind = r.randrange(8)
        words = " ".join(r.choice(["one", "two &amp; three", "fo&#117;r", "&eacute;t\u00e9", "x\n y", "1 &lt; 2"]) for _ in range(r.randrange(1, 9)))
        if kind == 0 and depth < 4:
            out.append(f"<{(t := r.choice(['div', 'section', 'ul', 'blockquote', 'td']))} data-n='{r.random()}'>{random_page(r, depth + 1)}</{t}>")
        elif kind == 1:
            out.append(f"<p>{words}</p>")
        elif kind == 2:
            out.append(f"<p><a href='/x?a=1&b=2'>{words}</a> and <b>{words}</b></p>")
        elif kind == 3:
            out.append(f"<h2>{words}</h2>")
        elif kind == 4:
            out.append(f"<script>var a = '<p>no</p>';</script>{words}<br>{words}")
        elif kind == 5:
            out.append(f"<svg><g><path d='M'/>{words}</g></svg>")
        elif kind == 6:
            out.append(f"<!-- {words} <p> --><i>{words}</i>")
        else:
            out.append(words + " ")
    return "".join(out)


def test_blocks_equal_those_of_another_reader():
    r = random.Random(3)
    for _ in range(300):
        page = random_page(r)
        reader = Reader()
        reader.feed(page)
        reader.close()
        reader.cut()
        assert [(b.text, b.words, b.linked) for b in ht.blocks(page)] == reader.found, page


def test_a_very_long_page_is_read_whole():
    text = f"<p>{STORY}</p>" * 20_000
    assert ht.main_text(f"<nav><a href='/'>Home</a></nav><article>{text}</article>") == " ".join([STORY] * 20_000)


def test_many_open_tags_take_linear_time():
    assert ht.main_text("<article>" + "<div>x" * 20_000).startswith("x x")
    assert ht.main_text("<article>" + "<" * 100_000 + "end").endswith("end")
    assert ht.main_text("<article>" + "<a b='" * 3000) is not None


def test_rows(spark):
    rows = [(1, "u", "<article>x y</article>", 5), (None, None, None, None), (1, "u", "<article>x y</article>", 5), (2, "v", "plain", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long")
    assert sorted(map(tuple, ht.extract(pages).collect()), key=repr) == [(1, "u", "x y", 3), (1, "u", "x y", 3), (2, "v", "", 0), (None, None, "", 0)]
    assert ht.extract(pages.limit(0)).collect() == []
