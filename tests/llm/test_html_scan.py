"""Reading of tags: odd pages lose no text and take time in proportion to their length."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tickweave.llm import htmlcrf


def texts(page):
    return [b.text for b in htmlcrf.leaf_blocks(page)]


@pytest.mark.parametrize("page,want", [
    ("<p title=don't>First part.</p><p>It's the second.</p>", ["First part.", "It's the second."]),
    ('<p class="a"">First part</p><p>Second', ["First part", "Second"]),
    ('<p class="a>First</p><p>Second</p>', ["First", "Second"]),
    ("<p title='a > b' id=x>One</p><p title=\"it's\">Two</p>", ["One", "Two"]),
    ("1 < 2 and <3 hearts<p>next</p>", ["1 < 2 and <3 hearts", "next"]),
    ("<div>a<p", ["a<p"]), ("<div>a<!-- gone", ["a"]), ("<p>a<!-- x --!> y --><b>b</b>", ["ab"]),
    ("<p a = 'x y' b= c>t</p>", ["t"]), ("<P/><DIV/>t", ["t"]), ("just text", ["just text"]), ("", []), (None, []),
])
def test_odd_tags(page, want):
    assert texts(page) == want


def test_names_of_irregular_tags():
    for tag in ('<div class="side bar"" id=x1>', "<div id=x1 class='side bar' data-a=it's>", '<div id = x1 class = "side bar">'):
        (block,) = htmlcrf.leaf_blocks(f"{tag}text")
        assert set(block.path[-1][1]) == {"side", "bar", "x"}


@pytest.mark.parametrize("piece", ["<p ", '<a "', '<a x="', '<a x=">"y=">"', "<!--", "<script>", "</script ", "<", '<p class="', "<p x='\""])
@pytest.mark.parametrize("frame", ["{}", "<p>{}>", "<a {}>"])
def test_long_pages_of_broken_tags(piece, frame):
    begin = time.time()
    htmlcrf.leaf_blocks(frame.format(piece * (2_000_000 // len(piece))))
    assert time.time() - begin < 10  # in proportion: about a second; by the square: hours


def test_deep_pages_keep_their_text():
    page = "".join(f"<div>t{i}" for i in range(3_000)) + "</div>" * 3_000 + "<p>end"
    blocks = htmlcrf.leaf_blocks(page)
    assert [b.text for b in blocks] == [f"t{i}" for i in range(3_000)] + ["end"]
    assert max(len(b.path) for b in blocks) == htmlcrf.MOST_DEPTH and [t for t, _ in blocks[-1].path] == ["p"]


def test_random_tag_soup_keeps_words():
    rng, parts = random.Random(5), ["<p>", "</p>", "<div class='x'>", "</div>", '<b q="', "'", '"', "<i a=b'c>", "</i>", "<br/>", " word ", "&lt;", "="]
    for _ in range(300):
        soup = "".join(rng.choice(parts) for _ in range(40))
        assert texts(f"<p>first</p>{soup}")[0].startswith("first")


def test_plain_pages_and_extra_columns(spark):
    rows = [(1, "u", "A page of plain text,\n without any tag."), (1, "u", "A page of plain text,\n without any tag."), (2, None, "<p " * 300_000), (None, "v", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("text", "n_chars", "label")})
    got = {(r.page_id, r.text) for r in htmlcrf.extract(df).collect()}
    assert (1, "A page of plain text, without any tag.") in got and (None, "") in got and len(got) == 3


def test_training_recovers_the_labels():
    rng = random.Random(3)
    pages = [htmlcrf.labelled(htmlcrf.drawn_page(rng)) for _ in range(60)]
    chain = htmlcrf.train(pages)
    right = sum(a == b for blocks, labels in pages for a, b in zip(chain.decode(blocks), labels))
    assert right > 0.97 * sum(len(labels) for _, labels in pages)
