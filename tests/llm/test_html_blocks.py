"""The block labeller on markup that it has not learned from: precision and recall per block."""

import random

import numpy as np
import pytest

import vitaelake
from vitaelake.llm import html_blocks
from vitaelake.llm.html_blocks import LEAVES, MAIN_TAGS, OTHER_TAGS, Block
from vitaelake.session import ship_packages

ALL_SEMANTIC = MAIN_TAGS | OTHER_TAGS


@pytest.fixture(scope="module")
def pages(spark):
    ship_packages(spark, vitaelake)
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = sorted(row.html for row in table.collect() if row.html)
    random.Random(5).shuffle(texts)
    return texts


@pytest.fixture(scope="module")
def net(pages):
    return html_blocks.fit(pages[:120])


@pytest.fixture(scope="module")
def held_out(pages):
    cut = [html_blocks.page_blocks(page) for page in pages[120:]]
    return [(blocks, [html_blocks.markup_label(block) for block in blocks]) for blocks in cut]


def restyled(blocks, tag, names):
    return [
        Block(tuple((tag(t), names(n)) for t, n in block.path), block.text, block.linked, block.container)
        for block in blocks
    ]


def unseen_names(held_out):
    """The altered forms of other pages, with names that no learned page has."""
    draw = random.Random(77)
    spare = [b.text for blocks, labels in held_out for b, m in zip(blocks, labels) if not m]
    found = []
    for blocks, labels in held_out:
        body = [(b, m) for b, m in zip(blocks, labels) if ("head", ()) not in b.path]
        found.append(html_blocks.altered(*map(list, zip(*body)), spare, draw))
    rename = {}

    def names(given):
        return tuple(rename.setdefault(name, f"zq{len(rename)}") for name in given)

    return [(restyled(blocks, lambda t: t, names), labels) for blocks, labels in found]


def plain(tag):
    return "div" if tag in ALL_SEMANTIC else tag


def in_tables(tag):
    """A layout by tables, which no learned form has."""
    return "td" if tag in ("p", "li", "div") else "table" if tag in ALL_SEMANTIC | {"ul"} else tag


STYLES = {
    "as given": lambda held_out: held_out,
    "without names": lambda held_out: [(restyled(b, lambda t: t, lambda n: ()), m) for b, m in held_out],
    "plain containers": lambda held_out: [(restyled(b, plain, lambda n: n), m) for b, m in held_out],
    "bare": lambda held_out: [(restyled(b, plain, lambda n: ()), m) for b, m in held_out],
    "tables": lambda held_out: [(restyled(b, in_tables, lambda n: ()), m) for b, m in held_out],
    "unseen names": unseen_names,
}


@pytest.mark.parametrize("style", STYLES)
def test_precision_and_recall_of_held_out_markup(net, held_out, style):
    right = found = wanted = 0
    for blocks, labels in STYLES[style](held_out):
        rows, mask = html_blocks.padded([html_blocks.block_vectors(blocks)])
        told = html_blocks.chances(net, rows, mask)[0] >= 0.5
        labels = np.array(labels, bool)
        right, found, wanted = right + (told & labels).sum(), found + told.sum(), wanted + labels.sum()
    floor = 0.999 if style == "as given" else 0.98
    print(f"{style}: precision {right / found:.4f}, recall {right / wanted:.4f}")
    assert right / found >= floor and right / wanted >= floor


def test_what_the_markup_says_is_no_input():
    """Inputs do not change with the lists that the labels come from."""
    page = '<nav><li>a</li></nav><div class="ad x-1">b c</div><article><p>d e f.</p></article>'
    blocks = html_blocks.page_blocks(page)
    html_blocks._path_vectors.clear()
    before = html_blocks.block_vectors(blocks)
    lists = html_blocks.MAIN_TAGS, html_blocks.OTHER_TAGS, html_blocks.OTHER_NAMES
    try:
        html_blocks.MAIN_TAGS, html_blocks.OTHER_TAGS, html_blocks.OTHER_NAMES = frozenset(), frozenset(), ()
        html_blocks._path_vectors.clear()
        assert (html_blocks.block_vectors(blocks) == before).all()
    finally:
        html_blocks.MAIN_TAGS, html_blocks.OTHER_TAGS, html_blocks.OTHER_NAMES = lists


def test_containers_of_blocks():
    page = "<body><ul><li>a<li>b</ul><div>c<p>d</p>e<section>f</section></div>g</body>"
    blocks = html_blocks.page_blocks(page)
    numbers = {block.text: block.container for block in blocks}
    assert numbers["a"] == numbers["b"] and numbers["c"] == numbers["d"] == numbers["e"]
    assert len({numbers[text] for text in "acfg"}) == 4
    assert "section" not in LEAVES and html_blocks.page_blocks("x")[0].container == 0


def test_long_and_deep_pages(spark, net):
    long = "<article>" + "".join(f"<p>Sentence number {n} of a long article.</p>" for n in range(20_000)) + "</article>"
    deep = "<div>" * 2000 + "<p>Far inside.</p>" + "</div>" * 2000 + "<p>Outside again.</p>"
    open_tags = "<article>" + "<b><i><p>Never closed. " * 3000
    texts = html_blocks.main_texts(net, [long, deep, open_tags, "", "<", "&amp;&#x41;"])
    assert texts[0].count("\n") > 19_000 and len(texts) == 6 and texts[3] == ""
    odd = [(1, None, None, "t", 1), (1, "u", long, "t", 1), (None, "u", "", "t", 1), (2, "u", "<p>a", "t", 1)]
    table = spark.createDataFrame(odd, "page_id long, url string, html string, text string, container int")
    found = html_blocks.extract(table).collect()
    assert len(found) == 4 and all(row.n_chars == len(row.text) for row in found)
    assert html_blocks.extract(table.limit(0)).collect() == []
