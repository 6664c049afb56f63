"""Tiles of the n-gram join: content in each, and crowded ones dealt anew without losing a link."""

from collections import Counter, defaultdict

import numpy as np
import pytest

import vitaelake
from vitaelake.llm import ngram_join
from vitaelake.session import ship_packages


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship_packages(spark, vitaelake)


def random_sets(sizes, seed=1):
    draw = np.random.default_rng(seed)
    keys = [np.sort(draw.integers(0, 1 << 64, size, dtype=np.uint64)) for size in sizes]
    return np.concatenate(keys), np.concatenate([[0], np.cumsum(sizes)])


@pytest.mark.parametrize("limit", [80, 90])
@pytest.mark.parametrize("low, high", [(1, 4), (5, 12), (20, 60), (90, 110), (300, 500)])
def test_unrelated_sets_share_no_tile(limit, low, high):
    sizes = np.random.default_rng(2).integers(low, high + 1, 4000)
    owner, found = ngram_join.tiles(*random_sets(sizes), limit)
    sharing = Counter(zip(found.tolist(), owner.tolist()))
    assert max(sharing.values()) == 1
    assert max(Counter(found.tolist()).values()) == 1
    assert set(owner.tolist()) == set(range(4000))


@pytest.mark.parametrize("limit", [80, 90])
def test_sets_in_few_parts_share_prefix_tiles(limit):
    """All shingles of both sets crowd into as many parts as the sets differ in."""
    for size in (8, 20, 60, 150):
        bands = np.searchsorted(ngram_join.band_edges(limit), [size], side="right") - 1
        apart = int(ngram_join.most_apart(bands, limit)[0])
        if not apart:
            continue
        draw = np.random.default_rng(size)
        # The high half of a hash says in which part it is.
        low = draw.integers(0, 1 << 20, size + apart, dtype=np.uint64)
        low = np.unique(low)
        first = low[: len(low) - apart // 2 or None]
        other = low[apart // 2 :]
        if not ngram_join.alike(first, other, limit):
            continue
        keys = np.concatenate([first, other])
        bounds = np.array([0, len(first), len(keys)])
        owner, found = ngram_join.tiles(keys, bounds, limit)
        assert set(found[owner == 0]) & set(found[owner == 1])


def template_texts():
    """Pages of templates with words of their own: some pages of a template are linked, most are
    not, though they share most of their parts."""
    texts = {}

    def add(text):
        texts[len(texts)] = text

    fixed = [f"word{n}" for n in range(60)]
    for n in range(60):
        add(" ".join([*fixed[:17], f"number{n}"]))
        add(" ".join([*fixed[:24], f"own{n}", *fixed[24:48]]))
        add(" ".join([*fixed[:9], f"x{n % 20}", *fixed[9:40], f"y{n % 7}", *fixed[40:]]))
    for n in range(10):
        add(" ".join([*fixed[:24], f"own{n}", *fixed[24:48], "end"]))
    return texts


def components_by_hand(texts, limit=90, size=3):
    sets = {}
    for key, text in texts.items():
        words = text.lower().split()
        sets[key] = {tuple(words[at : at + size]) for at in range(max(1, len(words) - size + 1))}
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= limit * len(sets[a] | sets[b]):
                one, other = sorted((root(a), root(b)))
                parent[other] = one
    return {key: root(key) for key in sets}


@pytest.mark.parametrize("crowded", [5, 2048])
def test_components_of_template_texts(spark, monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    texts = template_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {row.doc_id: row.component_id for row in ngram_join.components(docs).collect()}
    assert found == components_by_hand(texts)
    assert len(set(found.values())) > 60


def pairs_to_compare(members):
    halves = defaultdict(Counter)
    for row in members.collect():
        halves[row.tile][row.half] += 1
    return sum(n[0] * n[1] + n[2] * (n[2] - 1) // 2 for n in halves.values())


def test_crowded_tiles_of_a_template_are_dealt_apart(spark, monkeypatch):
    """Pairs to compare do not grow with the pages of a template."""
    monkeypatch.setattr(ngram_join, "CROWDED", 20)
    fixed = [f"word{n}" for n in range(48)]
    before, after = [], []
    for count in (150, 300, 600):
        texts = [" ".join([*fixed[:24], f"own{n}", *fixed[24:]]) for n in range(count)]
        texts += [" ".join([*fixed[:17], f"number{n}"]) for n in range(count)]
        keys, bounds = ngram_join.shingle_sets([text.encode() for text in texts])
        nodes = ngram_join.set_nodes(keys, bounds).tolist()
        owner, found = ngram_join.tiles(keys, bounds, 90)
        members = spark.createDataFrame(
            [(tile, nodes[at], nodes[at], 2) for at, tile in zip(owner.tolist(), found.view(np.int64).tolist())],
            "tile long, node long, component long, half int",
        )
        stored = spark.createDataFrame(list(zip(nodes, texts)), "node long, text string")
        before.append(pairs_to_compare(members))
        after.append(pairs_to_compare(ngram_join.deal_crowded(members, stored, 3, 90)))
    assert before[2] > 12 * before[0]
    assert after[2] <= 4 * after[0] + 40 and after[2] < 600


def test_prefixes_of_linked_sets_meet():
    """For all sizes of two linked sets, whatever shingles they differ in."""
    draw = np.random.default_rng(4)
    for limit in (80, 90):
        for _ in range(400):
            size = int(draw.integers(1, 300))
            universe = draw.permutation(400)
            one = set(universe[:size].tolist())
            gone = int(draw.integers(0, 1 + size // 8))
            other = set(list(one)[gone:]) | set(universe[size : size + int(draw.integers(0, 1 + size // 8))].tolist())
            if not other or 100 * len(one & other) < limit * len(one | other):
                continue
            tiles = []
            for mine in (one, other):
                classes, counts, own = ngram_join.partner_prefixes(len(mine), limit)
                order = sorted(mine)
                tiles.append({
                    (min(c, own), max(c, own), shingle)
                    for c, count in zip(classes.tolist(), counts.tolist())
                    for shingle in order[: max(count, 0)]
                })
            assert tiles[0] & tiles[1]
