"""N-gram Jaccard join: documents whose sets of word n-grams are alike, exactly.

The n-gram length ``words`` and the likeness in percent ``limit`` are arguments; the defaults are
those of the op9 query. Documents are put in size bands so narrow that linked ones lie in the same or in adjacent bands.
Sets that are alike differ in at most ``K`` shingles, ``K`` known from the band. The 64-bit
hash space is cut into equal parts, so many that nearly every set has shingles in more than ``K`` of
them; then some part with a shingle in it is the same in both, and a tile is what shares one whole
part: (band, part, hash of the part). Frequent shingles make no large tiles, as a part holds several.
The few sets with shingles in no more than ``K`` parts have prefix tiles as well: of linked sets,
the first shingles by hash, one more than may be missing, have one in common. So each tile has
content, and unrelated sets share none.

1. Every document's tiles are looked up; in each, all are paired with one of them (first within a
   task, so a tile that a third of all documents share reaches the shuffle as a row per task).
2. Pairs are compared: a bitmap of hashed shingles bounds the overlap from above by a bit count,
   and those that may reach the limit are intersected as sorted arrays.
3. Where a pair of step 1 was not a link, other members of its tiles may still be linked. The
   components it touched are compared again, all members of a tile but those already connected,
   in blocks of bounded size. A crowded tile (pages of one template, each with a word of its own)
   is not compared whole: its members are dealt anew by their rarest shingles, as many as linked
   sets of their two sizes must have one of in common, so texts that share only a template part.

Only connections are needed, so a group of n copies costs n pairs, and no link between different
texts is lost.

Defined results: null and empty texts have no shingles, a component of their own and no links;
fewer words than a shingle holds are one shingle; a null doc_id is no candidate for a component's name (a
component of only such rows has none); repeated rows are one set; an empty table gives an empty
table; further columns are ignored.
"""

from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitaelake.llm.components import connected_components
from vitaelake.llm.native import Scratch, staged
from vitaelake.llm.wordarrays import batches_of, cut_words, mixed, pieces, utf8

WORDS = 3
# Two sets are linked when limit * |union| <= 100 * |intersection|.
LIMIT = 90
# Tile rows a task holds before it pairs them; documents of a block compared in one task.
HELD_ROWS = 250_000
BLOCK = 256
# Members of a tile beyond which they are dealt anew by their rarest shingles. Up to here a member is
# copied to a few blocks as a bitmap, which is less than all its shingles are.
CROWDED = 2048
# Parts of the tiles that are shuffled one after the other: each set's tiles are made anew for each.
TILE_PARTS = 2
# Bytes that a comparison moves at once for each shingle of the table, which is half of what all
# tiles are; one that moves more is cut into parts, however many pairs and tiles there are. Small
# tables are not cut.
MOVED_PER_SHINGLE = 8
LEAST_MOVED = 64 << 20
# Of a row with a tile and a node; of one with a bitmap.
TILE_BYTES, BITMAP_BYTES = 17, 300
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def steps_of(words: int) -> np.ndarray:
    """The odd factor of each place in a shingle."""
    later = mixed(np.arange(len(_STEPS), max(words, len(_STEPS)), dtype=np.uint64)) | np.uint64(1)
    return np.concatenate([_STEPS, later])


def shingle_sets(texts: list[bytes], length: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and bounds."""
    factors = steps_of(length)
    cut = cut_words(texts)
    first, words = cut.first, cut.hashes
    counts = np.diff(first)
    number = np.repeat(np.arange(len(texts)), counts)
    keys = words * factors[0]
    for step in range(1, length):
        inside = np.zeros(len(words), bool)
        inside[: len(words) - step] = number[step:] == number[: len(words) - step]
        later = np.zeros(len(words), np.uint64)
        later[: len(words) - step] = words[step:]
        keys += np.where(inside, (later + np.uint64(step)) * factors[step], np.uint64(0))
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    whole = place <= np.repeat(np.maximum(counts - length, 0), counts)
    keys, number = mixed(keys[whole]), number[whole]
    order = np.lexsort((keys, number))
    keys, number = keys[order], number[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])
    keys, number = keys[fresh], number[fresh]
    return keys, np.searchsorted(number, np.arange(len(texts) + 1))


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.empty(0, np.uint64)


def set_nodes(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set; 0 for the empty one."""
    nodes = np.zeros(len(bounds) - 1, np.uint64)
    sizes = np.diff(bounds)
    filled = sizes > 0
    total = sums(mixed(keys ^ np.uint64(0xA5A5A5A5)), bounds[:-1][filled])
    nodes[filled] = mixed(total + sizes[filled].astype(np.uint64))
    return nodes.view(np.int64)


@cache
def band_edges(limit: int = LIMIT) -> np.ndarray:
    """Smallest set size of each band: sizes a <= b with 100 a >= limit b are at most a band apart."""
    edges = [1, 2]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // limit + 1))
    return np.array(edges, np.int64)


def most_apart(bands: np.ndarray, limit: int) -> np.ndarray:
    """Shingles that two linked sets of a band can differ in."""
    largest = band_edges(limit)[bands + 1] - 1
    return 2 * largest * (100 - limit) // (100 + limit)


@cache
def part_count(band: int, limit: int) -> int:
    """Parts that the sets of a band are cut into, and the smaller ones of the band below: so many
    that even the smallest has shingles in more parts than linked sets can differ in, but for one in
    thousands (four standard deviations)."""
    apart = int(most_apart(np.array([band]), limit)[0])
    smallest = int(band_edges(limit)[max(band - 1, 0)])
    count = apart + 2
    while True:
        each = smallest / count
        empty = np.exp(-each)
        filled = count * (1 - empty)
        spread = np.sqrt(max(0.0, count * empty * (1 - (1 + each) * empty)))
        if filled - 4 * spread > apart or count > 4 * smallest:
            return count
        count += 1 + count // 50


def parts_of(bands: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    used, place = np.unique(bands, return_inverse=True)
    return np.array([part_count(int(band), limit) for band in used], np.int64)[place]


def prefix_size(size: int, partner: int, limit: int) -> int:
    """Shingles of a set, in any order that all sets share, of which one is among those of every
    linked set of at least ``partner`` shingles."""
    return size + 1 - -(-limit * (size + partner) // (100 + limit))


def tiles(
    keys: np.ndarray, bounds: np.ndarray, limit: int = LIMIT
) -> tuple[np.ndarray, np.ndarray]:
    """(number of the set, tile) for every tile of every set, in its own band and as the smaller
    one in the next."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own = np.maximum(np.searchsorted(band_edges(limit), sizes, side="right") - 1, 0)
    numbers, found = [], []
    for lift in (0, 1):
        bands = own + lift
        parts = parts_of(bands, limit).astype(np.uint64)
        part = ((keys >> np.uint64(32)) * parts[owner]) >> np.uint64(32)
        starts = np.flatnonzero(
            np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])])
        ) if len(keys) else np.empty(0, np.int64)
        whose = owner[starts]
        band = bands[whose].astype(np.uint64) << np.uint64(40)
        numbers.append(whose)
        found.append(mixed(sums(mixed(keys), starts) ^ mixed(band + part[starts] + np.uint64(1))))
        # Linked sets may agree in empty parts only where neither has shingles in more parts
        # than they can differ in.
        filled = np.bincount(whose, minlength=len(sizes))
        for number in np.flatnonzero((filled <= most_apart(bands, limit)) & (sizes > 0)).tolist():
            size = int(sizes[number])
            first = keys[bounds[number] : bounds[number] + size + 1 - -(-limit * size // 100)]
            numbers.append(np.full(len(first), number))
            found.append(mixed(mixed(first) + (np.uint64(bands[number]) << np.uint64(40))))
    return np.concatenate(numbers), np.concatenate(found)


def alike(one: np.ndarray, other: np.ndarray, limit: int = LIMIT) -> bool:
    """Whether two sorted arrays reach the limit: a bit count first, then the intersection."""
    total = len(one) + len(other)
    needed = -(-limit * total // (100 + limit))
    if min(len(one), len(other)) < needed:
        return False
    bits = 1 << max(10, int(4 * len(one)).bit_length())
    here, there = bitmap(one, bits), bitmap(other, bits)
    if len(one) - int(np.bitwise_count(here & ~there).sum()) < needed:
        return False
    return len(np.intersect1d(one, other, assume_unique=True)) >= needed


def bitmap(keys: np.ndarray, bits: int) -> np.ndarray:
    """The set as a bitmap of hashed members; bits is a power of two."""
    marks = np.zeros(bits, np.uint8)
    marks[(keys & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks).view(np.uint64)


def arrow_rows(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names=names)


def name_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id, node, n_shingles."""
    for batch in pieces(batches):
        texts = utf8(batch.column(1), fold=True)
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array(set_nodes(keys, bounds)),
                    pa.array(np.diff(bounds).astype(np.int64)),
                ],
                names=["doc_id", "node", "n_shingles"],
            )


def of_part(found: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Which of the tiles are in one of several parts of all tiles."""
    return (found >> np.uint64(32)) % np.uint64(parts) == part


def tile_rows(
    batches: Iterator[pa.RecordBatch], words: int, limit: int, part: int = 0, parts: int = 1
) -> Iterator[pa.RecordBatch]:
    """(text) -> tile, node, leader of a part of the tiles: of the nodes a task sees in a tile, the
    smallest goes on alone (leader null) and the others are paired with it."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in pieces(batches):
        texts = utf8(batch.column(0), fold=True)
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            owner, found = tiles(keys, bounds, limit)
            here = of_part(found, part, parts)
            owner, found = owner[here], found[here]
            held.append((found, set_nodes(keys, bounds)[owner]))
            size += len(found)
            if size >= HELD_ROWS:
                yield lead(held)
                held, size = [], 0
    if size:
        yield lead(held)


def lead(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    tile = np.concatenate([one[0] for one in held])
    node = np.concatenate([one[1] for one in held])
    order = np.lexsort((node, tile))
    tile, node = tile[order], node[order]
    opens = np.ones(len(tile), bool)
    opens[1:] = tile[1:] != tile[:-1]
    leader = node[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
    pairs = np.unique(np.stack([leader[~opens], node[~opens]]), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    spread = mixed((pairs[0] ^ (pairs[1] << 1)).view(np.uint64)).view(np.int64)
    alone = int(opens.sum())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([tile[opens].view(np.int64), spread])),
            pa.array(np.concatenate([node[opens], pairs[1]])),
            pa.array(
                np.concatenate([np.zeros(alone, np.int64), pairs[0]]),
                mask=np.arange(alone + pairs.shape[1]) < alone,
            ),
        ],
        names=["tile", "node", "leader"],
    )


def pair_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in tile order -> a, b: each node of a tile with the tile's first."""
    open_tile, open_node = None, 0
    for batch in batches:
        leader = batch.column(2)
        told = np.asarray(leader.is_valid())
        given = leader.fill_null(0).to_numpy()
        tile = batch.column(0).to_numpy()[~told]
        every = batch.column(1).to_numpy()
        node = every[~told]
        ones, others = [given[told]], [every[told]]
        if len(tile):
            opens = np.ones(len(tile), bool)
            opens[1:] = tile[1:] != tile[:-1]
            chief = node[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
            if open_tile is not None and tile[0] == open_tile:
                chief[tile == open_tile] = open_node
            open_tile, open_node = tile[-1], chief[-1]
            ones.append(chief)
            others.append(node)
        one, other = np.concatenate(ones), np.concatenate(others)
        unlike = one != other
        pairs = np.stack([one[unlike], other[unlike]])
        pairs = np.unique(np.sort(pairs, axis=0), axis=1)
        yield arrow_rows(["a", "b"], pairs[0], pairs[1])


def judge_pairs(
    batches: Iterator[pa.RecordBatch], words: int, limit: int
) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> a, b, linked."""
    for batch in pieces(batches):
        left, right = utf8(batch.column(2), fold=True), utf8(batch.column(3), fold=True)
        verdicts = []
        # Either side may be the long one: alike sets can be those of texts of any lengths.
        longer = [max(pair, key=len) for pair in zip(left, right)]
        for first, last in batches_of(longer):
            keys, bounds = shingle_sets(left[first:last], words)
            keys_b, bounds_b = shingle_sets(right[first:last], words)
            for at in range(last - first):
                verdicts.append(
                    alike(
                        keys[bounds[at] : bounds[at + 1]],
                        keys_b[bounds_b[at] : bounds_b[at + 1]],
                        limit,
                    )
                )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(verdicts, pa.bool_())],
            names=["a", "b", "linked"],
        )


def keep_wanted(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(text) -> node, text."""
    for batch in pieces(batches):
        texts = utf8(batch.column(0), fold=True)
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_nodes(keys, bounds)), batch.column(0).slice(first, last - first)],
                names=["node", "text"],
            )


WIDTH = 2048


def tile_nodes(
    batches: Iterator[pa.RecordBatch], words: int, limit: int, part: int = 0, parts: int = 1
) -> Iterator[pa.RecordBatch]:
    """(node, text) -> tile, node of a part of the tiles."""
    for batch in pieces(batches):
        texts, nodes = utf8(batch.column(1), fold=True), batch.column(0).to_numpy()
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            owner, found = tiles(keys, bounds, limit)
            here = of_part(found, part, parts)
            owner, found = owner[here], found[here]
            yield arrow_rows(["tile", "node"], found.view(np.int64), nodes[owner + first])


def shared_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in tile order -> those whose tile another row has too."""
    held, open_tile, met = None, None, False
    for batch in batches:
        if not len(batch):
            continue
        tile = batch.column(0).to_numpy()
        same = tile[1:] == tile[:-1]
        again = held is not None and tile[0] == open_tile
        if held is not None and (met or again):
            yield held
        before = np.append(again, same)
        shared = before | np.append(same, False)
        yield batch.slice(0, len(batch) - 1).filter(pa.array(shared[:-1]))
        held, open_tile, met = batch.slice(len(batch) - 1), tile[-1], bool(before[-1])
    if held is not None and met:
        yield held


def node_bitmaps(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(node, text) -> node, size, bits."""
    for batch in pieces(batches):
        texts, nodes = utf8(batch.column(1), fold=True), batch.column(0).to_numpy()
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            maps = [
                bitmap(keys[bounds[at] : bounds[at + 1]], WIDTH).tobytes()
                for at in range(last - first)
            ]
            yield arrow_rows(["node", "size", "bits"], nodes[first:last], np.diff(bounds), maps)


def possible_pairs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (tile, low, high) -> pairs of different components in a tile's block pair
    whose bit counts do not rule a link out. A block pair is bounded, so its rows are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(at).to_numpy() for at in range(3)])
        if not keys.shape[1]:
            continue
        changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if held:
            before = [held[-1].column(at)[len(held[-1]) - 1].as_py() for at in range(3)]
            if (keys[:, 0] != before).any():
                changes = np.append(0, changes)
        if len(changes):
            last = int(changes[-1])
            yield compare_rows([*held, batch.slice(0, last)], limit)
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield compare_rows(held, limit)


def compare_rows(rows: list[pa.RecordBatch], limit: int) -> pa.RecordBatch:
    table = pa.Table.from_batches([one for one in rows if len(one)])
    tile, low, high, side, node, component, size = (
        table.column(at).to_numpy() for at in range(7)
    )
    bits = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint64).reshape(len(tile), -1)
    opens = np.ones(len(tile), bool)
    opens[1:] = (tile[1:] != tile[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    group = np.cumsum(opens)
    ones, others = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    first = np.arange(len(tile))
    for step in range(1, len(tile)):
        first = first[: np.searchsorted(first, len(tile) - step)]
        first = first[group[first] == group[first + step]]
        if not len(first):
            break
        facing = (side[first] != side[first + step]) | (side[first] == 2)
        here = first[facing & (component[first] != component[first + step])]
        there = here + step
        needed = -(-limit * (size[here] + size[there]) // (100 + limit))
        lost = np.bitwise_count(bits[here] & ~bits[there]).sum(axis=1, dtype=np.int64)
        back = np.bitwise_count(bits[there] & ~bits[here]).sum(axis=1, dtype=np.int64)
        able = np.minimum(size[here] - lost, size[there] - back) >= needed
        ones.append(node[here[able]])
        others.append(node[there[able]])
    pairs = np.stack([np.concatenate(ones), np.concatenate(others)])
    pairs = np.unique(np.sort(pairs, axis=0), axis=1)
    return arrow_rows(["a", "b"], pairs[0], pairs[1])


def mixed_tiles(members: DataFrame) -> DataFrame:
    """Tiles of (tile, node, component, half) rows that hold more than one component, with the
    members of either half. Members of half 2 meet all others of their tile; those of half 0 meet
    those of half 1 only."""
    counts = members.groupBy("tile").agg(
        F.count(F.lit(1)).alias("every"),
        F.count_if(F.col("half") != 1).alias("members"),
        F.count_if(F.col("half") != 0).alias("facing"),
        F.min("component").alias("least"),
        F.max("component").alias("greatest"),
    )
    met = counts.where("least <> greatest AND members > 0 AND facing > 0")
    return met.select("tile", "members", "facing", "every")


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each member of a mixed tile with the tile's hub: the member that meets most others in all
    its tiles, such as the original of many edited copies."""
    placed = members.join(mixed_tiles(members), "tile")
    degrees = placed.groupBy("node").agg(F.sum("members").alias("degree"))
    ranked = placed.join(degrees, "node")
    hubs = ranked.groupBy("tile").agg(
        F.max(F.struct("degree", "node", "component")).alias("hub")
    )
    return (
        ranked.join(hubs, "tile")
        .where(F.col("component") != F.col("hub.component"))
        .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
        .distinct()
    )


def part_number(parts: int, *columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(parts))


def parts_for(size: int | None, most: int) -> int:
    """Parts that a shuffle of so many bytes is cut into, to move at most ``most`` at once."""
    return max(1, -(-(size or 0) // most))


def block_pairs(
    members: DataFrame, texts: DataFrame, words: int, limit: int, most: int, work: Scratch
) -> DataFrame:
    """All pairs across components in mixed tiles that bit counts do not rule out, found block by
    block: a tile's members are dealt to blocks, and each task row meets one pair of blocks."""
    tiles_left = work.staged(
        mixed_tiles(members).select(
            "tile",
            "every",
            F.ceil(F.col("members") / BLOCK).cast("long").alias("blocks"),
            F.ceil(F.col("facing") / BLOCK).cast("long").alias("facing_blocks"),
        ),
        "mixed-tiles",
    )
    rows = tiles_left.agg(F.sum(F.col("every") * F.greatest("blocks", "facing_blocks"))).first()[0]
    placed = members.join(tiles_left.drop("every"), "tile")
    bits = texts.join(placed.select("node").distinct(), "node", "left_semi").select("node", "text")
    bits = work.staged(
        bits.mapInArrow(partial(node_bitmaps, words=words), "node long, size long, bits binary"), "bits"
    )
    parts = parts_for((rows or 0) * BITMAP_BYTES, most)
    if parts == 1:
        return pairs_of_blocks(placed.join(bits, "node"), limit)
    found = None
    for part in range(parts):
        here = placed.where(part_number(parts, "tile") == part).join(bits, "node")
        pairs = work.staged(pairs_of_blocks(here, limit), "block-pairs")
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def pairs_of_blocks(placed: DataFrame, limit: int) -> DataFrame:
    """The pairs of tiles' members with their bitmaps and the numbers of blocks of their tile."""
    here, there = F.col("blocks"), F.col("facing_blocks")
    here, there = F.when(F.col("half") == 1, there).otherwise(here), F.when(F.col("half") == 1, here).otherwise(there)
    placed = placed.select("*", F.pmod(F.xxhash64("node"), here).alias("block"), there.alias("others"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("other")
    whole, first = F.col("half") == 2, F.col("block") < F.col("other")
    spread = placed.select("*", other).select(
        "tile",
        F.when(whole, F.least("block", "other"))
        .otherwise(F.when(F.col("half") == 0, F.col("block")).otherwise(F.col("other")))
        .alias("low"),
        F.when(whole, F.greatest("block", "other"))
        .otherwise(F.when(F.col("half") == 0, F.col("other")).otherwise(F.col("block")))
        .alias("high"),
        F.when(~whole, F.col("half"))
        .otherwise(F.when(F.col("block") == F.col("other"), 2).otherwise(F.when(first, 0).otherwise(1)))
        .cast("int")
        .alias("side"),
        "node", "component", "size", "bits",
    )
    ordered = spread.repartition("tile", "low", "high").sortWithinPartitions("tile", "low", "high")
    return ordered.mapInArrow(
        partial(possible_pairs, limit=limit), "a long, b long"
    ).distinct()


@cache
def class_edges() -> np.ndarray:
    """Smallest set size of each size class: a shingle wide at first, then a hundredth."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] + max(1, edges[-1] // 100))
    return np.array(edges, np.int64)


def member_shingles(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(node, text) -> node, size, shingle."""
    for batch in pieces(batches):
        texts, nodes = utf8(batch.column(1), fold=True), batch.column(0).to_numpy()
        for first, last in batches_of(texts):
            keys, bounds = shingle_sets(texts[first:last], words)
            sizes = np.diff(bounds)
            yield arrow_rows(
                ["node", "size", "shingle"],
                np.repeat(nodes[first:last], sizes), np.repeat(sizes, sizes), keys.view(np.int64),
            )


@cache
def partner_prefixes(size: int, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The size classes that hold linked partners of a set, how many of its first shingles count for
    each, and its own class."""
    edges = class_edges()
    own = int(np.searchsorted(edges, size, side="right")) - 1
    least, most = -(-limit * size // 100), 100 * size // limit
    classes = np.arange(
        np.searchsorted(edges, least, side="right") - 1, np.searchsorted(edges, most, side="right")
    )
    # No partner of a class is smaller than its edge, nor than the least that can be linked.
    smallest = np.maximum(edges[classes], least)
    counts = np.array([prefix_size(size, int(one), limit) for one in smallest], np.int64)
    return classes, counts, own


def rare_tiles(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """(node, size, shingle, rank from 1, rarest first) -> tile, node, half: a tile for each class of
    partners that the shingle counts for, of which the smaller class is half 0 and the larger half
    1, or half 2 for partners of the own class."""
    for batch in batches:
        node, size, shingle, rank = (batch.column(at).to_numpy() for at in range(4))
        for one in np.unique(size).tolist():
            classes, counts, own = partner_prefixes(one, limit)
            rows = np.flatnonzero(size == one)
            row, place = np.nonzero(rank[rows][:, None] <= counts)
            other = classes[place]
            pair = (np.minimum(other, own) << 20) + np.maximum(other, own)
            tile = mixed(mixed(shingle[rows][row].view(np.uint64)) + pair.astype(np.uint64))
            half = np.where(other == own, 2, (other < own).astype(int)).astype(np.int32)
            yield arrow_rows(["tile", "node", "half"], tile.view(np.int64), node[rows][row], half)


def deal_crowded(
    members: DataFrame, texts: DataFrame, words: int, limit: int, work: Scratch | None = None
) -> DataFrame:
    """(tile, node, component, half) rows, with the members of crowded mixed tiles in tiles of their rarest
    shingles instead. Of the pairs that shared a crowded tile, all linked ones share a new one."""
    work = work or Scratch(members.sparkSession)
    crowded = mixed_tiles(members).where(F.col("members") > CROWDED).select("tile")
    crowded = work.staged(crowded, "crowded")
    if crowded.isEmpty():
        return members
    placed = members.join(crowded, "tile", "left_semi")
    nodes = placed.select("node", "component").distinct()
    shingles = texts.join(nodes, "node", "left_semi").select("node", "text").mapInArrow(
        partial(member_shingles, words=words), "node long, size long, shingle long"
    )
    shingles = work.staged(shingles, "member-shingles")
    # Counted before the shuffle. Stored, so that the join reads shuffles alone, of which Spark can
    # split a shingle that very many members have.
    frequency = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"))
    frequency = work.staged(frequency, "holders")
    rarest = Window.partitionBy("node").orderBy("holders", "shingle")
    # No partner is smaller than its limit allows, so no more shingles than these count.
    most = F.col("size") + 1 - F.ceil(F.col("size") * limit / 100)
    ranked = (
        shingles.join(frequency, "shingle")
        .withColumn("rank", F.row_number().over(rarest))
        .where(F.col("rank") <= most)
        .select("node", "size", "shingle", "rank")
    )
    dealt = ranked.mapInArrow(partial(rare_tiles, limit=limit), "tile long, node long, half int")
    fresh = dealt.join(nodes, "node").select("tile", "node", "component", "half")
    left = members.join(crowded, "tile", "left_anti").unionByName(fresh)
    return work.staged(left.select("tile", "node", "component", "half"), "dealt")


def judged(
    pairs: DataFrame, texts: DataFrame, words: int, limit: int, most: int, work: Scratch
) -> DataFrame:
    """a, b, linked for each pair. ``texts`` has one row per node. A text goes to each pair that it is
    ``b`` of, so many pairs are compared part by part."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    judge = partial(judge_pairs, words=words, limit=limit)
    asked = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("asked"))
    sizes = right.select("b", F.octet_length("text_b").alias("size"))
    moved = asked.join(sizes, "b").agg(F.sum(F.col("asked") * F.col("size"))).first()[0]
    parts = parts_for(moved, most)
    found = None
    for part in range(parts):
        here = pairs if parts == 1 else pairs.where(part_number(parts, "a", "b") == part)
        both = here.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        verdicts = work.staged(both.mapInArrow(judge, "a long, b long, linked boolean"), "judged")
        found = verdicts if found is None else found.unionByName(verdicts)
    return found


def components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    limit: int = LIMIT,
) -> DataFrame:
    """A row per document: doc_id, node (names its set), n_shingles, component_id, first_of_set.

    component_id is the smallest doc_id reachable by links: shingles of ``words`` words, of which
    ``limit`` percent of the union are in both.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    named = staged(
        spark,
        rows.mapInArrow(partial(name_sets, words=words), "doc_id long, node long, n_shingles long"),
        "sets",
    )
    work, passing = Scratch(spark), Scratch(spark)
    found = None
    for part in range(TILE_PARTS):
        shared = rows.select("text").mapInArrow(
            partial(tile_rows, words=words, limit=limit, part=part, parts=TILE_PARTS),
            "tile long, node long, leader long",
        )
        ordered = shared.repartition("tile").sortWithinPartitions("tile", "node")
        pairs = passing.staged(ordered.mapInArrow(pair_leaders, "a long, b long").distinct(), "tile-pairs")
        found = pairs if found is None else found.unionByName(pairs)
    pairs = work.staged(found.distinct(), "pairs")
    shingles = named.agg(F.sum("n_shingles")).first()[0] or 0
    most = max(LEAST_MOVED, MOVED_PER_SHINGLE * shingles)

    smallest = named.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles")
    )
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = work.staged(smallest.join(ends, "node"), "ends")
    holders = wanted.select(F.col("first_id").alias("doc_id"))
    held = rows.join(holders, rows["doc_id"].eqNullSafe(holders["doc_id"]), "left_semi")
    held = passing.staged(held.select("text"), "held-texts")
    texts = work.staged(
        held.mapInArrow(partial(keep_wanted, words=words), "node long, text string")
        .join(wanted.select("node"), "node", "left_semi")
        .dropDuplicates(["node"]),
        "set-texts",
    )
    passing.drop()
    verdicts = judged(pairs, texts, words, limit, most, work)
    links = verdicts.where("linked").select("a", "b")
    labels = connected_components(spark, links)
    if not verdicts.where("not linked").isEmpty():
        labels = settle_misses(wanted, texts, verdicts, labels, words, limit, most, work)

    named_sets = smallest.join(labels, "node", "left").select(
        "node", "first_id", F.coalesce("component", "node").alias("component")
    )
    lowest = named_sets.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_set = named_sets.join(lowest, "component").select(
        F.col("node").alias("set_node"), "component_id"
    )
    # All that the result reads besides the named sets.
    of_set = staged(spark, of_set, "set-components")
    work.drop()
    return named.join(of_set, F.col("node") == F.col("set_node"), "left").select(
        "doc_id",
        "node",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def settle_misses(
    ends: DataFrame,
    texts: DataFrame,
    verdicts: DataFrame,
    labels: DataFrame,
    words: int,
    limit: int,
    most: int,
    work: Scratch,
) -> DataFrame:
    """The components once every pair that shares a tile has been compared or is connected.

    First each tile's hub is tried, which connects the edited copies of one original; what is
    still apart is then compared in full.
    """
    # Nodes without a link are components of their own.
    every = ends.join(labels, "node", "left").select(
        "node", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    touched = (
        verdicts.where("not linked")
        .select(F.explode(F.array("a", "b")).alias("node"))
        .distinct()
        .join(every, "node")
        .select("component")
        .distinct()
    )
    open_nodes = every.join(touched, "component", "left_semi").select("node", "n_shingles")
    open_nodes = work.staged(open_nodes, "open")
    opened = texts.join(open_nodes.select("node"), "node", "left_semi").select("node", "text")
    # A set has about as many tiles as shingles.
    shingles = open_nodes.agg(F.sum("n_shingles")).first()[0] or 0
    parts = parts_for(shingles * TILE_BYTES, most)
    members = None
    for part in range(parts):
        placed = opened.mapInArrow(
            partial(tile_nodes, words=words, limit=limit, part=part, parts=parts), "tile long, node long"
        )
        # Most tiles hold one set only; they would be most of what is written and shuffled below.
        ordered = placed.repartition("tile").sortWithinPartitions("tile")
        shared = work.staged(ordered.mapInArrow(shared_tiles, "tile long, node long"), "members")
        members = shared if members is None else members.unionByName(shared)

    def remaining_pairs(rows: DataFrame) -> DataFrame:
        dealt = deal_crowded(rows, texts, words, limit, work)
        return block_pairs(dealt, texts, words, limit, most, work)

    for candidates in (hub_pairs, remaining_pairs):
        placed = members.join(labels, "node", "left").select(
            "tile", "node", F.coalesce("component", "node").alias("component"), F.lit(2).alias("half")
        )
        pairs = candidates(placed).join(verdicts.select("a", "b"), ["a", "b"], "left_anti")
        pairs = work.staged(pairs, "more-pairs")
        if not pairs.isEmpty():
            more = judged(pairs, texts, words, limit, most, work)
            verdicts = verdicts.unionByName(more)
            labels = connected_components(texts.sparkSession, verdicts.where("linked").select("a", "b"))
    return labels


def keep_one_per_component(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    limit: int = LIMIT,
) -> DataFrame:
    """The document with the smallest doc_id of each component; all columns of the input.

    Documents without words have no links and stay; repeated rows of one doc_id stay together.
    """
    found = components(docs, doc_id, text, words, limit)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("__gone")
    )
    return docs.join(gone.distinct(), F.col(doc_id) == F.col("__gone"), "left_anti")
