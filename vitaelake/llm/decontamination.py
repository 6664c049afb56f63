"""Benchmark decontamination by spaced-seed hashing.

Built-in column functions only. A mask names the word positions of a window that are hashed; the
others are free, so a seed survives words replaced there. Every window of a training document is
hashed under each mask and joined to the hashes of the test items inside one generated-code
stage: a window that hits nothing is never written, sorted or shuffled. What is broadcast for that is
a seed, its item's number and size, and its place there, so it grows with the words of the benchmark;
a large benchmark goes in blocks of bounded bytes, and one of many blocks is joined by a shuffle of the
seeds instead. A hit fixes an alignment (test item, document, shift); the items' words are joined to
the few alignments. Each alignment is then verified once, word by word over the words that
both have: it counts if any stretch of the needed length has enough equal words. Given is the
stretch that has most equal words beyond those it needs.

Words are runs of letters and digits, lower-cased, compared by 64-bit hash.

Items shorter than the least stretch count as a whole, so they have masks of their own length:
cut into parts, each mask leaves out as many parts as words may be replaced.

Defined results: null or empty texts have no windows; a null doc_id or item_id is carried like any other; repeated rows give one result row; an empty
table on either side gives no rows; further columns are ignored.
"""

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.native import let, row_digest, staged

# Positions hashed by each mask. Every stretch of 13 words or more with 80% of them
# equal, wherever the replaced ones stand, holds one of these (a stretch of 26 or more has half
# of its words in a good one, so 13 to 25 are all lengths to count).
MASKS = (
    (0, 1, 2, 4, 6, 8),
    (0, 1, 3, 5, 7, 8),
    (0, 2, 3, 4, 5, 8),
    (0, 1, 2, 3, 4),
    (0, 1, 2, 3, 5, 6),
)
# Shares are taken to four decimals.
SCALE = 10_000


@dataclass(frozen=True)
class Settings:
    """min_words: words the stretch must span (or the whole item, if shorter). min_equal: share
    of its words that must be equal. block_bytes: test windows that are broadcast at once; a larger
    benchmark reads the documents once for each block, and beyond most_blocks the seeds of the
    documents are shuffled. All ways give the same rows."""

    min_words: int = 13
    min_equal: float = 0.8
    block_bytes: int = 64 << 20
    most_blocks: int = 8


# What a row of seeds takes in a hash table.
SEED_BYTES = 64


def word_hashes(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    return F.transform(F.array_remove(parts, ""), lambda word: F.xxhash64(word))


def whole_masks(size: int, min_equal: float) -> list[tuple[int, ...]]:
    """Masks for an item that must be found whole: one of them misses the replaced words, wherever
    they stand."""
    replaced = size - -(-size * round(min_equal * SCALE) // SCALE)
    parts = min(replaced + 2, size) if replaced else 1
    edges = [size * part // parts for part in range(parts + 1)]
    masks = []
    for gone in combinations(range(parts), min(replaced, parts - 1)):
        left = [part for part in range(parts) if part not in gone]
        masks.append(tuple(at for part in left for at in range(edges[part], edges[part + 1])))
    return masks


def masks_for(items: DataFrame, settings: Settings) -> dict[int, list[tuple[int, ...]]]:
    """The masks by size of the items they are for; 0: items that a stretch may be part of."""
    sizes = items.select(F.size("item_words").alias("size")).distinct()
    short = sizes.where((F.col("size") > 0) & (F.col("size") < settings.min_words))
    found = sorted(row["size"] for row in short.collect())
    return {0: list(MASKS), **{size: whole_masks(size, settings.min_equal) for size in found}}


def windows(
    rows: DataFrame,
    hashes: str,
    keep: list[str],
    masks: dict[int, list[tuple[int, ...]]],
    min_words: int | None = None,
) -> DataFrame:
    """A row per window and mask: keep, at (0-based start), seed. With min_words the rows are
    items, each of which has the masks of its size only."""
    last = F.size(hashes) - 1 - min(mask[-1] for group in masks.values() for mask in group)
    # No filter on the size: it would be pushed below the hashing and compute it twice.
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    placed = rows.select(*keep, hashes, F.explode(starts).alias("at"))
    # A window that a mask overhangs has no seed of it.
    seeds = []
    for size, group in masks.items():
        if min_words is None:
            meant = F.lit(True)
        elif size:
            meant = (F.size(hashes) == size) & (F.col("at") == 0)
        else:
            meant = F.size(hashes) >= min_words
        for number, mask in enumerate(group):
            places = [F.get(F.col(hashes), F.col("at") + step) for step in mask]
            fits = F.col("at") + mask[-1] < F.size(hashes)
            seeds.append(F.when(meant & fits, F.xxhash64(F.lit(size), F.lit(number), *places)))
    return placed.select(*keep, hashes, "at", F.explode(F.array(*seeds)).alias("seed"))


def test_items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct items: item (64 bits that tell them apart), item_id, item_words."""
    items = benchmark.select(
        F.col(item_id).alias("item_id"), word_hashes(F.col(text)).alias("item_words")
    )
    return items.select(row_digest(F.col("item_id"), F.col("item_words")).alias("item"), "*").dropDuplicates(["item"])


def test_seeds(
    items: DataFrame, masks: dict[int, list[tuple[int, ...]]], settings: Settings
) -> DataFrame:
    placed = windows(items, "item_words", ["item"], masks, settings.min_words)
    return placed.where("seed IS NOT NULL").select(
        "seed", "item", F.col("at").alias("item_at"), F.size("item_words").alias("item_size")
    ).distinct()


def best_stretch(equal: Column, needed: Column, min_equal: float) -> Column:
    """Start, end (exclusive) and equal words of the best stretch of at least ``needed`` words in
    an alignment; end is 0 where none has ``min_equal`` of its words equal.

    An equal word scores what a replaced one costs at that share, so a stretch is good from 0 on.
    The best one that ends at a word starts at the least sum ``needed`` words before or earlier.
    """
    share = round(min_equal * SCALE)
    zero = F.lit(0)
    start = F.struct(
        *[zero.alias(name) for name in ("ahead", "behind", "low_at", "low_hits")],
        F.lit(1 << 60).cast("long").alias("low"),
        F.lit(-1).cast("long").alias("best"),
        *[zero.alias(name) for name in ("first", "end", "found")],
    )

    def total(hits: Column, count: Column) -> Column:
        return hits.cast("long") * SCALE - count.cast("long") * share

    def step(state: Column, at: Column) -> Column:
        back = at + 1 - needed
        ahead = state["ahead"] + F.get(equal, at).cast("int")
        behind = state["behind"] + F.when(back > 0, F.get(equal, back - 1).cast("int")).otherwise(0)
        lower = (back >= 0) & (total(behind, back) < state["low"])
        low = F.when(lower, total(behind, back)).otherwise(state["low"])
        low_at = F.when(lower, back).otherwise(state["low_at"])
        low_hits = F.when(lower, behind).otherwise(state["low_hits"])
        score = total(ahead, at + 1) - low
        better = (back >= 0) & (score > state["best"])
        return F.struct(
            ahead.alias("ahead"),
            behind.alias("behind"),
            low_at.alias("low_at"),
            low_hits.alias("low_hits"),
            low.alias("low"),
            F.when(better, score).otherwise(state["best"]).alias("best"),
            F.when(better, low_at).otherwise(state["first"]).alias("first"),
            F.when(better, at + 1).otherwise(state["end"]).alias("end"),
            F.when(better, ahead - low_hits).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(F.sequence(zero, F.size(equal) - 1), start, step)


ALIGNED = ["id", "digest", "item", "shift"]


def aligned(hit: DataFrame) -> DataFrame:
    """Distinct alignments of hits, with the document's words that face the item's."""
    shift = F.col("at") - F.col("item_at")
    first = F.greatest(shift, F.lit(0))
    facing = F.slice(F.col("words"), first + 1, F.col("item_size") + F.least(shift, F.lit(0)))
    found = hit.select("id", "digest", "item", shift.alias("shift"), facing.alias("doc_words"))
    return found.dropDuplicates(ALIGNED)


def alignments_by_blocks(
    docs: DataFrame, seeds: DataFrame, masks: dict[int, list[tuple[int, ...]]], blocks: int
) -> DataFrame:
    """The documents read once for every block of seeds, which is broadcast."""
    found = None
    for block in range(blocks):
        # Dealt by the whole row, so a seed that many items share spreads over the blocks.
        dealt = F.pmod(F.xxhash64("seed", "item", "item_at"), F.lit(blocks))
        part = seeds.where(dealt == block) if blocks > 1 else seeds
        hit = windows(docs, "words", ["id", "digest"], masks).join(F.broadcast(part), "seed")
        found = aligned(hit) if found is None else found.unionByName(aligned(hit))
    return found.dropDuplicates(ALIGNED) if blocks > 1 else found


def alignments_by_shuffle(
    docs: DataFrame, seeds: DataFrame, masks: dict[int, list[tuple[int, ...]]]
) -> DataFrame:
    """The documents read once for their seeds, which are shuffled alone, and once for the words of
    those that are hit."""
    placed = windows(docs, "words", ["id", "digest"], masks).where("seed IS NOT NULL")
    hit = placed.select("id", "digest", "at", "seed").join(seeds.hint("shuffle_merge"), "seed")
    hit = hit.select("id", "digest", "at", "item", "item_at", "item_size")
    # Equal texts have equal words, so a digest is enough to fetch them.
    words = docs.select("digest", "words").join(hit.select("digest").distinct(), "digest", "left_semi")
    return aligned(hit.join(words.dropDuplicates(["digest"]), "digest"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """A row per document row and test item it contains: doc_id, digest of the text, item_id,
    doc_start and doc_end (words), n_equal, n_span, item_words."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).alias("id"),
        row_digest(F.col(text)).alias("digest"),
        word_hashes(F.col(text)).alias("words"),
    )
    items = staged(spark, test_items(benchmark, item_id, item_text), "decontamination-items")
    masks = masks_for(items, settings)
    seeds = staged(spark, test_seeds(items, masks, settings), "decontamination-seeds")
    blocks = -(-seeds.count() * SEED_BYTES // settings.block_bytes) or 1
    if blocks > settings.most_blocks:
        found = alignments_by_shuffle(rows, seeds, masks)
    else:
        found = alignments_by_blocks(rows, seeds, masks, blocks)
    found = found.join(items, "item")

    lead = F.greatest(-F.col("shift"), F.lit(0))

    # Item words before the document's first or after its last are no replaced ones.
    equal = F.transform(
        "doc_words", lambda word, at: F.coalesce(word == F.get("item_words", at + lead), F.lit(False))
    )
    needed = F.least(F.lit(settings.min_words), F.size("item_words"))
    best = let(equal, lambda marks: best_stretch(marks, needed, settings.min_equal))
    # Judged inside a generator: a filter above would compute every stretch once more.
    judged = F.filter(F.array(best), lambda stretch: stretch["end"] > 0)
    good = found.select(
        "id", "digest", "item_id", "shift",
        F.size("item_words").alias("item_size"),
        lead.alias("lead"),
        F.explode(judged).alias("best"),
    )
    span = F.col("best.end") - F.col("best.first")
    return (
        good.groupBy(F.col("id").alias("doc_id"), "digest", "item_id")
        .agg(
            F.max(
                F.struct(
                    F.col("best.found").alias("n_equal"),
                    (-F.col("shift")).alias("back"),
                    span.alias("n_span"),
                    (F.col("best.first") + F.col("lead")).alias("first"),
                    F.col("item_size").alias("item_words"),
                )
            ).alias("top")
        )
        .select(
            "doc_id",
            "digest",
            "item_id",
            (F.col("top.first") - F.col("top.back")).cast("long").alias("doc_start"),
            (F.col("top.first") - F.col("top.back") + F.col("top.n_span")).cast("long").alias("doc_end"),
            F.col("top.n_equal").cast("long").alias("n_equal"),
            F.col("top.n_span").cast("long").alias("n_span"),
            F.col("top.item_words").cast("long").alias("item_words"),
        )
    )


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
    **names: str,
) -> DataFrame:
    """The documents that contain no test item; all columns of the input."""
    found = overlaps(docs, benchmark, doc_id, text, settings=settings, **names)
    bad = found.select(
        F.col("doc_id").alias("__bad_id"), F.col("digest").alias("__bad_digest")
    ).distinct()
    return docs.join(
        bad,
        F.col(doc_id).eqNullSafe(F.col("__bad_id"))
        & (row_digest(F.col(text)) == F.col("__bad_digest")),
        "left_anti",
    )
