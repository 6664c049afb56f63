"""Spelling variants: words one edit apart, each led to the far commoner form it stands for.

Blocked Gram matrices. Two words one edit apart have letter counts at a squared distance of at
most two, and lengths at most one apart. In a block, the matrix product of the words' letter counts
gives all squared distances at once; pairs at most two apart are kept and their edit verified
letter by letter.

Blocks are exact: class ``m`` holds the words of ``m`` and of ``m + 1`` letters, and the places
``0..m`` of an edit are cut into ranges. All words of a class that agree outside a range are a
block of it, so a pair is in the block of the range that holds its first difference, and is counted
there only. Ranges start as the two halves of a word; the range of a crowded block is halved again,
until the block is small or the range is one letter. Then the letters in use bound the block: at most
one word for each in that place, and one for each pair of them among the longer words. So the work
grows with the words, however many begin or end alike.

Each block reports, for a word, how many near words it found and the commonest; these partial rows,
not the pairs, are what is shuffled.

Defined results: a null text has no words; a null doc_id is an empty one; repeated rows count each
time; equal counts are settled by the smaller word in code-point order; an empty table gives an
empty table; further columns are ignored. A run of letters of any length is a word.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.native import staged
from vitaelake.llm.wordarrays import LOWER

MIN_LENGTH = 7
MIN_COUNT = 2
# A form is at least so many times as frequent as the word that it replaces.
RATIO = 10
# Words of a block beyond which its range is halved.
CROWDED = 512
# Distinct words a task counts before it passes them on; rows whose blocks are compared at once.
HELD_WORDS = 200_000
HELD_ROWS = 8192
# Letters are counted by their lowest five bits; those that share them only seem nearer.
LETTERS = 32
PLACED = ["key", "word", "n", "m", "low", "high"]


def count_words(
    batches: Iterator[pa.RecordBatch], min_length: int, thinned: int
) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> word, n, with equal words of a task added up."""
    letters = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}")
    counts: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast("binary")
        for doc_id, text in zip(ids, texts):
            if not text.is_valid:
                continue
            own = Counter(letters.findall(text.as_py().translate(LOWER).decode()))
            before = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
            before = zlib.crc32(b":", before)
            for word, n in own.items():
                digest = zlib.crc32(word.encode(), before)
                if thinned and digest % thinned == 0:
                    gone = digest % len(word)
                    word = word[:gone] + word[gone + 1 :]
                    if len(word) < min_length:
                        continue
                counts[word] += n
            if len(counts) > HELD_WORDS:
                yield counted()
                counts.clear()
    if counts:
        yield counted()


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    thinned: int = 0,
) -> DataFrame:
    """word, n: the runs of Latin letters of whole texts, A to Z lower-cased, that have enough
    letters and occurrences.

    With ``thinned``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses one letter first, at
    the place of that crc32 modulo the run's length: known misspellings to look for.
    """
    count = partial(count_words, min_length=min_length, thinned=thinned)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def block_key() -> Column:
    """What the words of a block share: class, range, and the letters before and after the range."""
    after = F.col("m") - F.col("high")
    return F.xxhash64("m", "low", "high", F.expr("left(word, low)"), F.right(F.col("word"), after))


def in_ranges(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """Each row once in either half of the range, with the key of its block."""
    middle = F.floor((low + high) / 2).cast("int")
    halves = F.array(
        F.struct(low.alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), high.alias("high")),
    )
    cut = rows.select("word", "n", "m", F.explode(halves).alias("range"))
    cut = cut.select("word", "n", "m", "range.low", "range.high").where("low < high")
    return cut.select(block_key().alias("key"), *PLACED[1:])


def blocks(words: DataFrame) -> DataFrame:
    """Every word in its blocks, none of which is crowded while its range can be halved."""
    spark = words.sparkSession
    size = F.length("word")
    classes = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where("m > 0")
    rows = in_ranges(classes, F.lit(0), F.col("m"))
    settled = None
    while True:
        # Counted before the shuffle, so a block that holds much of the table is no burden.
        counts = rows.where("high - low > 1").groupBy("key").agg(F.count(F.lit(1)).alias("members"))
        crowded = staged(spark, counts.where(F.col("members") > CROWDED).select("key"), "crowded")
        if crowded.isEmpty():
            return rows if settled is None else settled.unionByName(rows)
        # No hint: Spark broadcasts the keys if they are few, and else splits skewed partitions.
        small = rows.join(crowded, "key", "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        large = rows.join(crowded, "key").select(PLACED)
        rows = staged(spark, in_ranges(large, F.col("low"), F.col("high")), "halved")


def letter_counts(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of letter counts for each word; ``codes`` are the words' code points in a row."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    places = owner * LETTERS + (codes & (LETTERS - 1)).astype(np.int64)
    counts = np.bincount(places, minlength=len(sizes) * LETTERS)
    return counts.reshape(len(sizes), LETTERS).astype(np.float64)


def common_run(codes: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many letters agree from the places ``one`` and ``other`` on, up to ``size``."""
    run = np.zeros(len(one), np.int64)
    going = np.flatnonzero(size > 0)
    while len(going):
        here = run[going]
        same = codes[one[going] + here] == codes[other[going] + here]
        going = going[same]
        run[going] += 1
        going = going[run[going] < size[going]]
    return run


def gram_pairs(counts: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group with a squared distance of at most two.

    ``groups``: where each group starts, and the end. Groups of up to 64 rows are padded to powers
    of two and multiplied together; larger ones alone, some rows at a time.
    """
    sizes = np.diff(groups)
    norms = (counts * counts).sum(axis=1)
    # A padding row is far from all others.
    counts = np.vstack([counts, np.zeros(counts.shape[1])])
    norms = np.append(norms, np.inf)
    ones, others = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for width in (2, 4, 8, 16, 32, 64):
        chosen = np.flatnonzero((sizes > width // 2) & (sizes <= width) & (sizes > 1))
        at_once = max(1, (1 << 20) // (width * width))
        for first in range(0, len(chosen), at_once):
            some = chosen[first : first + at_once]
            rows = groups[some][:, None] + np.arange(width)
            rows = np.where(rows < groups[some + 1][:, None], rows, len(counts) - 1)
            inner = counts[rows]
            apart = norms[rows][:, :, None] + norms[rows][:, None, :] - 2 * (inner @ inner.transpose(0, 2, 1))
            group, one, other = np.nonzero(apart <= 2)
            before = one < other
            ones.append(rows[group[before], one[before]])
            others.append(rows[group[before], other[before]])
    for group in np.flatnonzero(sizes > 64).tolist():
        start, end = int(groups[group]), int(groups[group + 1])
        inner = counts[start:end]
        at_once = max(1, (1 << 21) // (end - start))
        for first in range(start, end, at_once):
            last = min(first + at_once, end)
            apart = norms[first:last, None] + norms[start:end] - 2 * (counts[first:last] @ inner.T)
            one, other = np.nonzero(apart <= 2)
            before = one + first < other + start
            ones.append(one[before] + first)
            others.append(other[before] + start)
    return np.concatenate(ones), np.concatenate(others)


def near_in_blocks(
    words: list[str], n: np.ndarray, groups: np.ndarray, m: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of a block exactly one edit apart, whose first difference is in its range."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(sizes) - sizes
    one, other = gram_pairs(letter_counts(codes, sizes), groups)
    # The shorter first. Two of the longer ones are compared in the next class.
    swap = sizes[one] > sizes[other]
    one, other = np.where(swap, other, one), np.where(swap, one, other)
    here = sizes[one] == m[one]
    one, other = one[here], other[here]
    first = common_run(codes, starts[one], starts[other], sizes[one])
    longer = sizes[other] - sizes[one]
    # After the first difference, a letter of the longer one, or of both, is passed over.
    skipped = 1 - longer
    rest = sizes[one] - first - skipped
    able = rest >= 0
    one, other, first, longer, skipped, rest = (
        values[able] for values in (one, other, first, longer, skipped, rest)
    )
    again = common_run(codes, starts[one] + first + skipped, starts[other] + first + 1, rest)
    inside = (first >= low[one]) & ((first < high[one]) | (first == m[one]) & (high[one] == m[one]))
    near = (again == rest) & inside
    return one[near], other[near]


def near_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their blocks' keys -> word, n_near, best_n, best: of the words near it in
    those blocks, how many there are, and the commonest."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < HELD_ROWS:
            continue
        # All but the last block are whole.
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(0).to_numpy()
        whole = int(np.searchsorted(keys, keys[-1]))
        if whole:
            yield from compared(table.slice(0, whole))
            held = table.slice(whole).to_batches()
            size -= whole
    if held:
        yield from compared(pa.Table.from_batches(held))


def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
    key = table.column(0).to_numpy()
    if not len(key):
        return
    same = key[1:] == key[:-1]
    kept = np.append(same, False) | np.append(False, same)
    if not kept.any():
        return
    table, key = table.filter(pa.array(kept)), key[kept]
    words = table.column(1).to_pylist()
    n, m, low, high = (table.column(at).to_numpy().astype(np.int64) for at in range(2, 6))
    groups = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    one, other = near_in_blocks(words, n, groups, m, low, high)
    if not len(one):
        return
    # Both ways; the same word may be in several blocks, each of which reports for itself.
    word, near = np.concatenate([one, other]), np.concatenate([other, one])
    used, rank = np.unique(near), np.zeros(len(words), np.int64)
    rank[sorted(used.tolist(), key=words.__getitem__)] = np.arange(len(used))
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    opens = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([words[at] for at in word[opens].tolist()], pa.string()),
            pa.array(np.diff(np.append(opens, len(word)))),
            pa.array(n[near[opens]]),
            pa.array([words[at] for at in near[opens].tolist()], pa.string()),
        ],
        names=["word", "n_near", "best_n", "best"],
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """word, root for every word with a form: the end of its chain of forms.

    A form is much commoner than its word, so chains are short and have no circles. Each round
    doubles the steps taken.
    """
    spark = forms.sparkSession
    paths = forms.select("word", F.col("form").alias("root"))
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(
            spark,
            paths.join(on, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "forms",
        )
        paths = after.select("word", "root")
        if after.where("moved").isEmpty():
            return paths


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of ``words`` (distinct word, n).

    form: the commonest word one edit away, if it is ``ratio`` times as frequent; root: the last
    of the forms that follow from it.
    """
    spark = words.sparkSession
    words = staged(spark, words.select("word", "n"), "words")
    ordered = blocks(words).repartition("key").sortWithinPartitions("key")
    found = ordered.mapInArrow(near_words, "word string, n_near long, best_n long, best string")
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("best"),
    )
    commoner = -F.col("best.less") >= ratio * F.col("n")
    formed = staged(
        spark,
        words.join(near, "word", "left").select(
            "word",
            F.when(commoner, F.col("best.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(commoner, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    roots = last_forms(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
