"""Removal of repeated passages, over a logarithmic family of suffix arrays.

A byte goes when a string of ``LENGTH`` bytes around it also starts earlier in the corpus.

The arrays are sparse: they hold the suffixes at anchors. Of the 32-byte strings inside every
100-byte window, the one with the least hash marks an anchor, so equal windows have it at the same
place, and one byte in about 35 is one. An entry has two hashes: of the 32 bytes at the anchor
(``narrow``; entries are kept in its order), and of everything that the windows around it can
reach, 68 bytes before to 100 after (``wide``).

A new batch is sorted and merge-scanned against the levels so far:

* Entries with equal ``wide`` are equal in every window around them. Only the first is an entry of
  the family; all that the windows of the others reach is removed. This is done within each task
  first, so a passage that a third of all documents share reaches the shuffle as one entry a task.
* Different entries with equal ``narrow`` agree in part. Their surroundings are fetched, and the 69
  windows of each are compared by 64-bit hash, so a match ends at the exact byte. Where very many
  entries share an anchor, its windows are halved into those that reach further back and further
  ahead: equal windows of a half agree in a longer string too, by which the entries are dealt anew;
  those that agree in all of the half are settled at once. So no group of one anchor is compared
  whole, and each round passes on only entries that agree in ever more bytes.

The batch's new entries are a level of their own; levels of about equal size are merged, so there
are logarithmically many.

Defined results: a null text is empty; a null doc_id sorts before all others; different texts of
one doc_id are documents in order of their hash, equal rows of one doc_id are one document and get
the same result each; an empty table gives an empty table; further columns are ignored by
``repeated_spans`` and carried by ``remove_repeats``.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitaelake.llm.native import Scratch, staged
from vitaelake.llm.wordarrays import batches_of, mixed, pieces, power_table, utf8
from vitaelake.session import scratch_location, shuffles_dropped

LENGTH = 100
GRAM = 32
REACH = LENGTH - GRAM  # bytes before an anchor that its windows reach
WINDOWS = REACH + 1
HELD_ANCHORS = 200_000
# Different surroundings of one anchor in one task, above which they are spread by surroundings.
SPREAD = 256
# Entries that share a string, above which they are dealt anew by longer ones.
TOGETHER = 1024
# Entries whose windows are compared at once.
HELD_ENTRIES = 4096

_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(424242).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)
_NO_ID = -(1 << 63)

FOUND = "kind int, route long, narrow long, wide long, doc long, packed long"
# Kinds of rows: an entry (packed: its place), or a removed span (packed: its start, wide: its end).
# NEW: an entry that is compared in any case, or one to be kept. OLD and KNOWN: the same as ENTRY
# and NEW, of a level.
ENTRY, SPAN, NEW, OLD, KNOWN = range(5)


def tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    return power_table(_BASE, size + 1), power_table(_UNBASE, size + 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, in a logarithmic number of passes."""
    done, least = 1, values
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return least


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """number of the text, place, reach before, reach after, narrow, wide, of every anchor."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    if len(data) < LENGTH or not (sizes >= LENGTH).any():
        return tuple(np.empty(0, kind) for kind in (int, int, int, int, np.uint64, np.uint64))
    up, down = tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_least(ranked, WINDOWS)
    starts = np.arange(len(least))
    inside = starts + LENGTH <= np.repeat(ends, sizes)[: len(least)]
    place = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.ones(len(place), bool)
    fresh[1:] = place[1:] != place[:-1]
    place = place[fresh]
    number = np.searchsorted(ends, place, side="right")
    begin = ends[number] - sizes[number]
    low = np.maximum(place - REACH, begin)
    high = np.minimum(place + LENGTH, ends[number])
    around = (sums[high] - sums[low]) * down[low]
    shape = ((place - low) * 256 + (high - place)).astype(np.uint64)
    wide = mixed(mixed(around) + shape)
    return number, place - begin, place - low, high - place, grams[place], wide


def pack_place(twin: np.ndarray, place: np.ndarray, before, after) -> np.ndarray:
    return (twin << 48) | (place << 16) | (before << 8) | after


def place_of(packed: np.ndarray) -> np.ndarray:
    return (packed >> 16) & 0xFFFFFFFF


def found_rows(kind, route, narrow, wide, doc, packed) -> pa.RecordBatch:
    arrays = [np.asarray(kind, np.int32)]
    arrays += [np.asarray(one).view(np.int64) for one in (route, narrow, wide, doc, packed)]
    names = [part.split()[0] for part in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(one) for one in arrays], names=names)


def joined_spans(doc, twin, low, high) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of a document as one."""
    order = np.lexsort((low, twin, doc))
    doc, twin, low, high = doc[order], twin[order], low[order], high[order]
    if not len(doc):
        return doc, twin, low, high
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1])
    # The furthest end so far within a document: each document's ends are lifted above the last's.
    lift = np.cumsum(new) * (int(high.max()) + 1)
    furthest = np.maximum.accumulate(high + lift) - lift
    new[1:] |= low[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], twin[first], low[first], furthest[last]


def span_rows(doc, twin, low, high) -> pa.RecordBatch:
    doc, twin, low, high = joined_spans(doc, twin, low, high)
    route = mixed(doc.view(np.uint64))
    zero = np.zeros(len(doc), np.int64)
    return found_rows(np.full(len(doc), SPAN), route, zero, high, doc, pack_place(twin, low, 0, 0))


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, text) -> entries that are first of their surroundings in this task, and spans
    that the others remove."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in pieces(batches):
        doc, twin = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
        texts = utf8(batch.column(2))
        for first, last in batches_of(texts):
            number, place, before, after, narrow, wide = anchors(texts[first:last])
            if len(number):
                own = number + first
                held.append((narrow, wide, doc[own], pack_place(twin[own], place, before, after)))
                size += len(number)
            if size >= HELD_ANCHORS:
                yield from first_in_task(held)
                held, size = [], 0
    if size:
        yield from first_in_task(held)


def first_in_task(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    narrow, wide, doc, packed = (np.concatenate(column) for column in zip(*held))
    order = np.lexsort((packed, doc, wide, narrow))
    narrow, wide, doc, packed = narrow[order], wide[order], doc[order], packed[order]
    first = np.ones(len(wide), bool)
    first[1:] = (wide[1:] != wide[:-1]) | (narrow[1:] != narrow[:-1])
    yield removed(first, doc, packed)
    narrow, wide, doc, packed = narrow[first], wide[first], doc[first], packed[first]
    opens = np.ones(len(narrow), bool)
    opens[1:] = narrow[1:] != narrow[:-1]
    group = np.cumsum(opens) - 1
    crowded = np.bincount(group)[group] > SPREAD
    # A crowded anchor's entries are spread by their surroundings; two stay to tell the others.
    told = np.arange(len(narrow)) - np.flatnonzero(opens)[group] < 2
    route = np.where(crowded & ~told, mixed(wide), narrow)
    yield found_rows(np.where(crowded & ~told, NEW, ENTRY), route, narrow, wide, doc, packed)


def removed(first: np.ndarray, doc: np.ndarray, packed: np.ndarray) -> pa.RecordBatch:
    """The spans of rows that are not first, nor the same occurrence as the first."""
    owner = np.flatnonzero(first)[np.cumsum(first) - 1] if len(first) else np.empty(0, int)
    later = ~first & ((doc != doc[owner]) | (packed != packed[owner]))
    doc, packed = doc[later], packed[later]
    place = place_of(packed)
    return span_rows(doc, packed >> 48, place - ((packed >> 8) & 255), place + (packed & 255))


def scan_entries(keep_index: bool):
    """Rows in order of (route, narrow, wide, doc, packed) -> spans removed, entries that share
    ``narrow`` with a different one (kind ENTRY), and all first entries that are of no level (kind
    NEW) if kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last entry: its columns and whether it has been given out
        for batch in batches:
            kind, _, narrow, wide, doc, packed = (column.to_numpy() for column in batch.columns)
            spans = kind == SPAN
            if spans.any():
                yield batch.filter(pa.array(spans))
            entry = ~spans
            sure = (kind[entry] == NEW) | (kind[entry] == KNOWN)
            own = (kind[entry] == ENTRY) | (kind[entry] == NEW)
            narrow, wide, doc, packed = (one[entry] for one in (narrow, wide, doc, packed))
            if not len(narrow):
                continue
            given = np.zeros(len(narrow) + 1, bool)
            if carried is not None:
                narrow, wide, doc, packed = (
                    np.append(np.int64(old), one)
                    for old, one in zip(carried[:4], (narrow, wide, doc, packed))
                )
                sure, given[0] = np.append(False, sure), carried[4]
                own = np.append(False, own)
            given = given[: len(narrow)]
            opens = np.ones(len(narrow), bool)
            opens[1:] = narrow[1:] != narrow[:-1]
            first = opens.copy()
            first[1:] |= wide[1:] != wide[:-1]
            yield removed(first, doc, packed)
            group = (np.cumsum(opens) - 1)[first]
            sure, given, own, narrow, wide, doc, packed = (
                one[first] for one in (sure, given, own, narrow, wide, doc, packed)
            )
            many = np.bincount(group)[group] > 1
            # The first row of a group that began in an earlier batch and was given out.
            known = np.zeros(int(group[-1]) + 1, bool)
            known[group[0]] = given[0]
            out = (many | sure | known[group]) & ~given
            zero = np.zeros(int(out.sum()), np.int64)
            yield found_rows(
                np.full(len(zero), ENTRY), zero, narrow[out], wide[out], doc[out], packed[out]
            )
            if keep_index and own.any():
                yield found_rows(
                    np.full(int(own.sum()), NEW), np.zeros(int(own.sum()), np.int64),
                    narrow[own], wide[own], doc[own], packed[own],
                )
            carried = (narrow[-1], wide[-1], doc[-1], packed[-1], bool(out[-1] or given[-1]))

    return run


RANGED = "key long, full long, low int, high int, doc long, packed long, around binary"
COMPARED = "kind int, " + RANGED + ", start long, end long"


def rows_of(schema: str, *columns) -> pa.RecordBatch:
    """A batch with the names of a schema; a column is an array, or a value for every row."""
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays(list(columns), names=names)


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values).view(np.int64))


def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, entries, text) -> a row per entry of the text, keyed by ``narrow``, for all of its
    windows, with the bytes that they reach."""

    def rows(narrow, doc, packed, around) -> pa.RecordBatch:
        zero = np.zeros(len(narrow), np.int64)
        low, high = (pa.array((zero + step).astype(np.int32)) for step in (0, WINDOWS))
        keys = [pa.array(one, pa.int64()) for one in (narrow, doc, packed)]
        return rows_of(
            RANGED, keys[0], pa.array(zero), low, high, *keys[1:], pa.array(around, pa.binary())
        )

    for batch in pieces(batches):
        texts, docs, twins = utf8(batch.column(3)), *(batch.column(at).to_pylist() for at in (0, 1))
        narrow, doc, packed, around = [], [], [], []
        for number, entries in enumerate(batch.column(2).to_pylist()):
            text = texts[number]
            for entry in entries:
                word = entry["packed"]
                if word >> 48 != twins[number]:
                    continue
                place = (word >> 16) & 0xFFFFFFFF
                narrow.append(entry["narrow"])
                doc.append(docs[number])
                packed.append(word)
                around.append(text[place - ((word >> 8) & 255) : place + (word & 255)])
            if len(narrow) >= 50_000:
                yield rows(narrow, doc, packed, around)
                narrow, doc, packed, around = [], [], [], []
        yield rows(narrow, doc, packed, around)


def running_sums(packed: np.ndarray, around: list[bytes]) -> np.ndarray:
    """Hash sums over each entry's bytes, with its anchor at column REACH."""
    before = (packed >> 8) & 255
    width = REACH + LENGTH
    padded = b"".join(
        one.rjust(len(one) + REACH - int(left), b"\0").ljust(width, b"\0")
        for one, left in zip(around, before)
    )
    data = np.frombuffer(padded, np.uint8).reshape(-1, width)
    sums = np.zeros((len(data), width + 1), np.uint64)
    np.cumsum(_VALUES[data] * tables(width)[0][:width], axis=1, out=sums[:, 1:])
    return sums


def inside(packed: np.ndarray, low, high) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows from low to high (exclusive), the first and the end of those that lie inside
    the document."""
    return np.maximum(low, REACH - ((packed >> 8) & 255)), np.minimum(high, (packed & 255) - GRAM + 1)


def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries with a range of windows -> either half of the range, keyed by the string that all
    its windows hold, with a hash of all that they reach; entries that agree in all of it are
    settled within the task first."""
    for batch in batches:
        for at in range(0, batch.num_rows, HELD_ENTRIES):
            part = batch.slice(at, HELD_ENTRIES)
            low, high = (part.column(place).to_numpy().astype(np.int64) for place in (2, 3))
            packed = part.column(5).to_numpy()
            sums, down = running_sums(packed, part.column(6).to_pylist()), tables(REACH + LENGTH)[1]
            middle = (low + high) // 2
            found = []
            for begin, end in ((low, middle), (middle, high)):
                first, last = inside(packed, begin, end)
                rows = np.flatnonzero(first < last)
                begin, end, first, last = begin[rows], end[rows], first[rows], last[rows]
                # Windows of a range hold what is from the last one's start to the first one's end.
                core = (sums[rows, begin + LENGTH] - sums[rows, end - 1]) * down[end - 1]
                reach = (sums[rows, last - 1 + LENGTH] - sums[rows, first]) * down[first]
                key = mixed(mixed(core) ^ (begin * 256 + end).astype(np.uint64))
                full = mixed(mixed(reach) ^ (first * 256 + last).astype(np.uint64)) ^ key
                found.append((rows, key.view(np.int64), full.view(np.int64), begin, end))
            rows, key, full, begin, end = (np.concatenate(one) for one in zip(*found))
            keyed = [pa.array(key), pa.array(full)]
            keyed += [pa.array(one.astype(np.int32)) for one in (begin, end)]
            keyed += [part.column(place).take(pa.array(rows)) for place in (4, 5, 6)]
            order = np.lexsort((packed[rows], keyed[4].to_numpy(), full, key))
            yield from settle_equal(iter([entry_batch(rows_of(RANGED, *keyed).take(pa.array(order)))]))


def first_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``halves`` of ``surroundings``, in one process."""
    return halves(surroundings(batches))


def settle_equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in order of (key, full, doc, packed) -> the first of each key and full, and the spans
    that the windows of the others reach; spans pass through."""
    held, held_place = None, None
    for batch in batches:
        entry = pa.compute.equal(batch.column(0), ENTRY)
        yield batch.filter(pa.compute.invert(entry))
        batch = rows_of(RANGED, *batch.filter(entry).columns[1:8])
        if not batch.num_rows:
            continue
        key, full, low, high, doc, packed = (batch.column(at).to_numpy() for at in range(6))
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (full[1:] != full[:-1])
        chief = np.flatnonzero(first)[np.cumsum(first) - 1]
        chief_doc, chief_packed = doc[chief], packed[chief]
        if held == (key[0], full[0]):
            own = chief == 0
            chief_doc = np.where(own, held_place[0], chief_doc)
            chief_packed = np.where(own, held_place[1], chief_packed)
            first[0] = False
        held, held_place = (key[-1], full[-1]), (chief_doc[-1], chief_packed[-1])
        later = np.flatnonzero((doc != chief_doc) | (packed != chief_packed))
        start, end = inside(packed[later], low[later], high[later])
        place = place_of(packed[later]) - REACH
        yield span_batch(doc[later], packed[later] >> 48, place + start, place + end - 1 + LENGTH)
        yield entry_batch(batch.filter(pa.array(first)))


def entry_batch(rows: pa.RecordBatch) -> pa.RecordBatch:
    none = pa.nulls(rows.num_rows, pa.int64())
    kind = pa.array(np.full(rows.num_rows, ENTRY, np.int32))
    return rows_of(COMPARED, kind, *rows.columns, none, none)


def span_batch(doc, twin, low, high) -> pa.RecordBatch:
    doc, twin, low, high = joined_spans(doc, twin, low, high)
    size = len(doc)
    steps = pa.nulls(size, pa.int32())
    return rows_of(
        COMPARED, pa.array(np.full(size, SPAN, np.int32)), longs(mixed(doc.view(np.uint64))),
        pa.nulls(size, pa.int64()), steps, steps, longs(doc), longs(pack_place(twin, low, 0, 0)),
        pa.nulls(size, pa.binary()), longs(low), longs(high),
    )


def repeated_windows(keys: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Valid windows that an earlier row has too, at the same step; rows are in corpus order."""
    repeated = np.zeros(valid.shape, bool)
    for step in range(keys.shape[1]):
        rows = np.flatnonzero(valid[:, step])
        column = keys[rows, step]
        order = np.argsort(column, kind="stable")
        ordered = column[order]
        again = np.zeros(len(rows), bool)
        again[1:] = ordered[1:] == ordered[:-1]
        repeated[rows[order[again]], step] = True
    return repeated


def compare_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, doc, packed) -> the spans of windows that an earlier row of the same
    key has too. A key has a bounded number of rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, HELD_ENTRIES):
            held.append(batch.slice(at, HELD_ENTRIES))
            size += held[-1].num_rows
            if size < HELD_ENTRIES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column(0).to_numpy()
            whole = int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])
            yield compared(table.slice(0, whole))
            held, size = table.slice(whole).to_batches(), table.num_rows - whole
    if held:
        yield compared(pa.Table.from_batches(held))


def compared(table: pa.Table) -> pa.RecordBatch:
    key, _, low, high, doc, packed = (table.column(at).to_numpy() for at in range(6))
    if not len(key):
        return span_batch(*[np.empty(0, int)] * 4)
    sums, down = running_sums(packed, table.column(6).to_pylist()), tables(REACH + LENGTH)[1]
    windows = (sums[:, LENGTH:] - sums[:, :WINDOWS]) * down[:WINDOWS]
    windows = mixed(mixed(windows) ^ key.view(np.uint64)[:, None])
    first, last = inside(packed, low, high)
    step = np.arange(WINDOWS)
    repeated = repeated_windows(windows, (step >= first[:, None]) & (step < last[:, None]))
    # The same occurrence named twice is no repeat.
    repeated[1:][(key[1:] == key[:-1]) & (doc[1:] == doc[:-1]) & (packed[1:] == packed[:-1])] = False
    some = repeated.any(axis=1)
    place = place_of(packed)[some] - REACH
    start = place + repeated.argmax(axis=1)[some]
    end = place + WINDOWS - 1 - repeated[:, ::-1].argmax(axis=1)[some] + LENGTH
    return span_batch(doc[some], (packed >> 48)[some], start, end)


def by_document(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows, stored in buckets of ``doc`` in the shared folder: every later join with them, for
    each batch and for the result, leaves the texts where they are."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_documents_{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        (
            rows.repartition(buckets, "doc")
            .sortWithinPartitions("doc")
            .write.bucketBy(buckets, "doc")
            .sortBy("doc")
            .option("path", scratch_location(spark, "documents"))
            .saveAsTable(name)
        )
    return spark.table(name)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc (null: least), twin (number among different texts of one doc_id), text."""
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    digests = rows.select("doc", F.xxhash64("text").alias("digest"))
    clashing = digests.groupBy("doc").agg(
        F.min("digest").alias("low"), F.max("digest").alias("high")
    ).where("low <> high")
    if clashing.isEmpty():
        return rows.select("doc", F.lit(0).alias("twin"), "text")
    order = Window.partitionBy("doc").orderBy("digest")
    twins = (
        digests.join(clashing.select("doc"), "doc", "left_semi")
        .distinct()
        .select("doc", "digest", (F.row_number().over(order) - 1).alias("number"))
    )
    hashed = rows.withColumn("digest", F.xxhash64("text"))
    return hashed.join(twins, ["doc", "digest"], "left").select(
        "doc", F.coalesce("number", F.lit(0)).cast("int").alias("twin"), "text"
    )


@dataclass
class SuffixFamily:
    """Levels of entries, oldest and largest first, and the documents (doc, twin, text) they come
    from, in buckets of ``doc``.

    ``add`` takes batches in corpus order: every document of a batch follows those before.
    """

    spark: SparkSession
    corpus: DataFrame
    together: int = TOGETHER
    levels: list[tuple[int, DataFrame, Scratch]] = field(default_factory=list)

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Spans (doc, twin, low, high) of a (doc, twin, text) batch that repeat earlier text.

        ``last``: no batch will follow, so its entries need not be kept, nor the levels.
        """
        rows = batch.select("doc", "twin", "text").mapInArrow(anchor_rows, FOUND)
        for _, level, _ in self.levels:
            rows = rows.unionByName(level)
        ordered = rows.repartition("route").sortWithinPartitions(
            "route", "narrow", "wide", "doc", "packed"
        )
        work = Scratch(self.spark)
        found = work.staged(ordered.mapInArrow(scan_entries(not last), FOUND), "entries")
        if last:
            for _, _, table in self.levels:
                table.drop()
            self.levels = []
        else:
            self._keep(found.where(F.col("kind") == NEW).select("narrow", "wide", "doc", "packed"))
        spans = found.where(F.col("kind") == SPAN).select(
            "doc",
            F.shiftright("packed", 48).cast("int").alias("twin"),
            F.shiftright("packed", 16).bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"),
            F.col("wide").alias("high"),
        )
        compared = self._compare(found.where(F.col("kind") == ENTRY), work)
        spans = staged(self.spark, spans.unionByName(compared), "spans")
        work.drop()
        return spans

    def _keep(self, entries: DataFrame) -> None:
        """The batch's entries are a level of their own, merged with levels as large as it."""
        parts, size, merged = [entries], entries.count(), []
        while self.levels and self.levels[-1][0] <= 2 * size:
            equal, level, table = self.levels.pop()
            parts.append(level.select("narrow", "wide", "doc", "packed"))
            merged.append(table)
            size += equal
        level = parts[0]
        for part in parts[1:]:
            level = level.unionByName(part)
        # A crowded anchor's entries are spread by their surroundings; two stay to tell the others.
        members = level.groupBy("narrow").agg(
            F.count(F.lit(1)).alias("members"), F.min("wide").alias("least"), F.max("wide").alias("most")
        )
        work, table = Scratch(self.spark), Scratch(self.spark)
        crowded = work.staged(members.where(F.col("members") > SPREAD), "crowded")
        spread = F.coalesce((F.col("wide") != F.col("least")) & (F.col("wide") != F.col("most")), F.lit(False))
        dealt = level.join(crowded, "narrow", "left").select(
            F.when(spread, KNOWN).otherwise(OLD).alias("kind"),
            F.when(spread, F.xxhash64("wide")).otherwise(F.col("narrow")).alias("route"),
            "narrow",
            "wide",
            "doc",
            "packed",
        )
        self.levels.append((size, table.staged(dealt, "level"), table))
        for old in [work, *merged]:
            old.drop()

    def _fetched(self, entries: DataFrame) -> DataFrame:
        """Documents with the entries in them."""
        of_doc = entries.groupBy(F.col("doc").alias("of")).agg(
            F.collect_list(F.struct("narrow", "packed")).alias("entries")
        )
        corpus = self.corpus.join(of_doc, F.col("doc") == F.col("of"))
        return corpus.select("doc", "twin", "entries", "text")

    def _compare(self, entries: DataFrame, work: Scratch) -> DataFrame:
        """Spans of windows that two entries of an anchor share."""
        counts = entries.groupBy("narrow").agg(F.count(F.lit(1)).alias("members"))
        many = counts.where(F.col("members") > self.together).select("narrow")
        crowded = work.staged(many, "crowded")
        if crowded.isEmpty():
            parts, spans = [self._fetched(entries).mapInArrow(surroundings, RANGED)], []
        else:
            # No hint: Spark broadcasts the anchors if they are few, and else splits skewed parts.
            few = self._fetched(entries.join(crowded, "narrow", "left_anti"))
            parts = [few.mapInArrow(surroundings, RANGED)]
            settled, spans = self._divided(self._fetched(entries.join(crowded, "narrow")), work)
            parts += settled
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part)
        ordered = together.repartition("key").sortWithinPartitions("key", "doc", "packed")
        found = ordered.mapInArrow(compare_entries, COMPARED).select("doc", "packed", "start", "end")
        for part in spans:
            found = found.unionByName(part)
        return found.select(
            "doc",
            F.shiftright("packed", 48).cast("int").alias("twin"),
            F.col("start").alias("low"),
            F.col("end").alias("high"),
        )

    def _divided(self, fetched: DataFrame, work: Scratch) -> tuple[list[DataFrame], list[DataFrame]]:
        """Entries of crowded anchors, in their documents, by halves of their windows, until few share a half: the rows
        to compare, and the spans found on the way. A half of one window leaves one row of a key."""
        settled, spans = [], []
        rows, cut = fetched, first_halves
        while True:
            ordered = (
                rows.mapInArrow(cut, COMPARED)
                .repartition("key", "full")
                .sortWithinPartitions("kind", "key", "full", "doc", "packed")
            )
            left = work.staged(ordered.mapInArrow(settle_equal, COMPARED), "halves")
            spans.append(left.where(F.col("kind") == SPAN).select("doc", "packed", "start", "end"))
            entries = left.where(F.col("kind") == ENTRY).drop("kind", "start", "end")
            counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
            shared = work.staged(counts.where("members > 1"), "shared")
            few = F.col("members") <= self.together
            settled.append(entries.join(shared.where(few).select("key"), "key"))
            crowded = shared.where(~few).select("key")
            if crowded.isEmpty():
                return settled, spans
            rows, cut = entries.join(crowded, "key"), halves


KEPT = "doc long, n_bytes long, n_removed long, n_spans long, kept binary"


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, text, spans) -> doc, n_bytes, n_removed, n_spans, kept."""
    for batch in pieces(batches):
        twins, texts = batch.column(1).to_pylist(), utf8(batch.column(2))
        spans = batch.column(3).to_pylist()
        for start in range(0, batch.num_rows, 500):
            sizes, gone, runs, kept = [], [], [], []
            part = slice(start, start + 500)
            for twin, text, rows in zip(twins[part], texts[part], spans[part]):
                at, left, lost, count = 0, [], 0, 0
                end = -1
                own = [one for one in rows or () if one["twin"] == twin]
                for low, high in sorted((one["low"], one["high"]) for one in own):
                    if low > end:
                        left.append(text[at:low])
                        count += 1
                        end = low
                    if high > end:
                        lost += high - end
                        end = high
                    at = end
                left.append(text[at:])
                sizes.append(len(text))
                gone.append(lost)
                runs.append(count)
                kept.append(b"".join(left))
            arrays = [batch.column(0).slice(start, 500)]
            arrays += [pa.array(one, pa.int64()) for one in (sizes, gone, runs)]
            arrays.append(pa.array(kept, pa.binary()))
            names = [part.split()[0] for part in KEPT.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


# Batches that a whole corpus is loaded in, in its order.
BATCHES = 3


def ordered_batches(rows: DataFrame, batches: int) -> list[DataFrame]:
    """The rows in ``batches`` ranges of ``doc``, in corpus order, of about equal counts."""
    if batches <= 1:
        return [rows]
    cuts = rows.approxQuantile("doc", [at / batches for at in range(1, batches)], 0.01)
    edges = [None, *sorted({int(cut) for cut in cuts}), None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.where(F.col("doc") > low)
        if high is not None:
            part = part.where(F.col("doc") <= high)
        parts.append(part)
    return parts


def repeated_spans(
    docs: DataFrame, doc_id: str, text: str, batches: int, together: int = TOGETHER
) -> tuple[DataFrame, DataFrame]:
    """The rows (doc, twin, text) and the spans (doc, twin, low, high) to remove from them."""
    rows = by_document(docs.sparkSession, keyed(docs, doc_id, text))
    family = SuffixFamily(docs.sparkSession, rows, together)
    parts = ordered_batches(rows, batches)
    spans = None
    for number, part in enumerate(parts):
        found = family.add(part, last=number == len(parts) - 1)
        spans = found if spans is None else spans.unionByName(found)
    return rows, spans


def cut_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    batches: int = BATCHES,
    together: int = TOGETHER,
) -> DataFrame:
    """A row per row of docs: doc_id, twin_text (its text), n_bytes, n_removed, n_spans, kept
    (the bytes that are left; a character cut in two leaves the bytes of its other part)."""
    rows, spans = repeated_spans(docs, doc_id, text, batches, together)
    listed = spans.groupBy(F.col("doc").alias("of")).agg(
        F.collect_list(F.struct("twin", "low", "high")).alias("spans")
    )
    joined = rows.join(listed, F.col("doc") == F.col("of"), "left")
    joined = joined.select("doc", "twin", "text", "spans")
    cut = joined.mapInArrow(cut_spans, KEPT)
    return cut.select(
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept",
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES
) -> DataFrame:
    """The documents without repeated passages; all columns of the input.

    Bytes of a character cut in two are dropped. A document that was not empty and has nothing
    left is dropped too.
    """
    rows, spans = repeated_spans(docs, doc_id, text, batches)
    listed = spans.groupBy(F.col("doc").alias("__of"), F.col("twin").alias("of_twin")).agg(
        F.collect_list(F.struct("twin", "low", "high")).alias("__spans")
    )
    twins = rows.select("doc", "twin", F.xxhash64("text").alias("digest")).where("twin > 0").distinct()
    listed = listed.join(
        twins.select(F.col("doc").alias("__of"), F.col("twin").alias("of_twin"), "digest"),
        ["__of", "of_twin"],
        "left",
    ).select("__of", F.col("of_twin").alias("__number"), "__spans", F.col("digest").alias("__twin"))
    own = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))
    whole = F.coalesce(F.col(text), F.lit(""))
    joined = docs.join(
        listed,
        (own == F.col("__of")) & F.coalesce(F.col("__twin") == F.xxhash64(whole), F.lit(True)),
        "left",
    )
    named = [F.col(f"`{name}`") for name in docs.columns]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in pieces(batches):
            place = pa.array(np.zeros(batch.num_rows, np.int64))
            number, spans = batch.column(len(names)), batch.column(len(names) + 1)
            only = pa.RecordBatch.from_arrays(
                [place, number, batch.column(at), spans], names=["doc", "twin", "text", "spans"]
            )
            kept, lost = [], []
            for part in cut_spans(iter([only])):
                kept += [row.decode(errors="ignore") for row in part.column(4).to_pylist()]
                lost += part.column(2).to_pylist()
            stays = pa.array([not gone or bool(row) for row, gone in zip(kept, lost)], pa.bool_())
            untouched = pa.compute.equal(pa.array(lost, pa.int64()), 0)
            texts = pa.compute.if_else(untouched, batch.column(at), pa.array(kept, batch.column(at).type))
            columns = [texts if n == at else batch.column(n) for n in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(stays)

    names = docs.columns
    return joined.select(*named, "__number", "__spans").mapInArrow(cut, docs.schema)
