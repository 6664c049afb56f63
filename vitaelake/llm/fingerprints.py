"""Document fingerprints: a homomorphic hash of a text's paragraphs as a multiset.

Each paragraph (a text is cut at every ``\\n``) is hashed to a wide vector, and a text's fingerprint
is the sum of its paragraphs' vectors. So it does not depend on their order, a paragraph is put in by
adding its vector and taken out by subtracting it, and texts with the same paragraphs have the same
fingerprint. A vector has two parts:

* four lanes modulo 2**64 of a 256-bit digest of the paragraph: these tell multisets apart;
* 256 lanes modulo 2**32 that hold each run of three words of the paragraph (all of them, where
  there are fewer) as +1 or -1 in one lane. Products of such lanes estimate how many runs two texts
  share, so the likeness of two texts is read off their fingerprints, with a standard error of about
  1/16.

``edited_fingerprints`` compares every document with an edited copy and with the next document, by
ascending doc_id. Documents are dealt to ranges of doc_id that begin at actual documents; the first
of each range also goes to the range before, as the successor of its last. The edited copy's
fingerprint is the document's, less the paragraphs that change, plus those they change to.

Defined results: a null text is empty, which is one empty paragraph; a null doc_id sorts before all
others; rows of equal doc_id follow each other by the hash of their text; a table of one row has
itself as the next; texts without words are alike only if their fingerprints are equal; an empty
table gives an empty table; further columns are ignored. A run of words that a text repeats more than
2**31 times wraps its lane: equality and edits still hold then, the likeness does not.
"""

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.wordarrays import batches_of, cut_words, mixed, pieces, utf8

WORDS = 3
LANES = 256
DIGEST_LANES = 4
# Ranges of doc_id for every shuffle partition, so that partitions are dealt alike.
RANGES = 4
_STEPS = mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Vectors:
    """A row per text: exact lanes modulo 2**64, word lanes modulo 2**32."""

    exact: np.ndarray
    lanes: np.ndarray

    def plus(self, other: "Vectors") -> "Vectors":
        return Vectors(self.exact + other.exact, self.lanes + other.lanes)

    def minus(self, other: "Vectors") -> "Vectors":
        return Vectors(self.exact - other.exact, self.lanes - other.lanes)

    def rows(self, chosen) -> "Vectors":
        return Vectors(self.exact[chosen], self.lanes[chosen])

    def followed_by(self, other: "Vectors") -> "Vectors":
        return Vectors(np.vstack([self.exact, other.exact]), np.vstack([self.lanes, other.lanes]))

    def texts(self) -> list[str]:
        """Each fingerprint as base64 of its lanes, least byte first."""
        exact, lanes = self.exact.astype("<u8"), self.lanes.astype("<u4")
        return [
            base64.b64encode(one.tobytes() + other.tobytes()).decode()
            for one, other in zip(exact, lanes)
        ]


def paragraph_sums(texts: list[bytes]) -> Vectors:
    """The sum of the vectors of each text's paragraphs."""
    paragraphs, counts = [], np.zeros(len(texts), np.int64)
    for number, text in enumerate(texts):
        cut = text.split(b"\n")
        counts[number] = len(cut)
        paragraphs += cut
    first = np.cumsum(counts) - counts
    digests = b"".join(hashlib.blake2b(one, digest_size=8 * DIGEST_LANES).digest() for one in paragraphs)
    digests = np.frombuffer(digests, "<u8").reshape(-1, DIGEST_LANES)
    exact = np.add.reduceat(digests, first, axis=0) if len(texts) else digests.copy()

    cut = cut_words(paragraphs)
    words = np.diff(cut.first)
    number = np.repeat(np.arange(len(paragraphs)), words)
    keys = cut.hashes * _STEPS[0]
    for step in range(1, WORDS):
        later = np.zeros(len(keys), np.uint64)
        later[: len(keys) - step] = (cut.hashes[step:] + np.uint64(step)) * _STEPS[step]
        inside = np.zeros(len(keys), bool)
        inside[: len(keys) - step] = number[step:] == number[: len(keys) - step]
        keys += np.where(inside, later, np.uint64(0))
    place = np.arange(len(keys)) - np.repeat(cut.first[:-1], words)
    whole = place <= np.repeat(np.maximum(words - WORDS, 0), words)
    keys = mixed(keys[whole])
    owner = np.repeat(np.arange(len(texts)), counts)[number[whole]]
    lane = owner * LANES + (keys & np.uint64(LANES - 1)).astype(np.int64)
    signs = 1.0 - 2.0 * (keys >> np.uint64(63)).astype(float)
    summed = np.bincount(lane, weights=signs, minlength=len(texts) * LANES)
    lanes = summed.astype(np.int64).astype(np.uint32).reshape(len(texts), LANES)
    return Vectors(exact, lanes)


def likeness(one: Vectors, other: Vectors) -> np.ndarray:
    """0 to 1 for each row: the shared share of both texts' runs of words, 1 for equal rows."""
    a, b = one.lanes.view(np.int32).astype(float), other.lanes.view(np.int32).astype(float)
    both = (a * a).sum(axis=1) + (b * b).sum(axis=1)
    shared = np.clip(2 * (a * b).sum(axis=1) / np.where(both > 0, both, 1), 0, 1)
    equal = (one.exact == other.exact).all(axis=1) & (one.lanes == other.lanes).all(axis=1)
    return np.where(equal, 1.0, shared)


COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_rows(ids: list, texts: list[bytes], vectors: Vectors, pairs: np.ndarray) -> pa.RecordBatch:
    """The results of the rows at ``pairs``, each of which the following row is the next of."""
    sizes, digests, gone, come = [], [], [], []
    for at in pairs.tolist():
        text, following = texts[at].decode(), texts[at + 1].decode()
        lost = len(text) // 2
        head = text[: len(text) - lost]
        # Paragraphs before the one that the edit starts in stay as they are.
        same = head.rfind("\n") + 1
        edited = head + following[:lost]
        sizes.append(len(text))
        digests.append(hashlib.sha256(edited.encode()).hexdigest())
        gone.append(text[same:].encode())
        come.append(edited[same:].encode())
    own, after = vectors.rows(pairs), vectors.rows(pairs + 1)
    edited = own.minus(paragraph_sums(gone)).plus(paragraph_sums(come))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[at] for at in pairs.tolist()], pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(own.texts(), pa.string()),
            pa.array(edited.texts(), pa.string()),
            pa.array(likeness(own, edited)),
            pa.array(likeness(own, after)),
        ],
        names=[name.split()[0] for name in COLUMNS.split(", ")],
    )


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, follower, doc_id, text) in that order -> the results of each row but the followers.

    A part's rows are its documents and then the next part's first; the last row of a batch is
    kept to meet the next one's first.
    """
    kept_part, kept_follower = np.empty(0, np.int32), np.empty(0, bool)
    kept_ids: list = []
    kept_texts: list[bytes] = []
    kept = paragraph_sums([])
    for batch in pieces(batches):
        part, follower = batch.column(0).to_numpy(), np.asarray(batch.column(1))
        ids, texts = batch.column(2).to_pylist(), utf8(batch.column(3))
        for first, last in batches_of(texts):
            parts = np.concatenate([kept_part, part[first:last]])
            followers = np.concatenate([kept_follower, follower[first:last]])
            # Further followers of a part only repeat the first one's doc_id.
            extra = np.zeros(len(parts), bool)
            extra[1:] = followers[1:] & followers[:-1] & (parts[1:] == parts[:-1])
            chosen = np.flatnonzero(~extra)
            new = chosen[chosen >= len(kept_ids)] - len(kept_ids) + first
            row_ids = kept_ids + [ids[at] for at in new]
            row_texts = kept_texts + [texts[at] for at in new]
            vectors = kept.followed_by(paragraph_sums(row_texts[len(kept_ids) :]))
            parts, followers = parts[chosen], followers[chosen]
            pairs = np.flatnonzero(parts[1:] == parts[:-1])
            if len(pairs):
                yield edited_rows(row_ids, row_texts, vectors, pairs)
            kept_part, kept_follower = parts[-1:], followers[-1:]
            kept_ids, kept_texts = row_ids[-1:], row_texts[-1:]
            kept = vectors.rows(slice(-1, None))


def deal(batches: Iterator[pa.RecordBatch], starts: np.ndarray, least: int | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, text) -> part, follower and the row; the first document of a part once more,
    as the follower of the part before. ``least`` is the smallest doc_id, or null."""
    parts = len(starts) + 1
    for batch in batches:
        ids = batch.column(0)
        known = np.asarray(ids.is_valid())
        values = ids.fill_null(0).to_numpy()
        part = np.where(known, np.searchsorted(starts, values, side="right"), 0).astype(np.int32)
        yield dealt(batch, np.arange(len(ids)), part, False)
        at_least = ~known if least is None else known & (values == least)
        head = at_least.copy()
        if len(starts):
            inner = known & (part > 0)
            head |= inner & (values == starts[np.maximum(part - 1, 0)])
        rows = np.flatnonzero(head)
        before = np.where(at_least[rows], parts - 1, part[rows] - 1).astype(np.int32)
        yield dealt(batch, rows, before, True)


def dealt(batch: pa.RecordBatch, rows: np.ndarray, part: np.ndarray, follower: bool) -> pa.RecordBatch:
    chosen = batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(part), pa.array(np.full(len(rows), follower)), *chosen.columns],
        names=["part", "follower", "doc_id", "digest", "text"],
    )


def range_starts(ids: DataFrame, ranges: int) -> tuple[np.ndarray, int | None]:
    """doc_ids at which ranges of about equal size begin, and the smallest doc_id, or None for null."""
    shares = [number / ranges for number in range(1, ranges)]
    found = ids.agg(
        F.percentile_approx("doc_id", shares or [0.5], 100 * ranges).alias("starts"),
        F.min("doc_id").alias("least"),
        F.count_if(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    least = None if found["nulls"] else found["least"]
    starts = sorted(set(found["starts"] or []) - {found["least"]}) if shares else []
    return np.array(starts, np.int64), least


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its last half replaced by the start of the next."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text)).alias("digest"),
        F.col(text).alias("text"),
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts, least = range_starts(docs.select(F.col(doc_id).cast("long").alias("doc_id")), RANGES * partitions)
    parts = rows.mapInArrow(
        partial(deal, starts=starts, least=least),
        "part int, follower boolean, doc_id long, digest long, text string",
    )
    ordered = parts.repartition("part").sortWithinPartitions("part", "follower", "doc_id", "digest")
    return ordered.select("part", "follower", "doc_id", "text").mapInArrow(neighbours, COLUMNS)
