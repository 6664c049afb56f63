"""Cost-balanced packing of documents into sequences of bounded length.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention is within a document. A
document's full-length pieces are sequences of their own; the rest of each document, longest
first, goes to the sequence of lowest cost that has room for it. There are as few sequences as
the tokens need, so at the end a rest may fit nowhere whole; it is then cut over the sequences of
lowest cost with room. Each task packs the documents it reads, a few million ids at a time, so
nothing is shuffled, and fewer than ``capacity`` places of each such batch stay empty.

Defined results: a null text is an empty document, which still has its end id; a null doc_id and
repeated rows are packed like any other row, each once; an empty table gives no pieces; further
columns are ignored.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_cost double"
)


@dataclass(frozen=True)
class Settings:
    """capacity: tokens of a sequence. linear, quadratic: cost of a piece. batch_tokens: ids a
    task holds and packs at a time."""

    capacity: int = 2048
    linear: float = 1.0
    quadratic: float = 1.0 / 1024
    batch_tokens: int = 4_000_000


def assign(sizes: np.ndarray, settings: Settings) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these sizes."""
    capacity = settings.capacity
    pieces, sequence = [], 0
    for document, size in enumerate(sizes):
        for start in range(0, int(size) - capacity + 1, capacity):
            pieces.append((document, start, capacity, sequence, 0))
            sequence += 1
    rests = sizes % capacity
    order = np.argsort(-rests, kind="stable")
    order = order[rests[order] > 0]
    count = -(-int(rests.sum()) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity, np.int64)
    for document in order:
        left = int(rests[document])
        start = int(sizes[document]) - left
        while left:
            fitting = np.where(room >= left, cost, np.inf)
            chosen = int(fitting.argmin())
            if not np.isfinite(fitting[chosen]):
                chosen = int(np.where(room > 0, cost, np.inf).argmin())
            length = min(left, int(room[chosen]))
            pieces.append((document, start, length, sequence + chosen, capacity - int(room[chosen])))
            cost[chosen] += settings.linear * length + settings.quadratic * length * length
            room[chosen] -= length
            start, left = start + length, left - length
    return pieces


def pack_batch(
    keys: list, rows: list[np.ndarray], first_sequence: int, settings: Settings
) -> tuple[pa.RecordBatch, int]:
    sizes = np.array([len(ids) for ids in rows], np.int64)
    pieces = np.array(assign(sizes, settings), np.int64).reshape(-1, 5)
    document, start, length, sequence, offset = pieces.T
    sums = [
        zlib.crc32(rows[d][s : s + n].astype("<u4").tobytes())
        for d, s, n in zip(document.tolist(), start.tolist(), length.tolist())
    ]
    used = int(sequence.max()) + 1 if len(sequence) else 0
    own = settings.linear * length + settings.quadratic * length.astype(float) ** 2
    cost = np.bincount(sequence, own, used)
    columns = [
        pa.array(keys, pa.int64()).take(pa.array(document)),
        pa.array(start),
        pa.array(length),
        pa.array(sums, pa.int64()),
        pa.array(sizes[document]),
        pa.array(first_sequence + sequence),
        pa.array(offset),
        pa.array(cost[sequence]),
    ]
    names = [field.split()[0] for field in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names=names), used


def pack_partition(path: str, end_id: int, settings: Settings):
    from vitaelake.llm.tokens import document_ids
    from vitaelake.llm.wordarrays import utf8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        keys, rows, held = [], [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                encoded = document_ids(path, utf8(some.column(1)), end_id)
                for key, ids in zip(some.column(0).to_pylist(), encoded):
                    keys.append(key)
                    rows.append(ids)
                    held += len(ids)
                    if held >= settings.batch_tokens:
                        packed, used = pack_batch(keys, rows, sequence, settings)
                        yield packed
                        sequence, keys, rows, held = sequence + used, [], [], 0
        if rows:
            yield pack_batch(keys, rows, sequence, settings)[0]

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """A row per piece; ``sequence_id`` is the task's number and a count within it."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(pack_partition(tokenizer, end_id, settings), PIECES)
