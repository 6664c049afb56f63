"""Token ids in ORC files: written in document order, read back stripe by stripe.

Documents are range-partitioned and sorted by id, encoded in that order, and written with integer
run-length encoding, a row index and a Bloom filter on doc_id, so a reader of a few documents
skips stripes and row groups by their metadata, and a reader of all reads stripes in parallel.
Each row carries its partition number and the ids before it in that partition; the place in the
whole stream is that plus the totals of earlier partitions, one row per partition.

Defined results: a null text is an empty one (only the end id); a null doc_id sorts first; rows
with equal doc_id follow each other in no set order, each with its own place; an empty table
writes no ids and reads back as an empty table; further columns are not stored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STORED = "part int, part_start long, doc_id long, ids array<int>"
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
# Words that a worker remembers; fewer are encoded again more often, at a third more CPU time.
KNOWN = 1_000_000
READ = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long"


def encode_partition(path: str, end_id: int):
    from vitaelake.llm.tokens import document_ids
    from vitaelake.llm.wordarrays import utf8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for first in range(0, batch.num_rows, 1000):
                rows = document_ids(path, utf8(texts.slice(first, 1000)), end_id, KNOWN)
                sizes = np.array([len(ids) for ids in rows], np.int64)
                ends = np.cumsum(sizes)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), part, np.int32)),
                        pa.array(before + ends - sizes),
                        keys.slice(first, 1000),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows))),
                    ],
                    names=["part", "part_start", "doc_id", "ids"],
                )
                before += int(ends[-1])

    return run


def write_documents(
    docs: DataFrame,
    location: str,
    tokenizer: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (
        ordered.mapInArrow(encode_partition(tokenizer, end_id), STORED)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROWS_PER_INDEX)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(location)
    )


def read_tokens(spark: SparkSession, location: str) -> DataFrame:
    """The stored rows; a filter on doc_id is pushed to the files' metadata."""
    return spark.read.schema(STORED).orc(location)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        flat, offsets = ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()
        flat = flat.astype("<u4")
        sums = [
            zlib.crc32(flat[start:end].tobytes()) for start, end in zip(offsets[:-1], offsets[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(2),
                batch.column(0),
                batch.column(1),
                pa.array(np.diff(offsets).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ],
            names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
        )


def document_places(spark: SparkSession, location: str) -> DataFrame:
    """From the files: doc_id, start, n_tokens, ids_crc32."""
    stored = read_tokens(spark, location)
    rows = stored.mapInArrow(digests, READ)
    # One row per written partition: its ids, from the columns of sizes alone.
    totals = stored.groupBy("part").agg(F.sum(F.size("ids")).alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base")
    )
    return rows.join(places, F.col("part") == F.col("of_part")).select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
