"""Labelled rows for training, held-out rows, and scoring of all documents."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows a model is fitted on: those with the least hash of doc_id, if there are more.
MOST_LABELLED = 20_000
HELD_OUT_OF = 4
HELD_OUT = 2


def is_held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text leaves remainder 2 of 4; a null doc_id is not held out."""
    digest = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(digest % HELD_OUT_OF == HELD_OUT, F.lit(False))


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_LABELLED,
) -> DataFrame:
    """label (0 or 1) and text of at most ``most`` labelled rows that are not held out.

    Rows of ``labels`` without doc_id or label count for nothing; of several for one doc_id the
    greatest label holds. At most ``most`` ids are broadcast.
    """
    chosen = (
        labels.select(F.col(doc_id).alias("of"), F.col(label).cast("int").alias("label"))
        .where(F.col("of").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("of")))
        .groupBy("of")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("of"), "of")
        .limit(most)
    )
    return docs.join(F.broadcast(chosen), F.col(doc_id) == F.col("of")).select(
        "label", F.coalesce(F.col(text), F.lit("")).alias("text")
    )


def scored(
    docs: DataFrame,
    score: Callable[[list[bytes]], np.ndarray],
    threshold: float,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; a null text is an empty one."""
    from vitaelake.llm.wordarrays import batches_of, utf8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(2))
            for first, last in batches_of(texts):
                values = score(texts[first:last]).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(values),
                        pa.array((values >= threshold).astype(np.int32)),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        is_held_out(F.col(doc_id)).alias("held_out"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
