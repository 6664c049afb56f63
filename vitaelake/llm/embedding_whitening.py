"""Whitening of embeddings, with an exact covariance found by polarisation.

Entries become integers ``x = floor(64 c) + 1000000``, so sums are exact in any order. For every
dimension, and for the sum of every two dimensions, the tasks add up exact squares of values that
are centred first; each such total gives a variance, and

    2 cov(i, j) = var(i + j) - var(i) - var(j)

gives every covariance, without a product of two different dimensions. The matrix is put together
with whole-number arithmetic, rounded to doubles once, and handed to ``eigh``. What reaches the
driver are the D (D + 1) / 2 totals of D dimensions, however many rows there are.

Values are centred by the whole part of their mean and the totals are put right for the rest:
with ``S = n m + r`` and ``z = x - m``, the sum of ``(n x - S)^2`` is ``n^2 sum(z^2) - n r^2``.

The model is fitted on each distinct vector once; equal vectors are combined within each task before
the shuffle, so one vector that much of the table repeats is no burden to a task.

Defined results: rows whose vector is null, or has a null, NaN or infinite entry or one of 2**42 or
more, are dropped; so are vectors of another length than most remaining rows have (the longer on
ties). A component without variance has no rows (all, where all vectors are equal). A null vec_id is
carried; repeated rows are fitted once and projected each; a deviation beyond 64 bits is null; an
empty table gives an empty table; further columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.native import staged

STEP = 64
SHIFT = 1_000_000
# Entries from here on have no exact place in the sums.
TOO_LARGE = 2.0**42
COMPONENTS = 16
# Rows projected at once; centred values whose squares are added as 64-bit integers.
AT_ONCE = 2048
SMALL = 1 << 22
TOTALS = "i int, j int, total decimal(38,0)"


def integer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding as doubles) -> vec_id, x, size, without rows that have no value."""
    for batch in batches:
        vectors = batch.column(1)
        present = np.asarray(vectors.is_valid())
        sizes = pa.compute.list_value_length(vectors).fill_null(0).to_numpy().astype(np.int64)
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        with np.errstate(invalid="ignore"):
            bad = ~(np.abs(values) < TOO_LARGE)  # null entries are NaN here
        ends = np.cumsum(sizes)
        seen = np.concatenate([[0], np.cumsum(bad)])
        kept = present & (seen[ends] == seen[ends - sizes])
        whole = values[np.repeat(kept, sizes)]
        x = np.floor(STEP * whole).astype(np.int64) + SHIFT
        offsets = np.concatenate([[0], np.cumsum(sizes[kept])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).filter(pa.array(kept)),
                pa.ListArray.from_arrays(offsets, pa.array(x)),
                pa.array(sizes[kept]),
            ],
            names=["vec_id", "x", "size"],
        )


def matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def total_rows(i, j, totals) -> pa.RecordBatch:
    exact = pa.array([Decimal(int(total)) for total in totals], pa.decimal128(38, 0))
    places = [pa.array(np.asarray(place, np.int32)) for place in (i, j)]
    return pa.RecordBatch.from_arrays([*places, exact], names=["i", "j", "total"])


def sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(x) -> the number of vectors at (-1, -1) and the sum of each dimension at (i, i)."""
    count, held = 0, np.zeros(size, object)
    for batch in batches:
        count += batch.num_rows
        held = held + matrix(batch.column(0), size).sum(axis=0).astype(object)
    if count:
        places = [-1, *range(size)]
        yield total_rows(places, places, [count, *held])


def square_sums(z: np.ndarray) -> np.ndarray:
    """At (i, j), the sum of ``(z_i + z_j)^2``, and at (i, i) of ``z_i^2``."""
    size = z.shape[1]
    found = np.zeros((size, size), z.dtype)
    for i in range(size):
        both = z[:, i + 1 :] + z[:, i : i + 1]
        found[i, i] = (z[:, i] * z[:, i]).sum()
        found[i, i + 1 :] = (both * both).sum(axis=0)
    return found


def pair_totals(batches: Iterator[pa.RecordBatch], means: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(x) -> the totals of squares for every dimension and every two, at (i, j), i <= j."""
    size = len(means)
    held = np.zeros((size, size), object)
    seen = False
    for batch in batches:
        z = matrix(batch.column(0), size) - means
        small = (np.abs(z) < SMALL).all(axis=1)
        for first in range(0, len(z), AT_ONCE):
            some, fits = z[first : first + AT_ONCE], small[first : first + AT_ONCE]
            held = held + square_sums(some[fits]).astype(object)
            if not fits.all():
                held = held + square_sums(some[~fits].astype(object))
            seen = True
    if seen:
        i, j = np.triu_indices(size)
        yield total_rows(i, j, held[i, j])


def gathered(rows: DataFrame) -> dict[tuple[int, int], int]:
    """The totals of all tasks. As many rows as pairs of dimensions, at any size of table."""
    totals = rows.groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(row["i"], row["j"]): int(row["total"]) for row in totals.collect()}


@dataclass(frozen=True)
class Whitening:
    """means, rests: each dimension's sum is ``n * mean + rest``. axes: a column for each
    component, already divided by the root of its eigenvalue."""

    n: int
    means: np.ndarray
    rests: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def covariance(totals: dict[tuple[int, int], int], rests: list[int], n: int) -> np.ndarray:
    """The covariance matrix out of the variances of dimensions and of their sums."""
    size = len(rests)

    def variance(i: int, j: int, rest: int) -> int:
        return n * n * totals[i, j] - n * rest * rest  # times n ** 3

    own = [variance(i, i, rests[i]) for i in range(size)]
    found = np.empty((size, size))
    for i in range(size):
        found[i, i] = own[i] / n**3
        for j in range(i + 1, size):
            both = variance(i, j, rests[i] + rests[j])
            found[i, j] = found[j, i] = (both - own[i] - own[j]) / (2 * n**3)
    return found


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """Fitted on the rows of ``vectors`` (x, all of one size), each once."""
    first = gathered(vectors.mapInArrow(partial(sums, size=size), TOTALS))
    n = first[-1, -1]
    parts = [divmod(first[i, i], n) for i in range(size)]
    means, rests = [part[0] for part in parts], [part[1] for part in parts]
    squares = partial(pair_totals, means=np.array(means, np.int64))
    matrix_of = covariance(gathered(vectors.mapInArrow(squares, TOTALS)), rests, n)
    values, axes = np.linalg.eigh(matrix_of)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(matrix_of))
    # Rounding alone leaves eigenvalues of this size.
    present = values > 8 * size * np.finfo(float).eps * trace
    used = np.flatnonzero(present)[:components]
    return Whitening(
        n,
        np.array(means, np.int64),
        np.array(rests, object),
        axes[:, used] / np.sqrt(values[used]),
        values[used] / trace if trace else np.empty(0),
    )


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return ((x - model.means) - (model.rests / model.n).astype(float)) @ model.axes


def covariance_sums(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """(x) -> at (i, j) the sum of products of whitened components."""
    size = model.axes.shape[1]
    held = np.zeros((size, size))
    for batch in batches:
        values = whitened(matrix(batch.column(0), len(model.means)), model)
        held += values.T @ values
    i, j = np.indices(held.shape)
    yield pa.RecordBatch.from_arrays(
        [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(held.ravel())],
        names=["i", "j", "total"],
    )


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened covariance, as measured over the rows, less the identity."""
    size = model.axes.shape[1]
    if not size:
        return 0.0
    measured = vectors.mapInArrow(partial(covariance_sums, model=model), "i int, j int, total double")
    found = np.zeros((size, size))
    for row in measured.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[row["i"], row["j"]] = row["total"] / model.n
    return float(np.abs(found - np.eye(size)).max())


def deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """The sum of ``(n x - S)^2`` over the dimensions, exact; None beyond 64 bits."""
    z = x - model.means
    rests = model.rests.astype(np.int64)
    near = ((z.astype(float) * model.n - rests) ** 2).sum(axis=1) < 2.0**62
    found: list[int | None] = [None] * len(z)
    apart = z[near] * model.n - rests
    for at, total in zip(np.flatnonzero(near).tolist(), (apart * apart).sum(axis=1).tolist()):
        found[at] = total
    for at in np.flatnonzero(~near).tolist():
        total = sum((int(value) * model.n - rest) ** 2 for value, rest in zip(z[at], model.rests))
        found[at] = total if total < 1 << 63 else None
    return found


def projected(
    batches: Iterator[pa.RecordBatch], model: Whitening, error: float
) -> Iterator[pa.RecordBatch]:
    """(vec_id, x) -> a row for each vector and component."""
    size = model.axes.shape[1]
    for batch in batches:
        for first in range(0, batch.num_rows if size else 0, AT_ONCE):
            some = batch.slice(first, AT_ONCE)
            x = matrix(some.column(1), len(model.means))
            count = len(x) * size
            of_row = pa.array(np.repeat(np.arange(len(x)), size))
            yield pa.RecordBatch.from_arrays(
                [
                    some.column(0).take(of_row),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(count, model.n, np.int64)),
                    pa.array(deviations(x, model), pa.int64()).take(of_row),
                    pa.array(whitened(x, model).ravel()),
                    pa.array(np.tile(model.explained, len(x))),
                    pa.array(np.full(count, error)),
                ],
                names=[name.split()[0] for name in COLUMNS.split(", ")],
            )


COLUMNS = (
    "vec_id long, component int, n long, deviation long, "
    "whitened double, explained double, identity_error double"
)


def whiten(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per remaining vector and component: vec_id, component (1 is the widest), n (vectors
    fitted on), deviation, whitened, explained (share of all variance), identity_error."""
    spark = embeddings.sparkSession
    given = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("embedding"),
    )
    rows = given.mapInArrow(integer_rows, "vec_id long, x array<long>, size long")
    common = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], COLUMNS)
    rows = rows.where(F.col("size") == common["size"]).select("vec_id", "x")
    distinct = staged(spark, rows.select("x").distinct(), "fit-list")
    model = fit(distinct, common["size"], components)
    run = partial(projected, model=model, error=identity_error(distinct, model))
    return rows.mapInArrow(run, COLUMNS)
