"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees of one depth are grown on binned columns by the logistic loss, and kept as flat arrays, so
all documents of a batch walk all trees level by level in numpy.

Defined results: a null or empty text has all statistics 0 and is scored like any other; a null
doc_id and repeated rows are scored each; without labelled rows of both kinds every score is the
share of label 1 (0.5 without any); an empty table gives an empty table.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitaelake.llm.labelled import scored, training_rows
from vitaelake.llm.ngram_join import shingle_sets
from vitaelake.llm.wordarrays import LOWER, SPACES, batches_of, cut_words, utf8

# Byte classes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 plain mark, 5 loud mark, 6 symbol,
# 7 bar, 8 space, 9 line end, 10 beyond ASCII.
CLASSES = 11
_CLASS = np.zeros(256, np.int64)
_CLASS[128:] = 10
_CLASS[SPACES] = 8
for _number, _members in enumerate(
    [bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:'\"()-", b"!?", b"#*$%&<>{}@~^=+_\\/", b"|"], 1
):
    _CLASS[list(_members)] = _number
_CLASS[10] = 9

STATISTICS = 21


def document_statistics(texts: list[bytes]) -> np.ndarray:
    """A row of statistics for each text: shares of byte classes, sizes, and repetition."""
    count = len(texts)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, count)
    owner = np.repeat(np.arange(count), sizes)
    classes = np.bincount(owner * CLASSES + _CLASS[joined], minlength=count * CLASSES)
    classes = classes.reshape(count, CLASSES)
    folded = [text.translate(LOWER) for text in texts]
    cut = cut_words(folded)
    words = np.diff(cut.first)
    per_word, per_byte = np.maximum(words, 1), np.maximum(sizes, 1)[:, None]
    number = np.repeat(np.arange(count), words)
    lengths = (cut.ends - cut.starts).astype(float)
    mean = np.bincount(number, lengths, count) / per_word
    spread = np.bincount(number, lengths**2, count) / per_word - mean**2
    short = np.bincount(number, lengths <= 3, count) / per_word
    order = np.lexsort((cut.hashes, number))
    same = np.zeros(len(order), bool)
    same[1:] = (cut.hashes[order][1:] == cut.hashes[order][:-1]) & (
        number[order][1:] == number[order][:-1]
    )
    repeated = np.bincount(number[order][same], minlength=count) / per_word
    _, bounds = shingle_sets(folded)
    shingles = np.maximum(words - 2, 1)
    triples = np.where(words > 0, 1 - np.diff(bounds) / shingles, 0)
    lines = [[line for line in text.split(b"\n") if line.strip()] for text in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, count)
    distinct = np.fromiter((len(set(row)) for row in lines), np.int64, count)
    columns = [
        np.log1p(sizes), np.log1p(words), mean, np.sqrt(np.maximum(spread, 0)), short, repeated,
        triples, 1 - distinct / np.maximum(n_lines, 1), np.log1p(words / np.maximum(n_lines, 1)),
        classes[:, 2] / np.maximum(classes[:, 1] + classes[:, 2], 1),
    ]
    return np.column_stack([*columns, classes / per_byte])


@dataclass
class Trees:
    """feature, threshold: of the inner nodes, a row per tree, a node's children at 2n+1 and 2n+2.
    leaf: values of the last level. start: the score's log-odds before any tree."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        number = np.arange(len(rows))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[number, feature[node]] > threshold[node])
            total += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    smooth: float = 5.0,
) -> Trees:
    """Boosted trees; a node splits where the binned gradients gain most."""
    width, inner = rows.shape[1], 2**depth - 1
    share = labels.mean() if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        trees = 0
    start = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if not trees:
        return Trees(feature, threshold, leaf, start)
    edges = [np.unique(np.quantile(rows[:, one], np.linspace(0, 1, bins + 1)[1:-1])) for one in range(width)]
    binned = np.stack([np.searchsorted(edges[one], rows[:, one]) for one in range(width)], axis=1)
    total = np.full(len(rows), start)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, weight = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            place = node - first
            everywhere = [np.bincount(place, of, count) for of in (slope, weight)]
            whole = everywhere[0] ** 2 / (everywhere[1] + smooth)
            for one in range(width):
                if not len(edges[one]):
                    continue
                key = place * bins + binned[:, one]
                g = np.bincount(key, slope, count * bins).reshape(count, bins).cumsum(axis=1)
                h = np.bincount(key, weight, count * bins).reshape(count, bins).cumsum(axis=1)
                gain = g**2 / (h + smooth) - whole[:, None]
                gain += (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + smooth)
                gain = gain[:, : len(edges[one])]
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best + 1e-9
                best[better] = gain[np.arange(count), at][better]
                feature[tree, first : first + count][better] = one
                threshold[tree, first : first + count][better] = edges[one][at[better]]
            node = 2 * node + 1 + (
                rows[np.arange(len(rows)), feature[tree, node]] > threshold[tree, node]
            )
        end = node - inner
        leaf[tree] = rate * np.bincount(end, slope, inner + 1) / (
            np.bincount(end, weight, inner + 1) + smooth
        )
        total += leaf[tree, end]
    return Trees(feature, threshold, leaf, start)


def statistics_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) -> label, statistics."""
    for batch in batches:
        texts = utf8(batch.column(1))
        for first, last in batches_of(texts):
            rows = document_statistics(texts[first:last])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(list(rows), pa.list_(pa.float64()))],
                names=["label", "statistics"],
            )


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", **names: str) -> Trees:
    """Fitted on a bounded sample of labelled rows that are not held out."""
    sample = training_rows(docs, labels, label, **names)
    table = sample.mapInArrow(statistics_rows, "label int, statistics array<double>").toArrow()
    rows = table["statistics"].combine_chunks().flatten().to_numpy().reshape(-1, STATISTICS)
    return fit(rows, table["label"].to_numpy().astype(float))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    trees = train(docs, labels, doc_id=doc_id, text=text)
    return scored(
        docs, lambda texts: trees.probability(document_statistics(texts)), threshold, doc_id, text
    )
