"""Toxicity: a linear classifier over hashed words, regularised by counterfactuals.

Features are the distinct words of a text and their first four to six bytes, so endings do not
matter. In every labelled text that names a group, each name is swapped for another of its group
list; the fit penalises the squared change of the score's log-odds between the two texts. A term
that merely names a group then adds nothing, and neutral mentions are not taken for abuse.

Defined results: a null or empty text scores the intercept; a null doc_id and repeated rows are
scored each; without labelled rows of both kinds every score is the share of label 1, within 0.001 and 0.999 (0.5 without
any); an empty table gives an empty table.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from vitaelake.llm.labelled import scored, training_rows
from vitaelake.llm.wordarrays import batches_of, cut_words, mixed, utf8

BITS = 20
PREFIXES = (4, 5, 6)
# Features kept: those in at least so many training texts, and the most telling of them.
LEAST_TEXTS = 5
MOST_FEATURES = 4000

# Names of groups that are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "locals", "foreigners"),
    ("disabled", "deaf", "blind"),
    ("old", "young"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

# A to Z folded, ASCII marks as spaces: a word is what stands between them.
_PLAIN = bytearray(range(256))
for _byte in range(128):
    _letter = chr(_byte)
    _PLAIN[_byte] = ord(_letter.lower()) if _letter.isalnum() else 0x20
_PLAIN = bytes(_PLAIN)


def feature_rows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, one text after the other, and bounds."""
    cut = cut_words([text.translate(_PLAIN) for text in texts])
    number = np.repeat(np.arange(len(texts)), np.diff(cut.first))
    lengths = cut.ends - cut.starts
    owners, keys = [number], [mixed(cut.hashes)]
    padded = np.append(cut.data, np.zeros(8, np.uint8))
    for size in PREFIXES:
        longer = lengths > size
        value = np.full(int(longer.sum()), size, np.uint64)
        for step in range(size):
            value = value * np.uint64(256) + padded[cut.starts[longer] + step].astype(np.uint64)
        owners.append(number[longer])
        keys.append(mixed(value))
    owner = np.concatenate(owners).astype(np.uint64)
    slot = np.concatenate(keys) & np.uint64((1 << BITS) - 1)
    both = np.unique((owner << np.uint64(32)) | slot)
    bounds = np.searchsorted(both, np.arange(len(texts) + 1).astype(np.uint64) << np.uint64(32))
    return (both & np.uint64(0xFFFFFFFF)).astype(np.int64), bounds


def swapped(text: bytes, groups=IDENTITY_TERMS) -> bytes | None:
    """The text with each group name replaced by the next of its list; None if it has none."""
    following = {
        term.encode(): group[(at + 1) % len(group)].encode()
        for group in groups
        for at, term in enumerate(group)
    }
    words = text.translate(_PLAIN).split(b" ")
    if not any(word in following for word in words):
        return None
    return b" ".join(following.get(word, word) for word in words)


@dataclass
class Linear:
    """slots: feature numbers, ascending; weights: theirs; intercept."""

    slots: np.ndarray
    weights: np.ndarray
    intercept: float

    def probability(self, texts: list[bytes]) -> np.ndarray:
        features, bounds = feature_rows(texts)
        return 1 / (1 + np.exp(-self.log_odds(features, bounds)))

    def log_odds(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        value = np.zeros(1 << BITS)
        value[self.slots] = self.weights
        sums = np.concatenate([[0], np.cumsum(value[features])])
        return self.intercept + sums[bounds[1:]] - sums[bounds[:-1]]


def telling(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Features whose presence differs most between the labels (chi-squared), ascending."""
    of_text = np.repeat(labels, np.diff(bounds))
    texts = np.bincount(features, minlength=1 << BITS).astype(float)
    bad = np.bincount(features, of_text, 1 << BITS)
    share = labels.mean()
    expected = np.maximum(texts * share * (1 - share), 1e-9)
    score = np.where(texts >= LEAST_TEXTS, (bad - texts * share) ** 2 / expected, 0)
    best = np.argsort(-score, kind="stable")[:MOST_FEATURES]
    return np.sort(best[score[best] > 10.8])


def fit(
    features: np.ndarray,
    bounds: np.ndarray,
    labels: np.ndarray,
    pairs: list[tuple[np.ndarray, np.ndarray]],
    fairness: float = 4.0,
    ridge: float = 1e-4,
    steps: int = 400,
    rate: float = 0.1,
) -> Linear:
    """Logistic regression by gradient steps with momentum.

    ``pairs``: features of labelled texts that name a group, and of the same with names swapped.
    ``fairness`` weighs the mean squared difference of their log-odds.
    """
    share = labels.mean() if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Linear(np.empty(0, int), np.empty(0), float(np.log(share / (1 - share))))
    slots = telling(features, bounds, labels)
    where = np.full(1 << BITS, -1)
    where[slots] = np.arange(len(slots))
    column = where[features]
    row = np.repeat(np.arange(len(labels)), np.diff(bounds))[column >= 0]
    column = column[column >= 0]
    change_row, change_column, change = [], [], []
    for number, (before, after) in enumerate(pairs):
        for some, sign in ((before, -1.0), (after, 1.0)):
            own = where[some]
            own = own[own >= 0]
            change_row.append(np.full(len(own), number))
            change_column.append(own)
            change.append(np.full(len(own), sign))
    if pairs:
        change_row, change_column, change = map(np.concatenate, (change_row, change_column, change))
    weights, intercept = np.zeros(len(slots)), float(np.log(share / (1 - share)))
    first, second = np.zeros(len(slots) + 1), np.zeros(len(slots) + 1)
    for step in range(1, steps + 1):
        odds = intercept + np.bincount(row, weights[column], len(labels))
        error = 1 / (1 + np.exp(-odds)) - labels
        slope = np.bincount(column, error[row], len(slots)) / len(labels) + ridge * weights
        if pairs:
            moved = np.bincount(change_row, change * weights[change_column], len(pairs))
            pull = np.bincount(change_column, change * moved[change_row], len(slots))
            slope += 2 * fairness * pull / len(pairs)
        slope = np.append(slope, error.mean())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, intercept = weights - move[:-1], intercept - move[-1]
    return Linear(slots, weights, float(intercept))


def feature_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) -> label, features, features with group names swapped (null: none)."""
    for batch in batches:
        texts = utf8(batch.column(1))
        for first, last in batches_of(texts):
            some = texts[first:last]
            features, bounds = feature_rows(some)
            own = [features[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            other = [None if (text := swapped(one)) is None else feature_rows([text])[0] for one in some]
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(own, kind), pa.array(other, kind)],
                names=["label", "features", "other"],
            )


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", **names: str) -> Linear:
    """Fitted on a bounded sample of labelled rows that are not held out."""
    sample = training_rows(docs, labels, label, **names)
    table = sample.mapInArrow(
        feature_table, "label int, features array<int>, other array<int>"
    ).toArrow()
    column = table["features"].combine_chunks()
    features = column.flatten().to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(column).to_numpy())])
    pairs = []
    for at in np.flatnonzero(table["other"].is_valid().to_numpy()).tolist():
        other = np.array(table["other"][at].as_py(), np.int64)
        pairs.append((features[bounds[at] : bounds[at + 1]], other))
    return fit(features, bounds.astype(np.int64), table["label"].to_numpy().astype(float), pairs)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, doc_id=doc_id, text=text)
    return scored(docs, model.probability, threshold, doc_id, text)
