"""Words of many texts as numpy arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09`` to ``\\x0D``; those bytes never occur
inside a UTF-8 character, so texts are cut and hashed as bytes, without decoding them. A word's
hash is a polynomial over random 64-bit byte values, modulo 2**64, then mixed.
"""

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

# Texts hashed at a time; one longer text is hashed alone.
BATCH_BYTES = 512 << 10

_random = np.random.default_rng(20240524)
_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[SPACES] = 0
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def power_table(base: int, size: int) -> np.ndarray:
    """Powers of base modulo 2**64, kept for the worker's life."""
    table = _powers.get(base)
    if table is None or len(table) < size:
        steps = np.full(max(size, BATCH_BYTES + 1), base, np.uint64)
        steps[0] = 1
        table = _powers[base] = np.cumprod(steps)
    return table


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """data: the joined bytes. starts, ends, hashes: of every word. first: the number of each
    text's first word, and the count of all. origin: where each text starts in data."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    origin: np.ndarray

    def word(self, number: int) -> bytes:
        return self.data[self.starts[number] : self.ends[number]].tobytes()


def cut_words(texts: list[bytes]) -> Words:
    joined = b"\n" + b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    origin = np.concatenate([[1], 1 + np.cumsum(sizes)])
    space = SPACES[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    if len(starts):
        up = power_table(_BASE, len(data))
        down = power_table(_UNBASE, len(data))
        sums = np.add.reduceat(_VALUES[data] * up[: len(data)], starts)
        hashes = mixed(sums * down[starts])
    else:
        hashes = np.empty(0, np.uint64)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, origin), origin)


def batches_of(texts: list[bytes], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are cut together: of about ``most`` bytes, or one longer text."""
    first, size = 0, 0
    for number, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, number
            first, size = number, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def pieces(batches, rows: int = 512):
    """Record batches in parts of few rows, so that few texts are copied out of a batch at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def utf8(values, fold: bool = False) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty; ``fold`` lower-cases A to Z."""
    raw = [b"" if text is None else text for text in values.cast("binary").to_pylist()]
    return [text.translate(LOWER) for text in raw] if fold else raw
