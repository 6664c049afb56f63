"""Token ids of whole texts, by the tokenizers library, a distinct word at a time.

The vocabulary drops white space and splits before it merges, so a text's ids are its words' ids
one after the other. Each distinct word (by a 64-bit hash of its bytes, A to Z lower-cased) is
encoded once per worker and looked up afterwards; the ids are those of the whole text, at a small
part of the time. A text in which case matters (a special token's string, combining marks) is
encoded whole.
"""

import unicodedata

import numpy as np
from tokenizers import Tokenizer

from vitaelake.llm.wordarrays import LOWER, batches_of, cut_words

# Words remembered by one worker; beyond that it starts afresh, so its memory stays bounded.
KNOWN = 500_000
# Words for each of which a stem is remembered too.
STEM_SHARE = 5

_TAILS = frozenset(",.!?;:")


def ends_in_letter(word: str) -> bool:
    """Whether the word, composed and lower-cased as the tokenizer does it, ends in a letter.

    Some letters end in a combining mark then, which belongs to the marks that follow it.
    """
    last = word[-1]
    if last.isascii():
        return last.isalpha()
    return last.isalpha() and unicodedata.normalize("NFC", word).lower()[-1].isalpha()


class WordEncoder:
    """Encodes texts with the tokenizer file at ``path``, without special tokens."""

    def __init__(self, path: str, most: int = KNOWN):
        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.stems: dict[str, bytes] = {}  # ids as 32-bit integers
        self.letters: dict[str, str] = {}
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted hashes; place and size of their ids
        self.places = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word_ids(self, word: str) -> bytes:
        """Ids of a word: a final mark after a letter is a token of its own."""
        if len(word) > 1 and word[-1] in _TAILS and ends_in_letter(word[:-1]):
            return self.stem_ids(word[:-1]) + self.stem_ids(word[-1])
        return self.stem_ids(word)

    def stem_ids(self, stem: str) -> bytes:
        ids = self.stems.get(stem)
        if ids is None:
            if len(self.stems) >= self.most // STEM_SHARE:
                self.stems.clear()
            ids = self.stems[stem] = np.array(self._encode_stem(stem), np.int32).tobytes()
        return ids

    def _encode_stem(self, stem: str) -> list[int]:
        # A run of lower-case Latin-1 letters passes the normaliser and the splitter unchanged,
        # so only the byte-level alphabet and the merges are left to apply.
        if stem.isalpha() and max(stem) < "\u0100":
            stem = stem.lower()
            mapped = stem if stem.isascii() else "".join(map(self._byte_letters, stem))
            return [token.id for token in self.tokenizer.model.tokenize(mapped)]
        return self.whole(stem)

    def _byte_letters(self, letter: str) -> str:
        mapped = self.letters.get(letter)
        if mapped is None:
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter)
            mapped = self.letters[letter] = "".join(piece for piece, _ in pieces)
        return mapped

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Adds words whose hashes, ascending, are not known yet."""
        ids = [self.word_ids(word.decode()) for word in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        places = len(self.flat) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.places = np.insert(self.places, at, places)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), np.int32)])

    def encode_batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the texts (UTF-8), one after the other, and where each text's begin."""
        cut = cut_words([text.translate(LOWER) for text in texts])
        if len(self.known) > self.most:
            self._clear()
        hashes, first, number = np.unique(cut.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            self._learn(hashes[new], [cut.word(word) for word in first[new].tolist()])
            at = np.searchsorted(self.known, hashes)
        sizes = self.sizes[at][number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.places[at][number] - ends[:-1], sizes)
        flat = self.flat[places + np.arange(len(places))]
        return flat, ends[cut.first]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        rows: list[np.ndarray] = []
        for first, last in batches_of(texts):
            some = texts[first:last]
            # In these, case matters before words are encoded: special tokens, combining marks.
            special = [b"<|" in text or b"\xcc" in text for text in some]
            flat, bounds = self.encode_batch(
                [b"" if odd else text for text, odd in zip(some, special)]
            )
            for number, odd in enumerate(special):
                if odd:
                    rows.append(np.array(self.whole(some[number].decode()), np.int32))
                else:
                    rows.append(flat[bounds[number] : bounds[number + 1]])
        return rows


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, most: int = KNOWN) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    if (path, most) not in _encoders:
        _encoders[path, most] = WordEncoder(path, most)
    return _encoders[path, most]


def document_ids(path: str, texts: list[bytes], end_id: int, most: int = KNOWN) -> list[np.ndarray]:
    """The ids of each document (UTF-8) and the end id."""
    return [np.append(ids, np.int32(end_id)) for ids in encoder(path, most).encode(texts)]
