"""Token ids word by word are those of the whole text."""

import unicodedata

import public_tokenizers
import pytest

from vitaelake.llm.tokens import WordEncoder

CODE_POINTS = [chr(code) for code in range(1, 0x110000) if not 0xD800 <= code < 0xE000]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(public_tokenizers.path("word_bpe_49k.json"))


def wrong(encoder, texts, size=50_000):
    """Texts whose ids differ from the library's."""
    found = []
    for first in range(0, len(texts), size):
        some = texts[first : first + size]
        whole = encoder.tokenizer.encode_batch(some, add_special_tokens=False)
        mine = encoder.encode([text.encode() for text in some])
        found += [text for text, a, b in zip(some, whole, mine) if a.ids != b.tolist()]
    return found


def test_every_letter_before_every_final_mark(encoder):
    letters = [letter for letter in CODE_POINTS if letter.isalpha()]
    assert wrong(encoder, [letter + tail for letter in letters for tail in ",.!?;:"]) == []


def test_every_character_at_the_edges_of_words(encoder):
    assigned = [char for char in CODE_POINTS if unicodedata.category(char) not in ("Cn", "Co")]
    assert wrong(encoder, [f"Ab{char} {char}cd. I{char}. e {char}, x" for char in assigned]) == []


def test_words_that_end_in_a_composed_letter(encoder):
    texts = ["İ.", "TÜRKİ.", "BELEDİYESİ,", "ड़,", "ড়?", "İ.", "á, b"]
    assert wrong(encoder, texts) == []
