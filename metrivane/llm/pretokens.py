"""Pre-tokens of the word vocabulary, found with numpy for a whole buffer of texts at a time.

That tokenizer drops white space, lower-cases, and cuts words into runs of letters, single digits, runs of anything else
and a few endings behind an apostrophe.  ASCII and the Latin letters of two bytes are cut here by those rules.  A word
that holds any other byte is left whole, and so is one with the opening of a special token: the library cuts those.
"""

from __future__ import annotations

import numpy as np

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[0x30:0x3A] = DIGIT
_KIND[0x41:0x5B] = LETTER
_KIND[0x61:0x7B] = LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# the pattern of those rules (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the endings behind an apostrophe that the tokenizer's pattern names (fixed values): s t m d, and re ve ll
_ONE = np.zeros(256, bool)
_ONE[np.frombuffer(b"stmd", np.uint8)] = True
_TWO = tuple((x[0], x[1]) for x in (b"re", b"ve", b"ll"))


def applies(library) -> bool:
    """Whether a tokenizer has the word vocabulary's rules."""
    steps, cuts = repr(library.normalizer), repr(library.pre_tokenizer)
    return all(x in steps for x in ("NFC()", r'Regex("\s+")', "Lowercase()")) and PATTERN in cuts


def without_rules(library):
    """A tokenizer with the model of ``library`` for plain pre-tokens that white space separates: nothing is left for its pattern
    to cut and for NFC to compose.  It shares the model."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    own = Tokenizer(library.model)
    own.normalizer = normalizers.Lowercase()
    own.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), library.pre_tokenizer[1]])
    return own


def hard_places(data: np.ndarray) -> np.ndarray:
    """Places of the bytes that only the library can judge."""
    return np.flatnonzero(_kinds(data)[1])


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of every byte, and whether it is one that only the library can judge."""
    kind = _KIND[data]
    high = np.flatnonzero(data >= 0x80)
    hard = np.zeros(len(data), bool)
    if len(high):
        lead = data[high]
        after = data[np.minimum(high + 1, len(data) - 1)]
        # U+00C0 to U+027F are letters but for the signs of multiplication and division;
        # a dotted capital I becomes two characters in lower case
        latin = (lead >= 0xC3) & (lead <= 0xC9)
        latin &= ~((lead == 0xC3) & ((after == 0x97) | (after == 0xB7))) & ~((lead == 0xC4) & (after == 0xB0))
        hard[high] = True
        first = high[latin]
        hard[first] = False
        hard[first + 1] = False
        kind[first] = LETTER
        kind[first + 1] = LETTER
    opening = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))  # <|
    hard[opening] = True
    return kind, hard


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, folded): the pre-tokens of ``data`` and its bytes with A-Z in lower case.

    ``data`` is UTF-8 whose texts are separated by white space.  ``folded`` keeps the case of words left whole.
    """
    folded = _LOWER[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), folded
    kind, hard = _kinds(data)
    solid = kind != SPACE
    begin = np.empty(len(data) + 1, bool)  # a pre-token, or white space, begins here
    begin[0] = begin[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=begin[1:-1])
    begin[:-1] |= kind == DIGIT
    quote = np.flatnonzero(data == 0x27)
    quote = quote[quote + 1 < len(data)]
    quote = quote[begin[quote] & (kind[quote + 1] == LETTER)]
    one, two = folded[quote + 1], folded[np.minimum(quote + 2, len(data) - 1)]
    short = _ONE[one]
    long = np.zeros(len(quote), bool)
    for a, b in _TWO:
        long |= (one == a) & (two == b) & (quote + 2 < len(data))
    begin[quote[short | long] + 1] = False
    begin[quote[short] + 2] = True
    begin[quote[long] + 3] = True
    if hard.any():  # words left whole: no place within them begins anything
        word = np.zeros(len(data), np.int64)
        np.cumsum(solid[1:] != solid[:-1], out=word[1:])
        whole = np.zeros(int(word[-1]) + 1, bool)
        whole[word[np.flatnonzero(hard)]] = True
        inside = whole[word] & solid
        begin[1:-1] &= ~(inside[1:] & inside[:-1])
        folded = np.where(inside, data, folded)
    edges = np.flatnonzero(begin)
    keep = solid[edges[:-1]]
    return edges[:-1][keep], edges[1:][keep], folded
