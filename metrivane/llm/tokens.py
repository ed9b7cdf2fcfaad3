"""Token ids of many texts: the tokenizers library behind a bounded cache of whole words.

A unit is a run of white space with the word behind it.  No pre-token of the tokenizers used here reaches from a
visible character over the white space that follows it, and none depends on what stands before such
a place, so the ids of a text are the ids of its units in a row.  Units are found, hashed and looked up
with numpy; the library encodes those that the cache lacks.
"""

from __future__ import annotations

import base64
import os
from itertools import chain

import numpy as np

from metrivane.llm import pretokens

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LONGEST = 64  # bytes of a unit that may be cached; the hash of so few bytes has no built collisions
WIDTH = 8  # ids of a cached unit at most
LINE = 256  # pre-tokens that are encoded together
PIECE = 1 << 18  # bytes worked on at a time: what a processor's cache holds

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True  # two-byte characters from U+00C0 on: none is white space
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; short texts use those made for a long one."""
    size = 1 << max(12, int(n).bit_length())
    size = max([x for x in _powers if size <= x <= 8 * PIECE], default=size)
    if size not in _powers:
        _powers.clear()
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers[size] = tuple(both)
    return _powers[size]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def hash_sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``sum_hashes`` takes the hash of any span of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def sum_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    spans = (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]
    return mixed(spans ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span."""
    return sum_hashes(hash_sums(data), starts, ends)


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places of white space right behind a visible character: a tokenizer always starts anew there."""
    cut = _SPACE[data]
    if len(data):
        cut[0] = False
        before = _VISIBLE[data[:-1]]
        before[1:] |= (data[1:-1] >= 0x80) & (data[1:-1] < 0xC0) & _LEAD[data[:-2]]
        cut[1:] &= before
    return np.flatnonzero(cut)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the spans, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def byte_pair_encoder(ranks: str):
    """str -> ids for the byte-level vocabulary in a rank file; special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary


class UnitEncoder:
    """Encodes lists of texts (bytes in UTF-8) as ``Tokenizer.encode(text, add_special_tokens=False)``.

    For the word vocabulary the units are its pre-tokens in lower case, so that a word is known whatever stands around it.
    """

    def __init__(self, path: str, ranks: str | None = None, log_slots: int = 21):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.shift = np.uint64(64 - log_slots)
        self.keys = np.zeros(1 << log_slots, np.uint64)
        self.sizes = np.zeros(1 << log_slots, np.uint8)  # 0: a free slot
        self.kept = np.zeros((1 << log_slots, WIDTH), np.uint16 if self.library.get_vocab_size() <= 65536 else np.uint32)

        self.quick = byte_pair_encoder(ranks) if ranks else None
        self.words = pretokens.applies(self.library)
        if self.words:
            self.plain = pretokens.without_rules(self.library)
            # an id that ends a pre-token has the mark of it
            self.last = np.array([self.library.id_to_token(i).endswith("</w>") for i in range(self.library.get_vocab_size())])

    def second(self, keys: np.ndarray) -> np.ndarray:
        return (keys & np.uint64(len(self.keys) - 1)).astype(np.int64)

    def library_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text.  With ``ranks``, plain words without a special token's bracket go through the
        quicker library that reads the same vocabulary as ranks."""
        if self.quick is None:
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        out = [self.quick(t) if t.isascii() and "<" not in t else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def unit_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the units in a row and their numbers."""
        found = self.library_ids(texts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def word_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pre-tokens of folded ``data``, each with white space behind it; plain ones are encoded many to a line."""
        lengths = ends - starts + 1
        bounds = np.cumsum(lengths)
        text = data[ragged(starts, lengths)]
        text[bounds - 1] = 0x20
        plain = np.ones(len(starts), bool)
        plain[np.searchsorted(bounds, pretokens.hard_places(text), "right")] = False
        own = text if plain.all() else text[np.repeat(plain, lengths)]
        breaks = np.cumsum(lengths[plain])[LINE - 1 :: LINE] - 1
        own[breaks] = 0x0A
        found = self.plain.encode_batch_fast(own[:-1].tobytes().decode().split("\n"), add_special_tokens=False)
        lists = [e.ids for e in found]
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))
        stops = np.flatnonzero(self.last[ids]) + 1
        if len(stops) != int(plain.sum()):  # never, by the tokenizer's rules
            plain[:] = False
            ids, stops = ids[:0], stops[:0]
        other = np.flatnonzero(~plain)
        rest, rest_sizes = self.unit_ids([data[a:b].tobytes().decode() for a, b in zip(starts[other].tolist(), ends[other].tolist())])
        sizes, begins = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        sizes[plain], sizes[other] = np.diff(stops, prepend=0), rest_sizes
        if not len(other):
            return ids, sizes
        begins[plain] = stops - sizes[plain]
        begins[other] = len(ids) + np.cumsum(rest_sizes) - rest_sizes
        return np.concatenate([ids, rest])[ragged(begins, sizes)], sizes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32) and the number of ids of each text."""
        counts = np.zeros(len(texts), np.int64)
        done, group, rows, size = [], [], [], 0

        def flush():
            nonlocal group, rows, size
            if group:
                ids, n = self._encode(group)
                done.append(ids)
                np.add.at(counts, rows, n)
            group, rows, size = [], [], 0

        for row, text in enumerate(texts):
            for part in self._parts(text):
                group.append(part)
                rows.append(row)
                size += len(part)
                if size >= PIECE:
                    flush()
        flush()
        return (np.concatenate(done) if done else np.zeros(0, np.uint32)), counts

    def _parts(self, text: bytes):
        """A very long text in parts that end at safe cuts."""
        if len(text) <= PIECE:
            yield text
            return
        cuts = safe_cuts(np.frombuffer(text, np.uint8))
        begin = 0
        while len(text) - begin > PIECE:
            i = np.searchsorted(cuts, begin + PIECE // 2)
            if i == len(cuts):
                break
            yield text[begin : cuts[i]]
            begin = int(cuts[i])
        yield text[begin:]

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        buffer = b"".join([t + b"\n" for t in texts] if self.words else texts)
        data = np.frombuffer(buffer, np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) + self.words for t in texts])])
        starts, ends, folded = pretokens.spans(data) if self.words else units(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        keys = span_hashes(folded, starts, ends)
        slots = (keys >> self.shift).astype(np.int64)
        brief = ends - starts <= LONGEST
        sizes = self.sizes.take(slots).astype(np.int64)
        hit = (self.keys.take(slots) == keys) & (sizes > 0) & brief
        other = np.flatnonzero(~hit)  # in their second place, or not known
        slots[other] = at = self.second(keys[other])
        sizes[other] = self.sizes[at]
        hit[other] = (self.keys[at] == keys[other]) & (sizes[other] > 0) & brief[other]
        miss = np.flatnonzero(~hit)
        long = ~brief[miss]
        _, first, inverse = np.unique(keys[miss[~long]], return_index=True, return_inverse=True)
        named = np.empty(len(miss), np.int64)
        named[~long] = inverse
        named[long] = len(first) + np.arange(long.sum())  # a long unit is encoded at each place, never by its hash
        inverse, which = named, np.concatenate([miss[~long][first], miss[long]])
        if self.words:
            flat, new_sizes = self.word_ids(folded, starts[which], ends[which])
        else:
            flat, new_sizes = self.unit_ids([buffer[a:b].decode() for a, b in zip(starts[which].tolist(), ends[which].tolist())])
        new_starts = np.cumsum(new_sizes) - new_sizes
        sizes[miss] = 0
        kept = self.kept.ravel().take(ragged(slots * WIDTH, sizes))  # of the known units in a row
        sizes[miss] = new_sizes[inverse]
        if len(miss):
            out = np.empty(int(sizes.sum()), np.uint32)
            fresh = np.repeat(~hit, sizes)
            out[~fresh] = kept
            out[fresh] = flat[ragged(new_starts[inverse], new_sizes[inverse])]
        else:
            out = kept.astype(np.uint32)
        # keep what is short enough, in its first place if that is free; in its second it takes the place of an earlier one
        keep = np.flatnonzero((new_sizes > 0) & (new_sizes <= WIDTH) & brief[which])
        at = (keys[which[keep]] >> self.shift).astype(np.int64)
        at = np.where(self.sizes[at] == 0, at, slots[which[keep]])
        self.keys[at], self.sizes[at] = keys[which[keep]], new_sizes[keep]
        padded = np.zeros((len(keep), WIDTH), self.kept.dtype)
        for j in range(WIDTH):
            has = new_sizes[keep] > j
            padded[has, j] = flat[new_starts[keep[has]] + j]
        self.kept[at] = padded
        per_unit = np.concatenate([[0], np.cumsum(sizes)])
        edge = np.searchsorted(starts, offsets)
        return out, np.diff(per_unit[edge])


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, data): white space with the word behind it, for texts that begin at the ``offsets``."""
    begins = np.zeros(len(data), bool)
    begins[safe_cuts(data)] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], len(data))[: len(starts)], data


_encoders: dict[tuple, UnitEncoder] = {}


def encoder(path: str, ranks: str | None = None) -> UnitEncoder:
    """The encoder of this worker process for one tokenizer file."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = UnitEncoder(path, ranks)
    return _encoders[path, ranks]
