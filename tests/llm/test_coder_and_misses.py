"""The token files' coder at its edges, and how pre-tokens that the cache lacks reach the library."""

import io

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from metrivane.llm import token_files, tokens


@pytest.mark.parametrize("kind", ["same", "all different", "two by turns", "rare miss", "wide ids", "one"])
def test_blocks_round_trip_at_the_edges(kind):
    rng = np.random.default_rng(3)
    n = 300_000
    ids = {
        "same": np.full(n, 9),
        "all different": rng.permutation(n),
        "two by turns": np.tile([5, 70_000], n // 2),
        "rare miss": np.where(rng.random(n) < 1e-4, rng.integers(0, 50_000, n), np.arange(n) % 7),
        "wide ids": rng.integers(0, 2**32, n),
        "one": np.array([2]),
    }[kind].astype(np.uint32)
    assert np.array_equal(token_files.unpack_ids(io.BytesIO(token_files.pack_ids(ids))), ids)


def test_a_step_narrows_every_lane_once(monkeypatch):
    refills, ids = [], (np.random.default_rng(4).zipf(1.3, 200_000) % 40_000).astype(np.uint32)
    old = token_files.Coder.refill
    monkeypatch.setattr(token_files.Coder, "refill", lambda coder: (refills.append(coder.lanes), old(coder))[1])
    data = token_files.pack_ids(ids)
    lanes, steps = token_files.shape_of(len(ids))
    assert refills == [lanes] * steps  # hit, miss and order 0 in one interval, not one after the other
    assert np.array_equal(token_files.unpack_ids(io.BytesIO(data)), ids)
    assert refills == [lanes] * 2 * steps


def test_a_text_longer_than_a_block(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 1000)
    ids, stream = np.arange(2500, dtype=np.uint32) % 77, io.BytesIO()
    for at in range(0, len(ids), token_files.BLOCK):
        stream.write(token_files.pack_ids(ids[at : at + token_files.BLOCK]))
    stream.write(b"\0\0\0\0")
    stream.seek(0)
    parts = iter(lambda: token_files.unpack_ids(stream).tolist(), [])
    assert [x for part in parts for x in part] == ids.tolist()


def test_latin_pre_tokens_are_encoded_many_to_a_line(monkeypatch):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    letters = [chr(c) for c in range(0xC0, 0x280)]
    texts = [f"{c}ab x{c} Zu{c}{c}k {c}'s 7{c}" for c in letters] + ["Größe ÉTÉ niño's ŉa Ǆǅǆ", "a\x1cb \x7fé", "é́ é 日é <|é|> Å", "", "É" * 40]
    alone = []
    encoder = tokens.UnitEncoder(path, log_slots=12)
    old = encoder.library_ids
    monkeypatch.setattr(encoder, "library_ids", lambda some: alone.extend(some) or old(some))
    for _ in range(2):  # the second time from the cache
        flat, n = encoder.encode([t.encode() for t in texts])
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for w in want for i in w]
    hard = ("×", "÷", "İ", "́", "日", "<|", "Å")
    assert alone and all(any(x in t for x in hard) for t in alone)


def test_a_word_does_not_drive_another_from_its_place(monkeypatch):
    encoder = tokens.UnitEncoder(P.path("word_bpe_49k.json"), log_slots=4)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    at = np.arange(0, len(data), 3)
    keys = tokens.span_hashes(data, at, at + 3)
    first, second = (keys >> encoder.shift).astype(int), encoder.second(keys)
    two = next((i, j) for i in range(400) for j in range(i) if first[i] == first[j] != second[i] and first[i] != second[j])
    text, missed, old = " ".join(words[i] for i in two).encode(), [], encoder.word_ids
    monkeypatch.setattr(encoder, "word_ids", lambda data, starts, ends: (missed.append(len(starts)), old(data, starts, ends))[1])
    for word in [*text.split(), text]:
        flat, _ = encoder.encode([word])
        assert flat.tolist() == encoder.library.encode(word.decode(), add_special_tokens=False).ids
    assert missed == [1, 1, 0]
