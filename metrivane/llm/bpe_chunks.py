"""Byte-level BPE encoding with content-defined chunks, and decoding.

A rolling hash over the last bytes cuts texts into chunks, so equal passages are cut alike wherever they stand.
A chunk is encoded once per worker, whatever document it comes from.  A cut may fall into a
word, so the ids around every join are encoded again: a window that begins and ends at safe places, one
word further out than needed on both sides.  There it has to repeat the ids of both chunks; if it doesn't,
the whole text is encoded again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.llm import tokens
from metrivane.llm.common import ship, table, text_slices

SPAN = 16  # bytes that the rolling hash covers
MEAN = 1024  # mean bytes of a chunk, a power of two
APART = 5  # safe places between two cuts at least
KEPT = 48 << 20  # bytes of chunk texts that a worker keeps; beyond, it forgets them all
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def chunk_cuts(data: np.ndarray, safe: np.ndarray, begin: int, stop: int, marks: np.ndarray) -> list[int]:
    """Cuts within data[begin:stop]: marks of the rolling hash with APART safe places between them."""
    out, last = [], np.searchsorted(safe, begin, side="right")
    end = np.searchsorted(safe, stop)
    for x in marks[np.searchsorted(marks, begin + SPAN) : np.searchsorted(marks, stop)].tolist():
        i = np.searchsorted(safe, x)
        if i - last >= APART and end - i >= APART:
            out.append(x)
            last = i
    return out


def rolling_marks(data: np.ndarray) -> np.ndarray:
    """Places behind SPAN bytes whose hash has its low bits clear, at the start of a character."""
    if len(data) <= SPAN:
        return np.zeros(0, np.int64)
    at = np.arange(SPAN, len(data))
    hashes = tokens.span_hashes(data, at - SPAN, at)
    good = (hashes & np.uint64(MEAN - 1)) == 0
    return at[good & ((data[SPAN:] & 0xC0) != 0x80)]


class ChunkEncoder:
    """Ids of texts, chunk by chunk."""

    def __init__(self, path: str, ranks: str | None = None):
        self.units = tokens.encoder(path, ranks)
        self.bytes_of = id_bytes(path)
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.spelled = [str(i) for i in range(len(self.bytes_of))]
        self.chunks: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        self.kept = 0

    def learn(self, texts: Iterable[bytes]) -> dict[bytes, tuple[np.ndarray, np.ndarray]]:
        """(ids, byte places behind them) of each chunk; those not known yet are encoded."""
        if self.kept > KEPT:
            self.chunks, self.kept = {}, 0
        new = list(dict.fromkeys(t for t in texts if t not in self.chunks))
        flat, counts = self.units.encode(new)
        at = 0
        for text, n in zip(new, counts.tolist()):
            ids = flat[at : at + n].copy()
            at += n
            self.chunks[text] = ids, np.cumsum(self.sizes[ids])
            self.kept += len(text)
        return self.chunks

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        buffer = b"".join(texts)
        data = np.frombuffer(buffer, np.uint8)
        safe, marks = tokens.safe_cuts(data), rolling_marks(data)
        edges, begin = [], 0
        for t in texts:
            edges.append([begin, *chunk_cuts(data, safe, begin, begin + len(t), marks), begin + len(t)])
            begin += len(t)
        chunks = self.learn(buffer[a:b] for e in edges for a, b in zip(e, e[1:]) if b > a)
        joins = {}  # cut -> safe places: two before it, two from it on
        for e in edges:
            for x in e[1:-1]:
                i = np.searchsorted(safe, x)
                joins[x] = tuple(safe[i - 2 : i + 2].tolist())
        windows = list(dict.fromkeys(buffer[j[0] : j[3]] for j in joins.values()))
        found = dict(zip(windows, self.units.library_ids([w.decode() for w in windows])))
        return [self._assemble(buffer, e, chunks, joins, found) for e in edges]

    def _assemble(self, buffer, edges, chunks, joins, found) -> np.ndarray:
        out, begin = [], edges[0]
        if len(edges) == 2:
            return chunks[buffer[edges[0] : edges[1]]][0] if edges[1] > edges[0] else np.zeros(0, np.uint32)
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            ids, behind = chunks[buffer[a:b]]
            if k + 1 == len(edges) - 1:
                out.append(between(ids, behind, begin - a, b - a))
                break
            l2, l1, r1, r2 = joins[b]
            window = np.array(found[buffer[l2:r2]], np.uint32)
            places = np.cumsum(self.sizes[window])
            after, after_behind = chunks[buffer[b : edges[k + 2]]]
            pairs = (
                (between(window, places, 0, l1 - l2), between(ids, behind, l2 - a, l1 - a)),
                (between(window, places, r1 - l2, r2 - l2), between(after, after_behind, r1 - b, r2 - b)),
            )
            body, middle = between(ids, behind, begin - a, l1 - a), between(window, places, l1 - l2, r1 - l2)
            if body is None or middle is None or any(x is None or y is None or not np.array_equal(x, y) for x, y in pairs):
                text = buffer[edges[0] : edges[-1]].decode()
                return np.array(self.units.library.encode(text, add_special_tokens=False).ids, np.uint32)
            out += [body, middle]
            begin = r1
        return np.concatenate(out)


def between(ids: np.ndarray, behind: np.ndarray, start: int, end: int) -> np.ndarray | None:
    """The ids of the bytes from ``start`` to ``end``; None unless both are places between two ids."""
    i, j = np.searchsorted(behind, (start, end), side="right")
    if (start and (i == 0 or behind[i - 1] != start)) or (end and (j == 0 or behind[j - 1] != end)):
        return None
    return ids[i:j]


def id_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary.

    Printable characters of Latin-1 stand for the byte of that number, the characters from 256 on for the
    other bytes in order.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    out = [b""] * (max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(byte[c] for c in token if c in byte)
    for t in spec["added_tokens"]:
        out[t["id"]] = t["content"].encode()
    return out


def decode(ids: np.ndarray, bytes_of: list[bytes]) -> str:
    """As ``Tokenizer.decode(ids, skip_special_tokens=False)``."""
    return b"".join([bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace")


_encoders: dict[tuple, ChunkEncoder] = {}


def chunk_encoder(path: str, ranks: str | None) -> ChunkEncoder:
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = ChunkEncoder(path, ranks)
    return _encoders[path, ranks]


def encoded(path: str, ranks: str | None, render):
    """A mapInArrow function: doc_id and whatever ``render(encoder, ids)`` gives, a tuple for each row."""

    def run(batches):
        own = chunk_encoder(path, ranks)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                rows = [render(own, ids) for ids in own.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(rows)).cast(pa.int64()), *[pa.array(c) for c in zip(*rows)]],
                    names=["doc_id", *[f"c{i}" for i in range(len(rows[0]))]],
                )

    return run


def _digests(own: ChunkEncoder, ids: np.ndarray) -> tuple:
    spelled = ",".join([own.spelled[i] for i in ids.tolist()])
    decoded = decode(ids, own.bytes_of).encode()
    return len(ids), hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode_documents(docs: DataFrame, path: str, ranks: str | None = None) -> DataFrame:
    """doc_id, ids (array<int>) of every row; a null text is empty and has no ids.

    Repeated rows and null doc_ids give a row each; other columns play no part.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    found = rows.mapInArrow(encoded(path, ranks, lambda own, ids: (ids.astype(np.int32),)), "doc_id long, c0 array<int>")
    return found.withColumnRenamed("c0", "ids")


def digest_documents(docs: DataFrame, path: str, ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, decoded again, and both digested in one pass."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    found = rows.mapInArrow(encoded(path, ranks, _digests), "doc_id long, c0 long, c1 string, c2 string")
    return found.toDF("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_bpe_chunks(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return digest_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))
