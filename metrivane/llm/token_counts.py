"""Token counts by a map-side lookup in two tiers; no pre-token goes through a shuffle.

The first tier is a compact hash table of the lengths, in tokens, of frequent pre-tokens, which every task gets by broadcast; its size is
fixed.  The second is a cache of each worker.  What neither holds is encoded by the library, every different pre-token of a slice once.

The frequent ones come from a summary over all texts: a task counts its pre-tokens in at most KEPT counters (counters too many cost
every counter the largest count among those given up), summaries of WAYS tasks become one, again and again, until one is left.  It holds every
pre-token that is more than a KEPT-th of all.  Counts do not depend on what the table holds, only the time does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.llm import pretokens
from metrivane.llm.common import ship, table, text_slices
from metrivane.llm.tokens import LONGEST, span_hashes

LIMIT = 2048
KEPT = 8192  # counters of a summary
WAYS = 8  # summaries that are merged into one
LEVELS = 7  # times that this is done: enough for WAYS ** LEVELS tasks
BROADCAST_SLOTS = 16  # log2 of the slots of the broadcast table: 9 bytes each
WORKER_SLOTS = 21  # and of a worker's cache
SLICE = 1 << 20  # bytes worked on at a time
SUMMARY = "node long, keys binary, counts binary, pieces array<binary>"
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Lengths:
    """hash of a pre-token -> its number of tokens; a later entry takes the slot of an earlier one."""

    def __init__(self, log_slots: int):
        self.shift = np.uint64(64 - log_slots)
        self.keys = np.zeros(1 << log_slots, np.uint64)
        self.sizes = np.zeros(1 << log_slots, np.uint8)  # 0: a free slot

    def put(self, keys: np.ndarray, sizes: np.ndarray) -> None:
        fits = (sizes > 0) & (sizes < 256)
        at = (keys[fits] >> self.shift).astype(np.int64)
        self.keys[at], self.sizes[at] = keys[fits], sizes[fits]

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of tokens of each; 0 where it is not known."""
        at = (keys >> self.shift).astype(np.int64)
        return np.where(self.keys[at] == keys, self.sizes[at], 0)


class Counter:
    """Numbers of tokens of texts in the word vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.cache = Lengths(WORKER_SLOTS)

    def library_sizes(self, texts: list[str]) -> np.ndarray:
        return np.array([len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)], np.int64)

    def count(self, texts: list[bytes], frequent: Lengths) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for rows, buffer, edges in _groups(texts):
            data = np.frombuffer(buffer, np.uint8)
            starts, ends, folded = pretokens.spans(data)
            sizes = self._sizes(buffer, starts, ends, folded, frequent)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            np.add.at(out, rows, np.diff(upto[np.searchsorted(starts, edges)]))
        return out

    def _sizes(self, buffer, starts, ends, folded, frequent) -> np.ndarray:
        short = ends - starts <= LONGEST
        keys = span_hashes(folded, starts, ends)
        sizes = np.where(short, frequent.get(keys), 0).astype(np.int64)
        rest = np.flatnonzero((sizes == 0) & short)
        sizes[rest] = self.cache.get(keys[rest])
        rest = rest[sizes[rest] == 0]
        _, first, inverse = np.unique(keys[rest], return_index=True, return_inverse=True)
        long = np.flatnonzero(~short)  # a long one is encoded at each place, never by its hash
        which = np.concatenate([rest[first], long])
        if len(which):
            new = self.library_sizes([buffer[a:b].decode() for a, b in zip(starts[which].tolist(), ends[which].tolist())])
            sizes[rest] = new[: len(first)][inverse]
            sizes[long] = new[len(first) :]
            self.cache.put(keys[rest[first]], new[: len(first)])
        return sizes


def _parts(text: bytes):
    """A long text in parts that end at white space, where there is any."""
    begin = 0
    while len(text) - begin > 2 * SLICE:
        end = max(text.rfind(c, begin, begin + SLICE) for c in (b" ", b"\n"))
        end = end if end > begin else min((x for x in (text.find(c, begin + SLICE) for c in (b" ", b"\n")) if x > 0), default=-1)
        if end < 0:
            break
        yield text[begin:end]
        begin = end
    yield text[begin:]


def _groups(texts: list[bytes]):
    """(rows, buffer, edges): parts of texts joined with white space, of about SLICE bytes; the edges part them."""
    rows, group, size = [], [], 0
    for row, text in enumerate(texts):
        for part in _parts(text):
            rows.append(row)
            group.append(part)
            size += len(part) + 1
            if size >= SLICE:
                yield rows, b"\n".join([*group, b""]), np.concatenate([[0], np.cumsum([len(t) + 1 for t in group])])
                rows, group, size = [], [], 0
    if group:
        yield rows, b"\n".join([*group, b""]), np.concatenate([[0], np.cumsum([len(t) + 1 for t in group])])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this worker process."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


class Summary:
    """The most frequent pre-tokens in at most ``kept`` counters; summaries can be merged."""

    def __init__(self, kept: int = KEPT):
        self.kept = kept
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.pieces: dict[int, bytes] = {}

    def merge(self, keys: np.ndarray, counts: np.ndarray, piece) -> None:
        """Add the ``counts`` of different ``keys``; ``piece(i)`` gives the bytes of the i-th."""
        every, inverse = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([self.counts, counts])).astype(np.int64)
        if len(every) > self.kept:
            total -= np.partition(total, -self.kept - 1)[-self.kept - 1]
            every, total = every[total > 0], total[total > 0]
        at = np.searchsorted(every, keys)
        known = (at < len(every)) & (every[np.minimum(at, len(every) - 1)] == keys) if len(every) else np.zeros(len(keys), bool)
        fresh = {int(k): piece(i) for i, k in zip(np.flatnonzero(known).tolist(), keys[known].tolist()) if k not in self.pieces}
        self.keys, self.counts = every, total
        self.pieces = {k: self.pieces[k] if k in self.pieces else fresh[k] for k in every.tolist()}

    def row(self, node: int) -> pa.RecordBatch:
        columns = [[node], [self.keys.tobytes()], [self.counts.tobytes()], [[self.pieces[k] for k in self.keys.tolist()]]]
        types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "keys", "counts", "pieces"])


def _summarise(batches):
    summary = Summary()
    for batch in batches:
        for _, texts in text_slices(batch.column(0), SLICE):
            for _, buffer, _ in _groups(texts):
                starts, ends, folded = pretokens.spans(np.frombuffer(buffer, np.uint8))
                short = ends - starts <= LONGEST
                starts, ends = starts[short], ends[short]
                keys, first, counts = np.unique(span_hashes(folded, starts, ends), return_index=True, return_counts=True)
                begins, stops = starts[first].tolist(), ends[first].tolist()
                summary.merge(keys, counts, lambda i: buffer[begins[i] : stops[i]])
    if len(summary.keys):
        yield summary.row(TaskContext.get().partitionId())


def _merged(key, rows):
    summary = Summary()
    for keys, counts, pieces in zip(*(rows.column(c).to_pylist() for c in ("keys", "counts", "pieces"))):
        summary.merge(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64), pieces.__getitem__)
    return pa.Table.from_batches([summary.row(key[0].as_py())])


def frequent_pieces(docs: DataFrame) -> list[bytes]:
    """The frequent pre-tokens of all texts, rarest first: at most KEPT of at most LONGEST bytes."""
    ship(docs.sparkSession)
    found = docs.select(docs["text"]).mapInArrow(_summarise, SUMMARY)
    for _ in range(LEVELS):
        found = found.groupBy(F.floor(F.col("node") / WAYS).alias("up")).applyInArrow(_merged, SUMMARY)
    rows = found.collect()  # one row at most
    if not rows:
        return []
    order = np.argsort(np.frombuffer(rows[0]["counts"], np.int64), kind="stable")
    return [bytes(rows[0]["pieces"][i]) for i in order.tolist()]


def frequent_lengths(pieces: list[bytes], path: str) -> Lengths:
    """The table of ``pieces``, of which later ones take the slots of earlier ones."""
    out = Lengths(BROADCAST_SLOTS)
    if pieces:
        buffer = b"\n".join([*pieces, b""])
        data = np.frombuffer(buffer, np.uint8)
        starts, ends, folded = pretokens.spans(data)
        out.put(span_hashes(folded, starts, ends), counter(path).library_sizes([buffer[a:b].decode() for a, b in zip(starts, ends)]))
    return out


def _count_task(path: str, frequent, limit: int):
    def run(batches):
        own = counter(path)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                n = own.count(texts, frequent.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return run


def count_documents(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether n_tokens is over ``limit``, a row for each row of ``docs``.

    Counts are those of the tokenizers library without special tokens added; special tokens' strings within texts are special, as is its default.
    A null text is empty: 0 bytes, 0 tokens.  Null and repeated doc_ids keep their rows; other columns play no part; an empty table gives no
    rows.  A very long text is worked on in parts that end at white space; a word of any length is one part.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(frequent_pieces(docs), path))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(_count_task(path, frequent, limit), RESULT)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return count_documents(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))
