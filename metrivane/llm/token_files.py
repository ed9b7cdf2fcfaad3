"""Token files: ids under an adaptive context-mixing range coder.

A block of ids is cut into lanes that are coded side by side: step t codes the t-th id of every lane, and what it learns
serves all lanes from step t + 1 on.  An id is predicted by the id that last followed the two ids before it (order 2)
and the one before it (order 1).  Whether a prediction holds has a probability that mixes, in the logistic domain and
with weights that adapt, what both orders have been worth so far; what neither predicts is coded by the adaptive
frequencies of the block's ids (order 0).  Blocks are independent: each starts with fresh models and has its length,
its alphabet and its checksum, so a reader can start at any.  All arithmetic is on integers.

File: magic, blocks, a zero, table of documents, trailer.  A block has its numbers of ids, lanes and different ids, its
CRC-32 and the sizes of what follows: the different ids, the words of every lane, the lanes' words.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrivane.llm.common import shared_folder, ship, stored, table, text_slices
from metrivane.llm.tokens import encoder

MAGIC = b"MVTOK3\r\n"
HEAD = struct.Struct("<6I")
BLOCK = 1 << 21  # ids of a block
LANES = 8192  # lanes of a block at most
STEPS = 256  # ids of a lane at least, where the block has them
SLOT_BITS = 18  # a block tells 2^18 contexts of order 2 apart
SURE = 7  # confidence of a prediction at most
END = 2
LEAST, WORD, LOW, DIGIT = 1 << 32, 16, (1 << 32) - 1, (1 << 16) - 1
REST = 64  # of 65,536: frequency of a miss at least; so a step can go on to order 0 in the same interval
_sure = np.arange(SURE + 1)
_CHANGE = np.concatenate([np.where(_sure > 1, -(_sure + 1 >> 1), 0), _sure < SURE]).astype(np.int32)  # wrong, right
_P = np.clip(np.arange(4096), 1, 4095) / 4096
_STRETCH = np.round(256 * np.log(_P / (1 - _P))).astype(np.int64)
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2048, 2048) / 256.0))), 16, 4080).astype(np.int64)


def _between(x: np.ndarray, least: int, most: int) -> np.ndarray:
    return np.minimum(np.maximum(x, least), most)


class BadFile(ValueError):
    """A token file that breaks the format."""


class Coder:
    """Range coders of many lanes with an interval of 48 bits and words of 16.

    The encoder keeps a carry in the 17th bit of a word and hands it on at the end.
    """

    def __init__(self, lanes: int, steps: int, words: np.ndarray | None = None):
        self.lanes, self.decoding = lanes, words is not None
        self.room = 2 * steps + 4  # a step gives two words at most
        self.words = np.zeros(self.room * lanes, np.int32) if words is None else words.ravel()
        self.range = np.full(lanes, 1 << 48, np.int64)
        self.low = np.zeros(lanes, np.int64)  # decoding: the code's distance from it
        self.at = np.arange(lanes)  # place of the next word; those of a lane are ``lanes`` apart
        if self.decoding:
            for _ in range(3):
                self.low = (self.low << WORD) | self.words[self.at]
                self.at += lanes

    def refill(self):
        """Words out or in until every lane's interval is wide enough again."""
        short = np.flatnonzero(self.range < LEAST)
        while len(short):
            at, low, width = self.at[short], self.low[short], self.range[short] << WORD
            if self.decoding:
                low = (low << WORD) | self.words[at]
            else:
                self.words[at] = low >> 32
                low = (low & LOW) << WORD
            self.at[short], self.low[short], self.range[short] = at + self.lanes, low, width
            short = short[width < LEAST]

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """(words of every lane, all words lane by lane)."""
        self.words[self.at] = (self.low + LOW) >> 32
        words, counts = self.words.reshape(self.room, self.lanes), self.at // self.lanes + 1
        words = words[: counts.max()]
        for j in range(len(words) - 1, 0, -1):
            words[j - 1] += words[j] >> WORD
            words[j] &= DIGIT
        return counts, np.ascontiguousarray(words.T)[np.arange(len(words)) < counts[:, None]]


class Frequencies:
    """Order 0: adaptive frequencies of the symbols that no context has predicted."""

    def __init__(self, symbols: int, decoding: bool):
        self.bits = min(22, max(16, symbols.bit_length() + 4))
        self.count, self.decoding = np.ones(symbols, np.int64), decoding
        self.refresh()

    def learn(self, symbols: np.ndarray):
        self.count += 16 * np.bincount(symbols, minlength=len(self.count))

    def refresh(self):
        size = 1 + self.count * ((1 << self.bits) - len(self.count)) // int(self.count.sum())
        size[np.argmax(size)] += (1 << self.bits) - int(size.sum())
        self.size, self.begin = size, np.cumsum(size) - size
        if self.decoding:
            self.symbol = np.repeat(np.arange(len(size), dtype=np.int32), size)


class Mixer:
    """Frequencies, of 65,536, of a hit of order 2 and of one of order 1, for every state of the two predictions.

    A state is the confidence of order 2, that of order 1, and whether both predict the same id.
    """

    def __init__(self):
        kinds = SURE + 1
        # what is counted: by the confidence of order 2, by that of order 1 and sameness, and by that of order 1 after a miss
        self.tried = np.full(4 * kinds, 2, np.int64)
        self.held = np.ones(4 * kinds, np.int64)
        self.weight = np.full((2, 2), 1 << 15, np.int64)  # order, whether both predict the same
        self.shape = kinds, kinds, 2
        self.mix()

    def mix(self):
        kinds = self.shape[0]
        share = _between((self.held << 12) // self.tried, 1, 4095)
        after = _between(share[3 * kinds :], 16, 4080)
        self.two, self.one = _STRETCH[share[:kinds]], _STRETCH[share[kinds : 3 * kinds]].reshape(kinds, 2)
        both = (self.weight[0] * self.two[:, None, None] + self.weight[1] * self.one) >> 16
        self.p = _SQUASH[_between(both, -2048, 2047) + 2048]
        first = self.p << 4
        second = np.minimum(((65536 - first) * after[:, None]) >> 12, 65536 - REST - first)
        second[:, :, 1] = 0
        first, second = first.ravel(), second.ravel()
        self.begin = np.concatenate([first + second, np.zeros_like(first), first])  # of a miss, order 2, order 1
        self.size = np.concatenate([65536 - first - second, first, second])

    def learn(self, cases: np.ndarray):
        """The states of a step, in the first third where both orders missed, in the second where order 2 was right, else in the last."""
        miss, hit, other = np.bincount(cases, minlength=3 * self.p.size).reshape(3, *self.shape)
        some = miss + other
        error = (hit << 12) - (some + hit) * self.p
        slope = np.stack([self.two @ error.sum(1), (self.one * error.sum(0)).sum(0)])
        self.weight = _between(self.weight + (slope // len(cases) >> 4), -(1 << 18), 1 << 18)
        all_one, hit_one, other_one = (some + hit).sum(0), hit.sum(0), other.sum(0)
        tried = np.concatenate([(some + hit).sum((1, 2)), all_one.ravel(), all_one[:, 0] - hit_one[:, 0]])
        held = np.concatenate([hit.sum((1, 2)), (hit_one + other_one).ravel(), other_one[:, 0]])
        self.tried += tried - (self.tried - 2 >> 3)
        self.held += held - (self.held - 1 >> 3)
        self.mix()


def _learned(table: np.ndarray, places: np.ndarray, entry: np.ndarray, sure: np.ndarray, right: np.ndarray, fresh: np.ndarray):
    """Entries are the predicted symbol and its confidence; of lanes at one place the last one's entry stays."""
    kind = sure + (right.view(np.int8) << 3)
    now = entry + _CHANGE.take(kind)
    np.copyto(now, fresh, where=kind < 2)
    table[places] = now


def code_steps(coder: Coder, symbols: int, steps: int, rows: np.ndarray | None) -> np.ndarray:
    """Code the symbols (a row for every step); with ``rows`` None they are decoded and returned."""
    lanes = coder.lanes
    out = np.zeros((steps, lanes), np.int32) if rows is None else rows
    after_two, after_one = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(symbols, np.int32)
    mixer, zero = Mixer(), Frequencies(symbols, rows is None)
    states = mixer.p.size
    value, one = np.zeros(lanes, np.int32), np.zeros(lanes, np.int64)
    before = np.zeros(lanes, np.uint32)  # what the id before the last one adds to a place
    for t in range(steps):
        last = value.view(np.uint32)
        place = (last * np.uint32(0x9E3779B1) + before >> np.uint32(32 - SLOT_BITS)).astype(np.int64)
        e2, e1 = after_two.take(place), after_one.take(one)
        g2, g1 = e2 >> 3, e1 >> 3
        c2, c1 = (e2 & SURE).astype(np.int8), (e1 & SURE).astype(np.int8)
        state = (c2 << 4) + (c1 << 1) + (g1 == g2).view(np.int8)  # below 128
        case, part = state.astype(np.int64), coder.range >> 16
        if rows is None:
            miss = coder.low >= part * mixer.begin.take(case)
            hit2 = coder.low < part * mixer.size.take(case + states)
            hit1 = ~(hit2 | miss)
            value = np.where(hit2, g2, g1)
        else:
            value = rows[t]
            hit2, hit1 = g2 == value, g1 == value
            miss = ~(hit2 | hit1)
        case += np.where(hit2, np.int8(1), hit1.view(np.int8) << 1) * np.int64(states)
        begin, size = part * mixer.begin.take(case), part * mixer.size.take(case)
        low = coder.low - begin if rows is None else coder.low + begin
        rest = np.flatnonzero(miss)
        if len(rest):
            part = size.take(rest) >> zero.bits
            if rows is None:  # a double holds numbers of 48 bits, and their quotient's whole part is right
                there = (low.take(rest) / part).astype(np.int64)
                own = zero.symbol.take(np.minimum(there, len(zero.symbol) - 1))
                value[rest] = own
                low[rest] -= part * zero.begin.take(own)
            else:
                own = value.take(rest)
                low[rest] += part * zero.begin.take(own)
            size[rest] = part * zero.size.take(own)
            zero.learn(own)
        coder.low, coder.range = low, size
        coder.refill()
        if rows is None:
            out[t] = value
            hit2, hit1 = g2 == value, g1 == value
        if t % 16 == 0 or t in (1, 2, 4, 8):
            zero.refresh()
        mixer.learn(case)
        fresh = value << 3
        _learned(after_two, place, e2, c2, hit2, fresh)
        _learned(after_one, one, e1, c1, hit1, fresh)
        before, one = last * np.uint32(0x85EBCA6B), value.astype(np.int64)
    return out


def shape_of(n: int) -> tuple[int, int]:
    """(lanes, steps) of a block of ``n`` ids."""
    lanes = min(LANES, -(-n // STEPS))
    return lanes, -(-n // lanes)


def alphabet_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different ids, the place of every id among them); ids of a usual vocabulary are not sorted."""
    if int(ids.max()) > max(len(ids), 1 << 16):
        return np.unique(ids, return_inverse=True)
    places = ids.astype(np.int64)
    seen = np.zeros(int(ids.max()) + 1, np.int32)
    seen[places] = 1
    alphabet = np.flatnonzero(seen)
    seen[alphabet] = np.arange(len(alphabet))
    return alphabet.astype(ids.dtype), seen.take(places)


def pack_ids(ids: np.ndarray) -> bytes:
    """A block of ids, at least one."""
    alphabet, symbols = alphabet_of(ids)
    lanes, steps = shape_of(len(ids))
    rows = np.zeros(lanes * steps, np.int32)
    rows[: len(ids)] = symbols
    coder = Coder(lanes, steps)
    code_steps(coder, len(alphabet), steps, np.ascontiguousarray(rows.reshape(lanes, steps).T))
    counts, words = coder.finish()
    known = zlib.compress(np.diff(alphabet.astype(np.int64), prepend=0).astype("<u4").tobytes())
    data = words.astype("<u2").tobytes()
    sizes = zlib.compress(counts.astype("<u4").tobytes())
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return HEAD.pack(len(ids), len(alphabet), crc, len(known), len(sizes), len(data)) + known + sizes + data


def block_head(stream) -> tuple | None:
    """The numbers before the next block; None at the end of the blocks."""
    first = stream.read(4)
    if first == b"\0\0\0\0":
        return None
    head = first + stream.read(HEAD.size - 4)
    if len(head) != HEAD.size:
        raise BadFile("the file ends within a block")
    return HEAD.unpack(head)


def _numbers(data: bytes, n: int) -> np.ndarray:
    try:
        out = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
    except (zlib.error, ValueError) as e:
        raise BadFile("a block's table is broken") from e
    if len(out) != n:
        raise BadFile("a block's table has another length")
    return out


def unpack_ids(stream) -> np.ndarray:
    """The ids of the next block; none at the end of the blocks."""
    head = block_head(stream)
    if head is None:
        return np.zeros(0, np.uint32)
    n, symbols, crc, *sizes = head
    known, counts, data = (stream.read(size) for size in sizes)
    if [len(known), len(counts), len(data)] != sizes:
        raise BadFile("the file ends within a block")
    if n > BLOCK or not 0 < symbols <= n:
        raise BadFile("a block's numbers are out of bounds")
    lanes, steps = shape_of(n)
    alphabet, counts = np.cumsum(_numbers(known, symbols)), _numbers(counts, lanes)
    room = 2 * steps + 4
    if int(counts.max()) > room or int(counts.sum()) * 2 != len(data):
        raise BadFile("a block's words differ from its table")
    own = np.zeros((lanes, int(counts.max())), np.uint16)
    own[np.arange(own.shape[1]) < counts[:, None]] = np.frombuffer(data, "<u2")
    words = np.zeros((room, lanes), np.uint16)
    words[: own.shape[1]] = own.T
    coder = Coder(lanes, steps, words)
    ids = alphabet.astype("<u4").take(code_steps(coder, symbols, steps, None).T.ravel()[:n])
    if zlib.crc32(ids.tobytes()) != crc:
        raise BadFile("a block's checksum differs")
    return ids


def write_task(folder: str, path: str, end: int):
    def run(batches):
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/part-{part:06d}.ids"
        own, waiting, size, docs, counts, total = f"{name}.{uuid.uuid4().hex}", [], 0, [], [], 0
        with store.open_output_stream(own, compression=None) as out:
            out.write(MAGIC)

            def flush(least):
                nonlocal waiting, size
                ids = np.concatenate(waiting) if waiting else np.zeros(0, np.uint32)
                while len(ids) >= max(least, 1):
                    out.write(pack_ids(ids[: BLOCK]))
                    ids = ids[BLOCK :]
                waiting, size = [ids], len(ids)

            for batch in batches:
                for first, texts in text_slices(batch.column(1)):
                    flat, n = encode(texts)
                    waiting.append(np.insert(flat, np.cumsum(n), np.uint32(end)))
                    counts.append(n + 1)
                    docs += batch.column(0).slice(first, len(texts)).to_pylist()
                    size += len(waiting[-1])
                    total += len(waiting[-1])
                    if size >= BLOCK:
                        flush(BLOCK)
            flush(1)
            out.write(struct.pack("<I", 0))
            ids = np.array([0 if d is None else d for d in docs], "<i8").tobytes()
            none = np.array([d is None for d in docs], np.uint8).tobytes()
            body = zlib.compress(ids + none + np.concatenate([*counts, np.zeros(0, np.int64)]).astype("<u8").tobytes())
            out.write(struct.pack("<QQI", len(docs), len(body), zlib.crc32(body)) + body)
        if docs:
            store.move(own, name)
            yield pa.RecordBatch.from_pydict({"path": [name], "part": [part], "ids": [total]})
        else:
            store.delete_file(own)

    return run


def write(docs: DataFrame, folder: str, path: str, end: int = END) -> DataFrame:
    """Write the ids of ``docs`` in ascending order of doc_id to files in ``folder``; path, part, ids of each.

    A null text is empty and has the end id alone.  Null doc_ids come first; repeated doc_ids follow each other.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    return stored(ordered.mapInArrow(write_task(folder, path, end), "path string, part long, ids long"), "token-files")


def documents_of(stream_of) -> tuple[list, np.ndarray]:
    """(doc_ids, counts) from the table behind the blocks; ``stream_of`` stands there."""
    head = stream_of.read(20)
    if len(head) != 20:
        raise BadFile("no table of documents")
    n, size, crc = struct.unpack("<QQI", head)
    body = stream_of.read(size)
    if zlib.crc32(body) != crc:
        raise BadFile("the checksum of the table of documents differs")
    raw = zlib.decompress(body)
    none = np.frombuffer(raw[8 * n : 9 * n], np.uint8)
    ids = [None if x else int(d) for d, x in zip(np.frombuffer(raw[: 8 * n], "<i8"), none)]
    return ids, np.frombuffer(raw[9 * n :], "<u8").astype(np.int64)


def skip_blocks(stream) -> None:
    while (head := block_head(stream)) is not None:
        stream.seek(sum(head[3:]), 1)


def read_task(folder: str, render, schema):
    """``render(doc_id, start, ids)`` gives a row for each document of a file; blocks are decoded one at a time."""

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as f:
                    if f.read(len(MAGIC)) != MAGIC:
                        raise BadFile("not a token file")
                    skip_blocks(f)
                    docs, counts = documents_of(f)
                with store.open_input_stream(path, compression=None) as f:
                    f.read(len(MAGIC))
                    have, rows = np.zeros(0, np.uint32), []
                    for doc, n in zip(docs, counts.tolist()):
                        while len(have) < n:
                            more = unpack_ids(f)
                            if not len(more):
                                raise BadFile("fewer ids than the documents have")
                            have = np.concatenate([have, more])
                        rows.append(render(doc, start, have[:n]))
                        have, start = have[n:], start + n
                        if len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return run


def _digest(doc, start, ids):
    return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def read(files: DataFrame, folder: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, or with ``ids`` the ids, of every document in the files.

    The window over the files runs over one row per file.  Breaks off with BadFile at a broken file."""
    ship(files.sparkSession)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).select("path", "start")
    based = based.repartition(max(2, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    last = ("ids", pa.list_(pa.int64())) if ids else ("ids_crc32", pa.int64())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])
    render = (lambda doc, start, x: (doc, start, len(x), x.astype(np.int64))) if ids else _digest
    return based.mapInArrow(read_task(folder, render, schema), "doc_id long, start long, n_tokens long, " + ("ids array<long>" if ids else "ids_crc32 long"))


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    folder = shared_folder(spark, "token-files")
    folder = folder.replace("file:", "file://", 1) if folder.startswith("file:/") and "://" not in folder else folder if "://" in folder else f"file://{folder}"
    return read(write(table(spark, sf_dir, "documents"), folder, path("word_bpe_49k.json")), folder)
