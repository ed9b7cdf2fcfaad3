"""Two tokenizers' tokens side by side: a byte-level BPE (A) and sentencepiece with byte fallback (B).

The libraries' spans are the coarse cuts: character offsets of A, byte offsets of B's proto.  Tokens that share a
character, or a character's byte-fallback pieces, have no exact offsets; between two coarse cuts the lengths of the decoded bytes place them,
and the decoded bytes must spell the text.  Places where tokens of both end cut the tokens into groups.  (The installed sentencepiece has no immutable
proto any more; its ``proto`` carries the same spans.)

A space behind a visible character and punctuation behind a letter begin a new token in both, as no piece of B goes on so (the vocabulary is
asked).  So a text is aligned word by word, and a worker aligns a word once.  A text with a word whose bytes differ is aligned as a whole.

How many documents link an id pair is counted by exchange: a chunk of documents sends its different pairs once, with the number of its
documents that link each, and gets the corpus-wide counts back.  What is shuffled grows with the different pairs of a chunk, not with its tokens.
"""

from __future__ import annotations

import hashlib
import string
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.llm.bpe_chunks import id_bytes
from metrivane.llm.common import ship, stored, table, text_slices
from metrivane.llm.tokens import LONGEST, _VISIBLE, _LEAD, ragged, span_hashes

CHUNK = 8 << 20  # bytes of text in a chunk, one document at least
SLICE = 1 << 20  # bytes worked on at a time
WORDS = 1 << 19  # words that a worker keeps; beyond, it forgets them all
SLOTS = 20  # log2 of the slots by which they are found
WIDE = 1 << 16  # links of a group from which on its ids are counted before they are paired
SHIFT = 15  # bits of an id of B within the code of a pair
CHUNKS = "chunk long, codes array<int>, docs array<int>, packed binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
JOINED = 128  # words that are encoded as one text at most
HELPER = b" a"
_SPACE = 0x20
_PUNCTUATION, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_PUNCTUATION[np.frombuffer(string.punctuation.encode(), np.uint8)] = True
_LETTER[np.frombuffer(string.ascii_letters.encode(), np.uint8)] = True


class Column:
    """A growing array."""

    def __init__(self, kind, width: int | None = None):
        self.values, self.n = np.zeros((16, width) if width else 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.values):
            grown = np.zeros((2 * end, *self.values.shape[1:]), self.values.dtype)
            grown[: self.n] = self.values[: self.n]
            self.values = grown
        self.values[self.n : end] = more
        self.n = end


class Aligned:
    """What words have: numbers (tokens of A, of B, groups, links), whether their bytes agree, the text of their groups,
    and pairs in a row with the place of each word's first."""

    def __init__(self):
        self.numbers, self.good = Column(np.int64, 4), Column(bool)
        self.begin, self.size = Column(np.int64), Column(np.int64)
        self.codes, self.times = Column(np.int64), Column(np.int64)
        self.texts: list[str] = []

    def __len__(self):
        return len(self.texts)

    def add(self, numbers, good, sizes, codes, times, texts) -> None:
        self.begin.add(self.codes.n + np.cumsum(sizes) - sizes)
        for column, more in ((self.numbers, numbers), (self.good, good), (self.size, sizes), (self.codes, codes), (self.times, times)):
            column.add(more)
        self.texts += texts


def counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order and the sums of their times."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times[order], first) if len(keys) else np.zeros(0, np.int64)


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, bases: np.ndarray, owner: np.ndarray, stops: np.ndarray):
    """(ends of the tokens, good by text): coarse spans made exact.

    A token's coarse end is a cut unless it spans nothing or the next token of its text begins before it.  Between cuts, tokens
    end where their bytes do.  A text is good if its cuts and its end agree with the bytes.
    """
    good = np.ones(len(bases), bool)
    if not len(sizes):
        good[stops > bases] = False
        return np.zeros(0, np.int64), good
    total = np.cumsum(sizes)
    first = np.searchsorted(owner, np.arange(len(bases)))
    before = np.concatenate([[0], total])[first]
    exact = total - before[owner] + bases[owner]
    last = np.append(owner[1:] != owner[:-1], True)
    cut = last | ((np.append(starts[1:], 0) >= ends) & (ends > starts))
    wrong = (cut & (exact != ends)) | (last & (exact != stops[owner]))
    good[owner[wrong]] = False
    has = np.zeros(len(bases), bool)
    has[owner] = True
    good &= has | (stops == bases)
    return exact, good


class Aligner:
    """Aligns words, with the space before them, as both libraries encode them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = id_bytes(a_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        if len(pieces) > 1 << SHIFT or len(self.a_bytes) << SHIFT > 1 << 31:
            raise ValueError("the vocabularies are too large for the codes of pairs")
        self.a_spelled = np.array([[f"{i}," for i in range(len(self.a_bytes))], [f"{i}|" for i in range(len(self.a_bytes))]], object)
        self.b_spelled = np.array([[f"{i}," for i in range(len(pieces))], [f"{i};" for i in range(len(pieces))]], object)
        self.parts = not any(
            "▁" in p.lstrip("▁") or any(x.isalpha() and y in string.punctuation for x, y in zip(p, p[1:]))
            for i, p in enumerate(pieces)
            if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))
        )
        self.forget()

    def forget(self) -> None:
        self.known = Aligned()
        self.keys, self.at = np.zeros(1 << SLOTS, np.uint64), np.full(1 << SLOTS, -1, np.int64)

    def _joined(self, words: list[bytes], alone: set[int] | None) -> tuple[list[bytes], list[int], list[int]]:
        """(units, the word of each, the text of each): words in a row make a text where the next begins with a space
        behind a visible character.  A word without its space stands behind a helper, a unit of no word (-1)."""
        units, word, text, t, n, ready = [], [], [], -1, 0, False
        for i, w in enumerate(words):
            if not ready or n >= JOINED or alone is None or i in alone:
                t, n = t + 1, 0
            if w[0] != _SPACE:
                units.append(HELPER)
                word.append(-1)
                text.append(t)
            units.append(w)
            word.append(i)
            text.append(t)
            last = w[-1]
            ready = (0x21 <= last <= 0x7E or (0x80 <= last < 0xC0 and bool(_LEAD[w[-2]]))) and alone is not None and i not in alone
            n += 1
        return units, word, text

    def _coarse_a(self, texts: list[str], data: np.ndarray):
        """(ids, first and last places of the bytes of their characters, text) of all tokens in a row."""
        found = self.a.encode_batch(texts, add_special_tokens=False)
        counts = np.array([len(e) for e in found], np.int64)
        n = int(counts.sum())
        ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int64, n)
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in found)), np.int64, 2 * n)
        places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of all characters
        owner = np.repeat(np.arange(len(texts)), counts)
        chars = np.cumsum([0, *map(len, texts)])[owner]
        return ids, places[spans[::2] + chars], places[spans[1::2] + chars], owner

    def _coarse_b(self, texts: list[str], bases: np.ndarray):
        found = [e.pieces for e in self.b.encode([t[1:] for t in texts], return_type="proto", num_threads=1)]
        counts = np.array([len(e) for e in found], np.int64)
        flat = np.array([(p.id, p.begin, p.end) for e in found for p in e], np.int64).reshape(-1, 3)
        owner = np.repeat(np.arange(len(texts)), counts)
        # the proto's offsets are bytes of the text without the space that the model adds
        first = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
        return flat[:, 0], np.where(first, 0, flat[:, 1] + 1) + bases[owner], flat[:, 2] + 1 + bases[owner], owner

    def align(self, words: list[bytes], alone: set[int] | None = frozenset()) -> tuple:
        """What ``Aligned.add`` takes, for ``words`` as ``_joined`` wants them; with ``alone`` None each is a text."""
        units, word, text = self._joined(words, alone)
        word, text = np.array(word), np.array(text)
        sizes = np.array([len(u) for u in units], np.int64)
        behind, joined = np.cumsum(sizes), b"".join(units)
        stops = behind[np.append(text[1:] != text[:-1], True)]
        bases = np.append(0, stops[:-1])
        raw = [joined[a:b] for a, b in zip(bases.tolist(), stops.tolist())]
        texts = [r.decode() for r in raw]
        good, sides = np.ones(len(texts), bool), []
        for coarse, lengths, spelled in (
            (self._coarse_a(texts, np.frombuffer(joined, np.uint8)), self.a_sizes, self.a_bytes),
            (self._coarse_b(texts, bases), self.b_sizes, self.b_bytes),
        ):
            ids, starts, ends, owner = coarse
            ends, fine = refined(starts, ends, lengths[ids], bases, owner, stops)
            good &= fine
            if b"".join([spelled[i] for i in ids.tolist()]) != joined:
                edge = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                good &= [b"".join([spelled[i] for i in ids[x:y].tolist()]) == r for x, y, r in zip(edge, edge[1:], raw)]
            sides.append((ids, ends, owner))
        several = np.bincount(text[word >= 0]) > 1
        again = word[(word >= 0) & (several & ~good)[text]]
        if len(again):
            return self.align(words, set(again.tolist()) | alone)
        found = []
        for ids, ends, owner in sides:  # a helper's tokens go, and those of texts whose bytes differ
            own = word[np.minimum(np.searchsorted(behind, ends), len(behind) - 1)]
            keep = (own >= 0) & good[owner]
            found.append((ids[keep], ends[keep], own[keep]))
        return self._grouped(len(words), good[text[word >= 0]], *found)

    def _grouped(self, n: int, good: np.ndarray, a: tuple, b: tuple) -> tuple:
        """Groups, links and pairs of the words from their tokens' ids, ends and words."""
        cuts = np.intersect1d(a[1], b[1], assume_unique=True)
        of_a, of_b = np.searchsorted(cuts, a[1]), np.searchsorted(cuts, b[1])
        n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
        links = n_a * n_b
        owner = a[2][np.cumsum(n_a) - 1] if len(cuts) else np.zeros(0, np.int64)
        groups = np.bincount(owner, minlength=n)
        upto = np.concatenate([[0], np.cumsum(links)])
        edge = np.concatenate([[0], np.cumsum(groups)])
        numbers = np.stack([np.bincount(a[2], minlength=n), np.bincount(b[2], minlength=n), groups, np.diff(upto[edge])], axis=1)
        first_b = np.cumsum(n_b) - n_b
        plain = links[of_a] < WIDE
        ids, group = a[0][plain], of_a[plain]
        codes = (np.repeat(ids, n_b[group]) << SHIFT) | b[0][ragged(first_b[group], n_b[group])]
        words = np.repeat(a[2][plain], n_b[group])
        times = np.ones(len(codes), np.int64)
        for g in np.flatnonzero(links >= WIDE).tolist():
            x, p = np.unique(a[0][of_a == g], return_counts=True)
            y, q = np.unique(b[0][of_b == g], return_counts=True)
            codes = np.concatenate([codes, ((x[:, None] << SHIFT) | y).ravel()])
            times = np.concatenate([times, (p[:, None] * q).ravel()])
            words = np.concatenate([words, np.full(len(x) * len(y), owner[g])])
        keys, times = counted((words << 32) | codes, times)
        # ids with what follows them: a comma, or the end of the group's part
        flat = np.empty(len(a[0]) + len(b[0]), object)
        last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
        flat[np.arange(len(of_a)) + first_b[of_a]] = self.a_spelled[last_a[: len(of_a)].astype(np.int64), a[0]]
        flat[np.arange(len(of_b)) + np.cumsum(n_a)[of_b]] = self.b_spelled[last_b[: len(of_b)].astype(np.int64), b[0]]
        flat, at = flat.tolist(), np.concatenate([[0], np.cumsum(numbers[:, 0] + numbers[:, 1])]).tolist()
        texts = ["".join(flat[i:j]) for i, j in zip(at, at[1:])]
        return numbers, good, np.bincount(keys >> 32, minlength=n), keys & 0xFFFFFFFF, times, texts

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``known``, number of words by text) of texts that are not empty."""
        spaced = [b" " + t for t in texts]
        buffer = b"".join(spaced)
        data = np.frombuffer(buffer, np.uint8)
        edges = np.cumsum([0, *map(len, spaced)])
        begins = np.zeros(len(data) + 1, bool)
        if self.parts:
            begins[word_cuts(data)] = True
            for stop in edges[1:].tolist():  # spaces at the end of a text belong to its last word
                i = stop - 1
                while buffer[i] == _SPACE:
                    i -= 1
                    if begins[i + 1]:
                        begins[i + 1] = False
                        break
                    if i < 0:
                        break
        begins[edges] = True
        starts = np.flatnonzero(begins)
        starts, ends = starts[:-1], starts[1:]
        keys = span_hashes(data, starts, ends)
        short = ends - starts <= LONGEST
        if len(self.known) > WORDS:
            self.forget()
        slots = (keys >> np.uint64(64 - SLOTS)).astype(np.int64)
        at = np.where(short & (self.keys[slots] == keys), self.at[slots], -1)
        rest, long = np.flatnonzero((at < 0) & short), np.flatnonzero(~short)
        _, first, inverse = np.unique(keys[rest], return_index=True, return_inverse=True)
        which = np.concatenate([rest[first], long])
        if len(which):
            base = len(self.known)
            words = [buffer[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())]
            self.known.add(*self.align(words, frozenset() if self.parts else None))
            at[rest], at[long] = base + inverse, base + len(first) + np.arange(len(long))
            self.keys[slots[rest]], self.at[slots[rest]] = keys[rest], at[rest]
        return at, np.diff(np.searchsorted(starts, edges))

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[np.ndarray]]:
        """Numbers, groups' digests, codes of the different pairs and their times of every text."""
        numbers = np.zeros((len(texts), 4), np.int64)
        digests = [""] * len(texts)
        none = np.zeros(0, np.int64)
        codes, times = [none] * len(texts), [none] * len(texts)
        rows = [i for i, t in enumerate(texts) if t]
        if rows:
            at, counts = self.words([texts[i] for i in rows])
            self._collect(self.known, rows, at, counts, numbers, digests, codes, times)
            bad = np.add.reduceat((~self.known.good.values[at]).astype(np.int64), np.cumsum(counts) - counts) > 0
            for i in [rows[j] for j in np.flatnonzero(bad).tolist()]:
                whole = Aligned()
                whole.add(*self.align([b" " + texts[i]], None))
                if whole.good.values[0]:
                    self._collect(whole, [i], np.zeros(1, np.int64), np.ones(1, np.int64), numbers, digests, codes, times)
                else:
                    numbers[i], digests[i], codes[i], times[i] = 0, "", none, none
        return numbers, digests, codes, times

    @staticmethod
    def _collect(known: Aligned, rows, at, counts, numbers, digests, codes, times) -> None:
        edge = np.concatenate([[0], np.cumsum(counts)])
        numbers[rows] = np.add.reduceat(known.numbers.values[at], edge[:-1], axis=0)
        sizes = known.size.values[at]
        places = ragged(known.begin.values[at], sizes)
        owner = np.repeat(np.repeat(np.arange(len(rows)), counts), sizes)
        keys, total = counted((owner << 32) | known.codes.values[places], known.times.values[places])
        split = np.searchsorted(keys, np.arange(len(rows) + 1) << 32)
        listed, keys = at.tolist(), keys & 0xFFFFFFFF
        for j, i in enumerate(rows):
            codes[i], times[i] = keys[split[j] : split[j + 1]], total[split[j] : split[j + 1]]
            text = "".join([known.texts[k] for k in listed[edge[j] : edge[j + 1]]])[:-1]
            digests[i] = hashlib.sha256(text.encode()).hexdigest()


def word_cuts(data: np.ndarray) -> np.ndarray:
    """Where words begin: at a space behind a visible character, at ASCII punctuation behind a letter."""
    if not len(data):
        return np.zeros(0, np.int64)
    visible = _VISIBLE[data]
    letter = _LETTER[data]
    pair = np.flatnonzero((data[1:] >= 0x80) & (data[1:] < 0xC0) & _LEAD[data[:-1]]) + 1
    visible[pair] = True
    lead, last = data[pair - 1], data[pair]
    letter[pair] = (lead <= 0xC9) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))  # U+00C0 to U+027F but two signs
    cut = np.zeros(len(data), bool)
    cut[1:] = ((data[1:] == _SPACE) & visible[:-1]) | (_PUNCTUATION[data[1:]] & letter[:-1])
    return np.flatnonzero(cut)


_aligners: dict[tuple, Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this worker process."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times"]


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    flat = np.concatenate([*arrays, np.zeros(0, np.int64)])
    return pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, arrays)]), pa.array(flat.astype(kind)))


def _packed(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(different codes, documents that link each, the documents packed): pairs are places among the codes."""
    docs, numbers, digests, codes, times = zip(*rows)
    every, counts = np.unique(np.concatenate(codes), return_counts=True)
    places = [np.searchsorted(every, c) for c in codes]
    columns = [pa.array(docs, pa.int64()), *[pa.array(c) for c in np.stack(numbers).T.copy()], pa.array(digests, pa.string())]
    batch = pa.RecordBatch.from_arrays([*columns, _lists(places, np.int32), _lists(times, np.int64)], names=_NAMES)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return every, counts, sink.getvalue().to_pybytes()


def _chunk_task(a_path: str, b_path: str):
    def run(batches):
        own, base = aligner(a_path, b_path), TaskContext.get().partitionId() << 32
        rows, size, number = [], 0, 0

        def chunk():
            every, counts, packed = _packed(rows)
            columns = [[base + number], [every], [counts], [packed]]
            types = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["chunk", "codes", "docs", "packed"])

        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                ids = batch.column(0).slice(first, len(texts)).to_pylist()
                rows += zip(ids, *own.documents(texts))
                size += sum(map(len, texts))
                if size >= CHUNK:
                    yield chunk()
                    rows, size, number = [], 0, number + 1
        if rows:
            yield chunk()

    return run


def _scored(chunks, counts):
    """The documents of a chunk, given the corpus-wide counts of its pairs."""
    code = counts.column("code").to_numpy()
    order = np.argsort(code)
    n = counts.column("n").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    out = []
    for packed in chunks.column("packed").to_pylist():
        rows = pa.ipc.open_stream(packed).read_all().combine_chunks()
        lists = rows.column("places").combine_chunks()
        edge = lists.offsets.to_numpy()
        places, times = lists.values.to_numpy(), rows.column("times").combine_chunks().values.to_numpy()
        sums = [np.concatenate([[0], np.cumsum(times * x[places])]) for x in (best, n)]
        sums = [pa.chunked_array([s[edge[1:]] - s[edge[:-1]]]) for s in sums]
        columns = [*rows.columns[:5], *sums, rows.column("groups_sha256")]
        out.append(pa.Table.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = pa.schema([*[(name, pa.int64()) for name in names], ("groups_sha256", pa.string())])
    return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()


def pair_counts(chunks: DataFrame) -> DataFrame:
    """code (id of A << 15 | id of B), n (documents that link the pair), best (whether no pair of that id of A has more)."""
    pairs = chunks.select(F.inline(F.arrays_zip("codes", "docs"))).groupBy(F.col("codes").alias("code"))
    counts = stored(pairs.agg(F.sum("docs").alias("n")), "pair-counts")
    most = counts.groupBy(F.shiftright("code", SHIFT).alias("a")).agg(F.max("n").alias("most"))  # a row for each id of A at most
    joined = counts.join(F.broadcast(most), F.shiftright(counts["code"], SHIFT) == most["a"])
    return joined.select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each row of ``docs``: doc_id, tokens of both, groups, links, links whose pair is the commonest of
    its id of A, sum of the links' counts, digest of the groups.

    Null and empty texts, and texts that either tokenizer's bytes do not spell, have zeros and an empty digest.  A repeated
    row counts as a document of its own; null doc_ids keep their rows; other columns play no part; an empty table gives no rows.  A very long text is
    a chunk by itself; a group of very many tokens is counted by its different ids.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    chunks = stored(rows.mapInArrow(_chunk_task(a_path, b_path), CHUNKS), "aligned")
    wanted = chunks.select(F.col("chunk").alias("asks"), F.explode("codes").alias("code"))
    counts = wanted.join(pair_counts(chunks), "code").select("asks", "code", "n", "best")
    return chunks.select("chunk", "packed").groupBy("chunk").cogroup(counts.groupBy("asks")).applyInArrow(_scored, RESULT)


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return align_documents(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
