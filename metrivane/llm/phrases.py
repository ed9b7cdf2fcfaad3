"""Phrases that occur together more often than their parts would by chance, per language.

Words are found in a buffer of texts in lower case with one space between the words of a piece.  A prefix polynomial over its bytes gives the
Rabin-Karp fingerprint of every run of words, so no phrase is spelled to be counted.  Sizes are counted one after the other:
a run is counted only where both shorter runs within it may be frequent.  Each chunk of texts sends its different fingerprints
with their numbers to a shuffle that adds them up; the frequent ones come back as a bit map of bounded size.  Its false hits cost time only.

A fingerprint may stand for several texts.  So in a last pass every chunk follows its pointers to the first occurrence of each
fingerprint that may be frequent, compares all other occurrences with it byte by byte, and sends the phrase; phrases
are counted by their text.  Only those are ever spelled.  Of the documents that hold a phrase the smallest doc_id is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrivane.llm.common import ship, stored, table, text_slices
from metrivane.llm.tokens import hash_sums, mixed, ragged, sum_hashes
from metrivane.operators.joins import hinted

LONGEST = 5  # words of a phrase
LEAST = 100  # occurrences of a frequent one
TOP = 2000  # phrases of a language in the report
SLICE = 1 << 20  # bytes worked on at a time
CHUNK = 3 << 20  # fingerprints of a chunk before it is sent
SPELL = 1 << 20  # bytes of a language that are spelled at a time
COMPARED = 1 << 18  # bytes of phrases compared at a time
FEWEST_BITS, MOST_BITS, BITS_EACH = 16, 27, 16  # of a bit map: log2 at least and at most, and those for each fingerprint
UNKNOWN = "und"
SPELLED = "lang string, phrase string, size int, n long, doc long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER[9] = 32
_BREAK = np.zeros(256, bool)
_BREAK[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_WORD = ~_BREAK
_WORD[32] = False


class Runs:
    """The runs of words of some texts of one language."""

    def __init__(self, texts: list[bytes], lang: str):
        data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        space = data == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        self.data = data[keep]
        lengths = np.cumsum([len(t) + 1 for t in texts])
        self.edges = np.cumsum(keep)[lengths - 1]  # where each text ends
        word = _WORD[self.data]
        change = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
        self.starts, self.ends = change[::2], change[1::2]
        joined = np.zeros(len(self.starts), bool)  # whether the next word is in the same piece
        if len(joined):
            behind = self.ends[:-1]
            joined[:-1] = (self.starts[1:] - behind == 1) & (self.data[behind] == 32)
        self.joined = joined
        self.sums = hash_sums(self.data)
        self.seed = np.uint64(hash_text(lang))

    def at(self, size: int) -> np.ndarray:
        """The first words of all runs of ``size`` words."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        good = np.ones(n, bool)
        for j in range(size - 1):
            good &= self.joined[j : j + n]
        return np.flatnonzero(good)

    def prints(self, at: np.ndarray, size: int) -> np.ndarray:
        found = sum_hashes(self.sums, self.starts[at], self.ends[at + size - 1])
        return mixed(found ^ self.seed ^ np.uint64(size * 0x2545F4914F6CDD1D & (2**64 - 1)))

    def candidates(self, size: int, maps: dict[int, np.ndarray]) -> np.ndarray:
        """First words of the runs whose shorter runs may all be frequent, by the longest size that has a map."""
        at = self.at(size)
        known = max((s for s in maps if s < size), default=0)
        if known and len(at):
            hit = np.zeros(len(self.starts) + 1, bool)
            runs = self.at(known)
            hit[runs[held(maps[known], self.prints(runs, known))]] = True
            for j in range(size - known + 1):
                at = at[hit[at + j]]
        return at

    def counted(self, at: np.ndarray, prints: np.ndarray, size: int):
        """(first words, numbers) of the runs with different texts, among those of the same fingerprint too."""
        order = np.argsort(prints, kind="stable")
        at, prints = at[order], prints[order]
        begin = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        numbers = np.diff(np.append(begin, len(at)))
        first = np.repeat(at[begin], numbers)
        x, y = self.starts[at], self.starts[first]
        length, other = self.ends[at + size - 1] - x, self.ends[first + size - 1] - y
        same = length == other
        own = np.flatnonzero(same & (x != y))
        same[own] = same_bytes(self.data, x[own], y[own], length[own])
        if same.all():
            return at[begin], numbers
        runs: dict[bytes, list[int]] = {}
        for i in at.tolist():
            runs.setdefault(self.data[self.starts[i] : self.ends[i + size - 1]].tobytes(), []).append(i)
        return np.array([r[0] for r in runs.values()]), np.array([len(r) for r in runs.values()])

    def spelled(self, at: np.ndarray, size: int) -> pa.Array:
        x, length = self.starts[at], self.ends[at + size - 1] - self.starts[at]
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        data = self.data[ragged(x, length)]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def same_bytes(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of ``data`` from ``x`` and from ``y`` are equal; they have at least a byte each."""
    out, ends, first = np.ones(len(x), bool), np.cumsum(length), 0
    while first < len(x):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - length[first] + COMPARED)))
        n = length[first:last]
        equal = data[ragged(x[first:last], n)] == data[ragged(y[first:last], n)]
        out[first:last] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        first = last
    return out


def hash_text(text: str) -> int:
    data = np.frombuffer(text.encode() + b"\0", np.uint8)
    return int(sum_hashes(hash_sums(data), np.array([0]), np.array([len(data)]))[0])


def held(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Whether the bit map has each fingerprint."""
    place = prints >> np.uint64(64 - int(len(bits) * 64).bit_length() + 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _by_lang(batches):
    """(lang, doc_ids, texts) of slices of rows with one language each."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lang in dict.fromkeys(langs):
            rows = batch.filter(pa.array([x == lang for x in langs])) if len(set(langs)) > 1 else batch
            for first, texts in text_slices(rows.column(2), SLICE):
                yield lang, rows.column(1).slice(first, len(texts)), texts


def _count_task(sizes: list[int], maps):
    def run(batches):
        known = {s: m.value for s, m in maps.items()}
        waiting, n = np.empty(CHUNK, np.uint64), 0

        def send():
            prints = waiting[:n]
            prints.sort()
            first = 0
            while first < n:  # a part ends where a fingerprint does
                last = min(n, first + (1 << 18))
                last = int(np.searchsorted(prints, prints[last - 1], side="right"))
                own = prints[first:last]
                begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                counts = np.diff(np.append(begin, len(own)))
                yield pa.RecordBatch.from_arrays([pa.array(own[begin].view(np.int64)), pa.array(counts)], names=["print", "n"])
                first = last

        for lang, _, texts in _by_lang(batches):
            runs = Runs(texts, lang)
            for size in sizes:
                prints = runs.prints(runs.candidates(size, known), size)
                while len(prints):
                    part, prints = prints[: CHUNK - n], prints[CHUNK - n :]
                    waiting[n : n + len(part)] = part
                    n += len(part)
                    if n == CHUNK:
                        yield from send()
                        n = 0
        if n:
            yield from send()

    return run


def _spell_task(maps):
    def run(batches):
        known = {s: m.value for s, m in maps.items()}
        waiting = {}

        def send(lang):
            texts, docs, _ = waiting.pop(lang)
            runs = Runs(texts, lang)
            ids = np.array([np.iinfo(np.int64).max if d is None else d for d in docs], np.int64)
            words = np.searchsorted(runs.edges, runs.starts, side="right")  # the text of every word
            yield _rows(lang, pa.array([""]), 0, np.array([len(runs.starts)]), np.array([np.iinfo(np.int64).max]))
            for k in range(1, LONGEST + 1):
                at = runs.at(k)
                prints = runs.prints(at, k)
                hit = held(known[min(k, LONGEST - 1)], prints)
                at, prints = at[hit], prints[hit]
                if len(at):
                    order = np.argsort(ids[words[at]], kind="stable")  # the first occurrence is in the smallest doc_id
                    first, numbers = runs.counted(at[order], prints[order], k)
                    yield _rows(lang, runs.spelled(first, k), k, numbers, ids[words[first]])

        for lang, ids, texts in _by_lang(batches):
            have = waiting.setdefault(lang, ([], [], []))
            have[0].extend(texts)
            have[1].extend(ids.to_pylist())
            have[2].append(sum(map(len, texts)))
            if sum(have[2]) >= SPELL:
                yield from send(lang)
            elif sum(sum(x[2]) for x in waiting.values()) >= CHUNK * 4:
                for key in list(waiting):
                    yield from send(key)
        for key in list(waiting):
            yield from send(key)

    return run


def _rows(lang, phrases, size, numbers, docs) -> pa.RecordBatch:
    n = len(phrases)
    columns = [pa.array([lang] * n, pa.string()), phrases, pa.array(np.full(n, size, np.int32)), pa.array(numbers.astype(np.int64)), pa.array(docs)]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "n", "doc"])


def bit_map(prints: DataFrame, count: int) -> np.ndarray:
    """A bit for every fingerprint, at most 2 ** MOST_BITS: made by the executors, brought together as words of 64 bits."""
    log = min(MOST_BITS, max(FEWEST_BITS, int(count * BITS_EACH - 1).bit_length()))
    place = F.shiftrightunsigned("print", 64 - log)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = prints.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()
    out = np.zeros(1 << (log - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def frequent_maps(rows: DataFrame, least: int) -> dict:
    """Broadcast bit maps of the fingerprints that occur ``least`` times, by size; the last holds two sizes."""
    context, maps = rows.sparkSession.sparkContext, {}
    for sizes in [*[[s] for s in range(1, LONGEST - 1)], [LONGEST - 1, LONGEST]]:
        # a chunk has each fingerprint once, so they are dealt out before they are added up
        dealt = rows.mapInArrow(_count_task(sizes, dict(maps)), "print long, n long").repartition("print")
        counts = dealt.groupBy("print").agg(F.sum("n").alias("n"))
        frequent = stored(counts.where(F.col("n") >= least).select("print"), "frequent-prints")
        maps[sizes[0]] = context.broadcast(bit_map(frequent, frequent.count()))
    return maps


def phrase_counts(rows: DataFrame, least: int) -> DataFrame:
    """lang, phrase, size, n, doc of all phrases that occur ``least`` times; size 0 has the number of words of each language."""
    spelled = rows.mapInArrow(_spell_task(frequent_maps(rows, least)), SPELLED)
    found = spelled.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"), F.min("doc").alias("doc"))
    return stored(found.where((F.col("n") >= least) | (F.col("size") == 0)), "phrases")


def words_of(phrase: str, first, count) -> Column:
    return F.array_join(F.slice(F.split(phrase, " ", -1), first, count), " ")


def scored(counts: DataFrame) -> DataFrame:
    """All phrases of at least two words with the score of their worst cut."""
    totals = counts.where(F.col("size") == 0).select("lang", F.col("n").alias("total"))
    parts = counts.where(F.col("size").between(1, LONGEST - 1)).select("lang", F.col("phrase").alias("part"), F.col("n").alias("m"))
    rows = counts.where(F.col("size") >= 2).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    rows = rows.withColumns({"left": words_of("phrase", F.lit(1), F.col("k")), "right": words_of("phrase", F.col("k") + 1, F.col("size") - F.col("k"))})
    for side, name in (("left", "l"), ("right", "r")):
        rows = rows.join(parts.withColumnsRenamed({"part": side, "m": name}), ["lang", side])
    rows = rows.join(hinted(totals), "lang")
    wide = {c: f"cast({c} as decimal(15,0))" for c in ("n", "total", "l", "r")}
    score = F.expr(f"(1000BD * {wide['n']} * {wide['total']}) div ({wide['l']} * {wide['r']})")
    worst = rows.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"),
        *[F.first(c).alias(c) for c in ("size", "n", "doc", "total")],
    )
    return worst.select("lang", "phrase", "size", "n", "doc", "total", "cut.score", "cut.l", "cut.r")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, first_doc_id (null where no document has an id).

    A phrase that a longer one always surrounds is left out.  A null text has no words; a null lang is ``und``; a repeated row counts each time;
    other columns play no part; an empty table, and a language without frequent phrases, give no rows.  A very long text is worked on whole:
    a task's memory grows with the longest text.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(docs["lang"], F.lit(UNKNOWN)).alias("lang"), docs["doc_id"].cast("long").alias("doc"), docs["text"])
    counts = phrase_counts(rows, least)
    # a phrase that is always part of a longer one is always part of one that is a word longer
    longer = counts.where(F.col("size") >= 3)
    ends = F.array(words_of("phrase", F.lit(1), F.col("size") - 1), words_of("phrase", F.lit(2), F.col("size") - 1))
    inner = longer.select("lang", F.explode(ends).alias("phrase"), "n").distinct()
    own = scored(counts).join(inner, ["lang", "phrase", "n"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    ranked = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    first = F.when(F.col("doc") < F.lit(2**63 - 1), F.col("doc")).alias("first_doc_id")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score", first)


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, doc_id, w FROM (SELECT lang, doc_id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS total FROM words GROUP BY lang),
starts AS (SELECT lang, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
counts AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS a, min(doc_id) AS first_doc_id
  FROM starts GROUP BY ALL HAVING count(*) >= 100
),
cuts AS (
  SELECT lang, phrase, k, a, first_doc_id, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM counts WHERE k >= 2
),
scores AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.first_doc_id, c.j, x.a AS l, y.a AS r, t.total, (1000 * c.a * t.total) // (x.a * y.a) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.j], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1 : c.k], ' ')
),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ones AS (
  SELECT DISTINCT lang, a, unnest([array_to_string(w[1 : k - 1], ' '), array_to_string(w[2 : k], ' ')]) AS phrase
  FROM (SELECT lang, a, k, string_split(phrase, ' ') AS w FROM counts WHERE k >= 3)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM worst w WHERE NOT EXISTS (SELECT 1 FROM inner_ones i WHERE i.lang = w.lang AND i.phrase = w.phrase AND i.a >= w.a)
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(total AS BIGINT) AS n, CAST(score AS BIGINT) AS score, first_doc_id
FROM ranked WHERE rank <= 2000
"""


def op11_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
