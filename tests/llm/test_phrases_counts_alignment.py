"""Phrases, token counts and alignments against plain Python on small tables with every odd kind of row."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from metrivane.llm import alignment, phrases, token_counts
from metrivane.llm.bpe_chunks import id_bytes

DOCS = "doc_id long, text string, lang string, n long, phrase string, chunk int, code int, keys binary"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, b"k") for r in rows], DOCS)


def odd_texts(n, seed):
    rng = random.Random(seed)
    parts = list("aAbsStT'rReElLmMdD019  \n\t.,!<|>é×÷İÉñſ€日本 \u0085\x1c\x7f🙂")
    parts += ["<|endoftext|>", "</s>", "<0x41>", " the", "ing ", "  ", "'re", "'S", " word, word.", "▁"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(n)]
    return texts + [None, "", " ", "  \n", "a  ", "x" * 500, "the quick brown fox, " * 4000, "Same text", "Same text"]


def odd_rows(n=400, seed=5):
    texts = odd_texts(n, seed)
    return [(i if i != 3 else None, t, "en") for i, t in enumerate(texts)] + [(7, "again", "en"), (7, "again", "en")]


# ------------------------------------------------------------------ token counts


def test_token_counts(spark):
    rows = odd_rows()
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for doc, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[doc, len((text or "").encode()), n, n > 2048] += 1
    got = token_counts.count_documents(frame(spark, rows).repartition(5), P.path("word_bpe_49k.json"))
    assert Counter(tuple(r) for r in got.collect()) == want
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_token_counts_of_nothing(spark):
    assert token_counts.count_documents(frame(spark, []), P.path("word_bpe_49k.json")).count() == 0
    none = token_counts.count_documents(frame(spark, [(1, None, None)]), P.path("word_bpe_49k.json"))
    assert [tuple(r) for r in none.collect()] == [(1, 0, 0, False)]


def test_summary_keeps_what_is_frequent():
    rng = np.random.default_rng(2)
    keys = np.where(rng.random(60_000) < 0.3, rng.integers(0, 5, 60_000), rng.integers(10, 50_000, 60_000)).astype(np.uint64)
    halves = []
    for part in np.split(keys, 20):
        s = token_counts.Summary(kept=40)
        every, counts = np.unique(part, return_counts=True)
        s.merge(every, counts, lambda i, e=every: bytes([int(e[i]) % 256]))
        halves.append(s)
    whole = token_counts.Summary(kept=40)
    for s in halves:
        whole.merge(s.keys, s.counts, [s.pieces[int(k)] for k in s.keys].__getitem__)
    assert len(whole.keys) <= 40 and set(range(5)) <= set(whole.keys.tolist())
    assert set(whole.pieces) == set(whole.keys.tolist())


def test_frequent_table_changes_no_count(spark):
    path = P.path("word_bpe_49k.json")
    texts = [(t or "").encode() for t in odd_texts(300, 9)]
    library = Tokenizer.from_file(path)
    want = [len(library.encode(t.decode(), add_special_tokens=False).ids) for t in texts]
    table = token_counts.frequent_lengths([b"the", b"quick", b",", b"'s", b"a"], path)
    assert token_counts.Counter(path).count(texts, table).tolist() == want


# ------------------------------------------------------------------ alignment


def aligned_by_hand(texts):
    a_path, b_path = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    import sentencepiece

    a_library = Tokenizer.from_file(a_path)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_bytes = id_bytes(a_path)
    out, holders = [], Counter()
    for text in texts:
        a = a_library.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_library.encode(text) if text else []
        spelled_a = [a_bytes[i] for i in a]
        pieces = [b_library.id_to_piece(i) for i in b]
        spelled_b = [bytes([int(p[3:5], 16)]) if b_library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            out.append((0, 0, [], Counter()))
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in (spelled_a, spelled_b)]
        groups, begin = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append(tuple([i for i, e in zip(ids, own) if begin < e <= cut] for ids, own in zip((a, b), ends)))
            begin = cut
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holders.update(links.keys())
        out.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    for n_a, n_b, groups, links in out:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(t for p, t in links.items() if holders[p] == most[p[0]])
        total = sum(t * holders[p] for p, t in links.items())
        yield n_a, n_b, len(groups), sum(links.values()), best, total, hashlib.sha256(spelled.encode()).hexdigest() if groups else ""


@pytest.mark.parametrize("chunk", [1 << 30, 2000])
def test_alignment(spark, chunk, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    rows = [r if len(r[1] or "") < 5000 else (r[0], r[1][:4000], r[2]) for r in odd_rows(300)]
    want = Counter((r[0], *x) for r, x in zip(rows, aligned_by_hand([r[1] for r in rows])))
    got = alignment.align_documents(frame(spark, rows).repartition(4), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want


def test_alignment_of_nothing(spark):
    paths = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
    assert alignment.align_documents(frame(spark, []), *paths).count() == 0
    rows = alignment.align_documents(frame(spark, [(1, None, None), (None, "", "x")]), *paths).collect()
    assert {tuple(r) for r in rows} == {(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")}


def test_words_are_aligned_as_whole_texts():
    """Word by word, joined or alone, gives what the whole text gives; wide groups are counted by their ids."""
    own = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    texts = [t.encode() for t in odd_texts(200, 3) if t and len(t) < 3000]
    parts = own.documents(texts)
    own.parts = False
    own.forget()
    whole = own.documents(texts)
    assert (parts[0] == whole[0]).all() and parts[1] == whole[1]
    assert all(x.tolist() == y.tolist() for i in (2, 3) for x, y in zip(parts[i], whole[i]))


def test_wide_groups():
    own = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    ends_a, ends_b = np.append(np.arange(1, 600, 2), 601), np.arange(2, 602, 2)
    a = np.arange(len(ends_a)) % 7, ends_a, np.zeros(len(ends_a), np.int64)
    b = np.arange(len(ends_b) + 1) % 5, np.append(ends_b, 601), np.zeros(len(ends_b) + 1, np.int64)
    numbers, _, _, codes, times, _ = own._grouped(1, np.ones(1, bool), a, b)
    assert numbers[0].tolist() == [301, 301, 1, 301 * 301]
    want = Counter((int(x) << alignment.SHIFT) | int(y) for x in a[0] for y in b[0])
    assert dict(zip(codes.tolist(), times.tolist())) == dict(want)


# ------------------------------------------------------------------ phrases


def phrases_by_hand(rows, least, top):
    counts, totals, docs = defaultdict(Counter), Counter(), {}
    for doc, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    phrase = tuple(words[i : i + size])
                    counts[lang][phrase] += 1
                    if doc is not None:
                        docs[lang, phrase] = min(doc, docs.get((lang, phrase), doc))
    for lang, own in counts.items():
        wanted = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in wanted.items():
            inner = any(len(q) > len(p) and f >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, f in wanted.items())
            if not inner:
                cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), left, right, docs.get((lang, p))))
        for rank, (score, a, phrase, left, right, doc) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, totals[lang], -score, doc


def spoken(seed=4, n=250):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "Ab", "aB", "日本"]
    fixed = ["new  york\tcity hall plan", "over the top", "a a a a a a a", "x.y", "New york"]
    rows = []
    for i in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"]) for w in words)
        rows.append((i if i % 50 else None, text, rng.choice(["en", "en", "fr", None, ""])))
    return rows + [(1000, None, "en"), (1001, "", "de"), (1002, "lonely words", "xx"), (5, "over the top", "en"), (5, "over the top", "en")]


@pytest.mark.parametrize("least, top", [(3, 2000), (10, 7)])
def test_phrases(spark, least, top, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 3000)
    monkeypatch.setattr(phrases, "CHUNK", 2000)
    rows = spoken()
    got = phrases.collocations(frame(spark, rows).repartition(3), least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc_id"]
    assert sorted(map(tuple, got.collect())) == sorted(phrases_by_hand(rows, least, top))


def test_phrases_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (None, "  ", "en")]), 1).count() == 0


def test_products_beyond_64_bits(spark):
    rows = [("en", "", 0, 9_000_000_000_000, 1), ("en", "a", 1, 8_000_000_000_000, 1), ("en", "b", 1, 7_000_000_000_001, 1), ("en", "a b", 2, 6_999_999_999_999, 1)]
    got = phrases.scored(spark.createDataFrame(rows, phrases.SPELLED.replace("size int, n long", "size int, n long"))).collect()
    want = 1000 * 6_999_999_999_999 * 9_000_000_000_000 // (8_000_000_000_000 * 7_000_000_000_001)
    assert [(r.phrase, r.score) for r in got] == [("a b", want)]


def test_equal_fingerprints_are_told_apart():
    runs = phrases.Runs([b"one two one three one two"], "en")
    at = runs.at(2)
    first, numbers = runs.counted(at, np.zeros(len(at), np.uint64), 2)
    spelled = runs.spelled(first, 2).to_pylist()
    assert dict(zip(spelled, numbers.tolist())) == {"one two": 2, "two one": 1, "one three": 1, "three one": 1}


def test_full_bit_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FEWEST_BITS", 6)
    monkeypatch.setattr(phrases, "MOST_BITS", 7)
    rows = spoken(9, 60)
    got = phrases.collocations(frame(spark, rows), 3, 50)
    assert sorted(map(tuple, got.collect())) == sorted(phrases_by_hand(rows, 3, 50))


def test_spelling_holds_little_at_a_time():
    """14 MB of one language, all of whose runs may be frequent."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=25_000)) for _ in range(10)] * 14
    rows = [pa.RecordBatch.from_pydict({"lang": ["en"], "doc": [i], "text": [t]}) for i, t in enumerate(texts)]
    full = {k: SimpleNamespace(value=np.full(1 << 10, 2**64 - 1, np.uint64)) for k in range(1, phrases.LONGEST)}
    assert sum(map(len, texts)) > 14_000_000
    tracemalloc.start()
    try:
        singles = Counter()
        for batch in phrases._spell_task(full)(iter(rows)):
            if batch.column(2)[0].as_py() == 1:
                singles.update(dict(zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert singles == Counter(w for t in texts for w in t.split())
    assert most < 600 << 20, most
