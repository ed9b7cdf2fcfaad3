"""Every operator on small tables with nulls, empties, ties, repeats and extra columns, against plain Python."""

import base64
import hashlib
import io
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from metrivane.llm import ann, bpe_chunks, exact_dedup, jaccard_join, packing, pii, token_files, toxicity, url_filter, warc
from metrivane.llm.common import shared_folder
from metrivane.llm.tokens import UnitEncoder

LONG = "the quick  brown fox\n\njumps <|endoftext|> over é日本 " * 300
TEXTS = [None, "", "  \n", "one", "One", "a b c", "x " * 3000, LONG, LONG + "tail", LONG.upper(), "same text here now ok", "same text here now ok", "don't 'S \x85 q  y z", "A" * 500]
DOCS = "doc_id long, text string, chunk int, pii string, n long"


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i if i != 3 else None, t, 1, "p", 2) for i, t in enumerate(texts)], DOCS)


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")) if w]


def components(texts, k, num, den):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and den * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    return sets, root


def near_copies():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(6):
        base = rng.choice(vocabulary, 120).tolist()
        for n in (0, 0, 1, 2, 4, 8, 12, 20):
            edited = list(base)
            for p in rng.integers(0, 120, n):
                edited[p] = f"e{rng.integers(10**9)}"
            out.append(" ".join(edited))
    passage = " ".join(rng.choice(vocabulary, 60))
    return out + [passage + " " + " ".join(f"u{i}_{j}" for j in range(40)) for i in range(30)] + [passage] * 2


@pytest.mark.parametrize("k, num", [(4, 85), (5, 80), (1, 60)])
def test_jaccard_components(spark, k, num):
    texts = near_copies() + [t for t in TEXTS if t is not None] + ["", None]
    sets, root = components(texts, k, num, 100)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(df, k, num).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in range(len(texts))}


def test_jaccard_empty_and_null_ids(spark):
    assert jaccard_join.similar_components(docs(spark, [])).count() == 0
    kept = jaccard_join.one_of_each(docs(spark))
    assert kept.columns == ["doc_id", "text", "chunk", "pii", "n"]
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and 11 not in ids and {0, 1, 2, 10} <= set(ids)


def test_exact_dedup(spark):
    df = docs(spark).unionByName(docs(spark, ["dup"] * 1))  # doc_id 0 twice with different texts
    got = exact_dedup.classify(df).collect()
    assert len(got) == len(TEXTS) + 1
    by = {(r.doc_id, r.text_sha256): r for r in got}
    low = hashlib.sha256("one".encode()).hexdigest()
    assert by[(None, low)].keep_id == 4 and by[(None, low)].group_size == 2 and not by[(None, low)].kept and by[(4, low)].kept
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    texts = [re.sub("[A-Z]+", lambda m: m.group().lower(), r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub("[A-Z]+", lambda m: m.group().lower(), t or "") for t in [*TEXTS, "dup"]})
    assert exact_dedup.classify(docs(spark, [])).count() == 0


def test_exact_dedup_with_colliding_digests(spark):
    from pyspark.sql import functions as F

    same = exact_dedup.classify(docs(spark), digest=lambda c: F.lit("x"), salts=3).drop("digest")
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, exact_dedup.classify(docs(spark)).collect()), key=str)


def test_ascii_lower_without_a_string_for_every_character(spark):
    from pyspark.sql import functions as F

    from metrivane.llm.common import ascii_lower

    texts = ["", None, "ABC xyz 09 [\\]^_`{|}~@Z", "\x00\x01\t\r\nQ\x7f", "É İIı ΑΣ ß ẞ K Å", "A\u0300 日本 ＡＢ 🙂X", "x" * 3000 + "Y"]
    texts += ["".join(chr(c) for c in range(a, a + 512) if not 0xD800 <= c < 0xE000) for a in range(0, 0x12000, 512)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("low"))
    for t, low in df.collect():
        assert low == (None if t is None else re.sub("[A-Z]+", lambda m: m.group().lower(), t))
    assert "lower(" in df._jdf.queryExecution().optimizedPlan().toString()  # plain texts take the way over bytes


def test_blocks_name_their_ids_without_sorting():
    rng = np.random.default_rng(5)
    for ids in (np.array([7], np.uint32), rng.integers(0, 49_000, 5000).astype(np.uint32), rng.integers(0, 2**32, 300, dtype=np.uint32)):
        alphabet, symbols = token_files.alphabet_of(ids)
        want, places = np.unique(ids, return_inverse=True)
        assert alphabet.dtype == ids.dtype and np.array_equal(alphabet, want) and np.array_equal(symbols, places)
        assert np.array_equal(token_files.unpack_ids(io.BytesIO(token_files.pack_ids(ids))), ids)


def test_powers_made_for_a_long_piece_serve_short_ones():
    from metrivane.llm import tokens

    long = tokens.powers(300_000)
    assert tokens.powers(10)[0] is long[0] and tokens.powers(200_000)[1] is long[1]
    assert len(tokens.powers(16 * tokens.PIECE)[0]) > 16 * tokens.PIECE  # a very long one is not kept for short ones
    assert len(tokens.powers(10)[0]) < tokens.PIECE


def test_long_texts_in_small_pieces():
    from tokenizers import Tokenizer

    from metrivane.llm import tokens

    texts = ["The quick brown fox's 12 jumps, É日本 <|x|> don't. " * 20_000, "x", "", "word " * 5]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        flat, n = tokens.UnitEncoder(P.path(name), log_slots=12).encode([t.encode() for t in texts])
        want = [e.ids for e in Tokenizer.from_file(P.path(name)).encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for w in want for i in w]


def luhn(s):
    d = [int(c) for c in re.sub("[^0-9]", "", s)][::-1]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(s)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
]
PRIVATE = ["é a@b.c_d@e.f x@y 1.2.3.4.5 256.1.1.1 000.01.255.9", "4111 1111 1111 1111 or 4111-1111-1111-1112, +1 (555) 010-9999) +12", "日本 me@x.org, IBAN account GB82 WEST 1234 5698 7654 32 end", "social security 123-45-6789", "123-45-6789", "a" * 20000 + "@", "1 " * 5000, "a@b" + ".c" * 3000, None, ""]


def test_pii(spark):
    got = {r.doc_id: r for r in pii.digest_columns(pii.find(spark.createDataFrame(list(enumerate(PRIVATE)), "doc_id long, text string"))).collect()}
    for i, t in enumerate(PRIVATE):
        spans = [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, t or "") if ok(m.group())]
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (i, got[i].spans)
        assert got[i].n_email == sum(k == "email" for k, _, _ in spans)
    assert "iban:" in got[2].spans and "national_id:" in got[3].spans and got[4].spans == ""


def test_pii_mask(spark):
    df = spark.createDataFrame([(1, "é a@b.de and 1.2.3.4!", 5, "p"), (2, None, None, "p"), (None, "plain", 5, None)], "doc_id long, text string, n_chars long, pii string")
    got = pii.mask(df)
    assert got.columns == df.columns
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == [(None, "plain", 5, None), (1, "é <EMAIL> and <IP>!", 19, "p"), (2, None, None, "p")]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_unit_encoder(name):
    own = UnitEncoder(P.path(name), P.path("byte_bpe_50k.tiktoken") if name[0] == "b" else None, log_slots=6)
    texts = [t or "" for t in TEXTS] + ["İ Σς", "\x1c a\x1f b\x0b\x0c c", "é ́a", "\t\r\n"]
    ids, counts = own.encode([t.encode() for t in texts])
    want = own.library.encode_batch(texts, add_special_tokens=False)
    assert counts.tolist() == [len(e.ids) for e in want] and ids.tolist() == [i for e in want for i in e.ids]


def test_bpe_chunks(spark):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = bpe_chunks.digest_documents(docs(spark), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")).collect()
    want = []
    for i, t in enumerate(TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        out = tok.decode(ids, skip_special_tokens=False)
        want.append((None if i == 3 else i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe_chunks.encode_documents(docs(spark, []), P.path("byte_bpe_50k.json")).count() == 0


def test_packing(spark):
    got = packing.pack_documents(docs(spark, TEXTS * 20), P.path("byte_bpe_50k.json")).collect()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in TEXTS * 20]
    assert sum(r.length for r in got) == sum(map(len, ids))
    for r in got:
        if r.doc_id is not None:
            assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 1024
    assert packing.pack_documents(docs(spark, []), P.path("byte_bpe_50k.json")).count() == 0


def test_best_two_fit_replaces_the_smallest():
    counts = np.zeros(11, int)
    counts[[7, 2]] = 1
    counts[[1]] = 0
    assert packing.best_two_fit(counts, 10) == [([7, 2], 1)]
    counts = np.zeros(101, int)
    counts[[60, 30, 29, 11]] = 1
    # 60 + 30 leaves 10; 29 + 11 fill the gap of 40 without the 30
    assert packing.best_two_fit(counts, 100)[0] == ([60, 29, 11], 1)


def test_token_files(spark):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    folder = shared_folder(spark, "tokens").replace("file:", "file://", 1)
    folder = folder if "://" in folder else f"file://{folder}"
    files = token_files.write(docs(spark), folder, P.path("word_bpe_49k.json"))
    got = token_files.read(files, folder, ids=True).collect()
    assert sum(r.n_tokens for r in got) == sum(r.ids for r in files.collect())
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        t = TEXTS[3 if r.doc_id is None else r.doc_id]
        assert r.start == start and r.ids == tok.encode(t or "", add_special_tokens=False).ids + [2]
        start += r.n_tokens
    assert token_files.write(docs(spark, []), folder + "-none", P.path("word_bpe_49k.json")).count() == 0


def test_token_blocks_round_trip_and_checksum():
    ids = (np.random.default_rng(1).zipf(1.4, 5000) % 70000).astype(np.uint32)
    data = token_files.pack_ids(ids)
    assert np.array_equal(token_files.unpack_ids(io.BytesIO(data)), ids)
    broken = bytearray(data)
    broken[len(data) // 2] ^= 255
    with pytest.raises(token_files.BadFile):
        token_files.unpack_ids(io.BytesIO(bytes(broken)))


PAGES = [(1, "http://a/x", "<p>é</p>", 1), (2, None, "<p>é</p>", 1), (3, "u\r\nv", None, 1), (4, "", "", 1), (None, "n", "<p>é</p>", 1), (5, "z", "big" * 700000, 1), (None, "n", "alone", 1), (2, None, "<p>é</p>", 1)]


def test_warc(spark):
    folder = shared_folder(spark, "warc").replace("file:", "file://", 1)
    folder = folder if "://" in folder else f"file://{folder}"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, key int")
    got = warc.read(warc.write(pages, folder), folder, payloads=True).collect()
    assert len(got) == len(PAGES)
    last = {}
    for i, _, h, _ in PAGES:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h, _ in PAGES:
        b, to = (h or "").encode(), last[h or ""]
        again = to >= 0 and (i is None or i < to)
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", to if again else None, None if again else b))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=str) == sorted(want, key=str)


def test_warc_rejects_broken_records():
    good = warc.record_bytes(1, "u", b"payload", warc.sha1_base32(b"payload"), 7, None)
    assert warc.read_record(good)[5] == b"payload"
    for bad in (good[:-1], good.replace(b"payload", b"paYload"), good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Type: ", b"X-Type: ")):
        with pytest.raises(warc.BadArchive):
            warc.read_record(bad)
    out = io.BytesIO()
    warc.write_archive(out, [good] * 400)
    with pytest.raises(warc.BadArchive):
        list(warc.frames(io.BytesIO(out.getvalue()[:-5])))
    assert list(warc.frames(io.BytesIO(out.getvalue()))) == [good] * 400


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return re.sub("[A-Z]+", lambda x: x.group().lower(), m[1]), m[2]


def by_rule(host, path):
    best = None
    for rule, ok in url_filter.RULES:
        domain, rest = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, "allow" if ok else "block")
    return best


def test_url_filter(spark):
    urls = [f"http://{'bad' if i % 2 else 'good'}{i}.{'com/de/spam' if i % 2 else 'org/news'}/{i}" for i in range(200)]
    urls += ["https://A.Example.ORG/es/1?x#y", "http://example.org/en/12", "http://org", "x", None, "", "a://b://c.org/", "http://good5.net/news/7", "http://bad8.net/de/spam/8"]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = parts(u)
        assert (got[i].host, got[i].path) == (host, path), u
        want = by_rule(host, path)
        assert got[i].rule == (want and want[0]) and (want is None or got[i].verdict == want[1])
    assert got[len(urls) - 2].verdict == "allow" and got[len(urls) - 1].verdict == "block"
    alone = url_filter.judge(df.filter("page_id = 203")).collect()
    assert [(r.verdict, r.score) for r in alone] == [("allow", None)]


def test_url_scores_match_a_plain_model(spark):
    seen = [("^aab$", True), ("^abb$", True), ("^bba$", False), ("^aab$", False), ("^ab$", True)]
    model = url_filter.build_model(spark.createDataFrame(seen, "text string, accepted boolean"))
    counts = {}
    for t, yes in seen:
        for k in range(1, url_filter.ORDER + 2):
            for i in range(len(t) - k + 1):
                counts.setdefault(t[i : i + k], [0, 0])[not yes] += 1
    counts = {g: c for g, c in counts.items() if len(g) == 1 or sum(c) >= url_filter.LEAST}

    def p(gram, side):
        if not gram:
            return 1 / url_filter.SYMBOLS
        total = sum(c[side] for g, c in counts.items() if len(g) == len(gram) and g[:-1] == gram[:-1])
        return (counts[gram][side] + url_filter.WEIGHT * p(gram[1:], side)) / (total + url_filter.WEIGHT)

    text = "^abab$"
    want = 0.0
    for end in range(1, len(text) + 1):
        gram = max((text[i:end] for i in range(max(0, end - url_filter.ORDER - 1), end) if text[i:end] in counts), key=len)
        want += np.log(p(gram, 0) / p(gram, 1))
    got = url_filter.score(spark.createDataFrame([(text,)], "text string"), model).first()
    assert got.score == pytest.approx(want / len(text), abs=1e-6)


def test_chain_matches_a_loop():
    rng = np.random.default_rng(5)
    counts = np.array([1, 0, 3, 150, 64, 1])
    first = toxicity.firsts(counts)
    potential, transition = rng.normal(size=counts.sum()), rng.random((2, 2)) + 0.1
    got, _, _ = toxicity.forward_backward(potential, transition, first)
    want, at = [], 0
    for n in counts.tolist():
        e = np.stack([np.ones(n), np.exp(potential[at : at + n])], 1)
        a, b = e.copy(), np.ones((n, 2))
        for t in range(1, n):
            a[t] = a[t - 1] @ transition * e[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = transition @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        g = a * b
        want += (g[:, 1] / g.sum(1)).tolist() if n else []
        at += n
    assert np.allclose(got, want)


def test_toxicity(spark):
    rng = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(300):
        text = rng.choice(plain, 40).tolist()
        toxic = i % 5 == 0
        if toxic:
            text[7], text[20] = "Vilegrub", "vilesome"
        rows.append((i, " ".join(text), "en"))
        labels.append((i, 1, int(toxic)))
    rows += [(300, None, "en"), (301, "", None), (None, "vilegrub vilegrub", "en")]
    docs_, labels_ = spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs_, labels_)
    got = {r.doc_id: r for r in toxicity.score_documents(docs_, model).collect()}
    assert len(got) == 303 and all((got[i].score >= toxicity.CUT) == (i % 5 == 0) for i in range(300))
    text = rows[5][1]
    assert {text[s.start : s.end] for s in got[5].spans} == {"Vilegrub", "vilesome"}
    kept = toxicity.harmless(docs_, labels_)
    assert kept.columns == docs_.columns and kept.count() == 242
    assert toxicity.train(docs_, labels_.filter("toxic = 0")) is None


def toxic_corpus(n, toxic):
    """Documents 0 to n - 1 of 40 words, those in ``toxic`` with two toxic ones, and their labels."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        text = rng.choice([f"word{j}" for j in range(300)], 40).tolist()
        if i in toxic:
            text[7], text[20] = "Vilegrub", "vilesome"
        rows.append((i, " ".join(text)))
    return rows, [(i, int(i in toxic)) for i in range(n)]


def in_draw_order(spark, n):
    from pyspark.sql import functions as F

    ids = spark.range(n).filter(~toxicity.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id")
    return [r.id for r in ids.collect()]


def test_toxicity_reads_rows_after_a_very_long_text(spark):
    order = in_draw_order(spark, 300)
    rows, labels = toxic_corpus(300, set(order[1:60:3]))
    rows[order[0]] = (order[0], "harmless words " * 1_300_000)  # 19.5 MB, drawn first
    docs_, labels_ = spark.createDataFrame(rows, "doc_id long, text string").repartition(8), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs_, labels_)
    got = {r.doc_id for r in toxicity.score_documents(docs_, model).filter("score >= 0.7").collect()}
    assert got == set(order[1:60:3])


def test_toxicity_draws_every_label_value(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 100)
    order = in_draw_order(spark, 900)
    rows, labels = toxic_corpus(900, set(order[-4:]))  # not among the first 100 drawn
    docs_, labels_ = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs_, labels_)
    got = {r.doc_id for r in toxicity.score_documents(docs_, model).filter("score >= 0.7").collect()}
    assert got == set(order[-4:])


def test_toxicity_without_toxic_texts_is_an_error(spark):
    rows, labels = toxic_corpus(60, {59})
    docs_, labels_ = spark.createDataFrame(rows[:59], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    with pytest.raises(ValueError, match="not held out"):
        toxicity.train(docs_, labels_)


def test_slopes_of_runs_match_those_of_words():
    rng = np.random.default_rng(6)
    counts, toxic = np.array([40, 0, 1, 300, 90, 7]), np.array([1, 0, 1, 0, 1, 0])
    hits = [(rng.integers(0, max(n, 1), n // 9), rng.integers(0, 3, n // 9)) for n in counts.tolist()]
    at = np.concatenate([b + h[0] for b, h in zip(np.cumsum(counts) - counts, hits)])
    feature, first = np.concatenate([h[1] for h in hits]), toxicity.firsts(counts)
    gold = np.zeros(counts.sum())
    gold[at] = 1
    gold *= np.repeat(toxic, counts)
    inner, theta = np.flatnonzero(~first), np.zeros(8)
    theta[3] = -2
    mean, square = np.zeros(8), np.zeros(8)
    for r in range(1, 61):
        transition, potential = np.exp(theta[-4:]).reshape(2, 2), np.full(len(gold), theta[3])
        np.add.at(potential, at, theta[feature])
        marginal, ahead, back = toxicity.forward_backward(potential, transition, first)
        joint = ahead[inner - 1][:, :, None] * transition * back[inner][:, None, :]
        joint = (joint / joint.sum((1, 2), keepdims=True)).sum(0) - np.bincount((gold[inner - 1] * 2 + gold[inner]).astype(int), minlength=4).reshape(2, 2)
        error = marginal - gold
        slope = np.concatenate([np.bincount(feature, error[at], 3), [error.sum()], joint.ravel()]) / gold.sum() + 1e-4 * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta -= 0.2 * (mean / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-8)
    weights, bias, transition = toxicity.fit_field(counts, toxic, hits, 3)
    assert np.allclose(weights, theta[:3], atol=1e-6) and bias == pytest.approx(theta[3], abs=1e-6)
    assert np.allclose(transition.ravel(), np.exp(theta[4:]), atol=1e-6)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8)) * rng.random((600, 1))
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(600, None, 0), (620, [0.0] * 8, 0), (640, [float("nan")] * 8, 0), (660, [None] + [1.0] * 7, 0), (None, [1.0] * 8, 0), (680, [1.0, 2.0], 0), (0, x[0].tolist(), 1)]
    got = ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 600, 20))
    hits = 0
    for q, found in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        top = np.lexsort((np.arange(600), -np.round(s, 12)))[:20].tolist()
        assert [r["rank"] for r in found] == list(range(1, 21)) and q not in [r.vec_id for r in found]
        assert all(abs(r.score - s[r.vec_id]) < 1e-12 for r in found)
        hits += len(set(top) & {r.vec_id for r in found})
    assert hits / (20 * len(by)) >= 0.95
    assert [r.vec_id for r in by[120]] == [i for i in range(100, 121) if i != 120] or 120 not in by
    assert ann.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    folder = "/root/testdata/sf0.001"
    out = spark.read.parquet(f"{folder}/documents.parquet")
    columns = out.columns
    for i, (_, stage) in enumerate(c.STAGES):
        out = stage(spark, out, folder)
        if i < 4:
            assert out.columns == columns
    assert c.run(spark, folder).select("doc_id").distinct().count() == out.select("doc_id").distinct().count() > 100
