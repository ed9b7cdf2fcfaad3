"""Toxic spans by a linear-chain conditional random field.

A field of two states (harmless, toxic) tags the words of a text.  It is fitted on TRAIN_ROWS labelled documents of
each label value.  The labels are of documents; a word of a toxic document is labelled toxic if it, or a
beginning of it, stands in toxic documents far more often than in others.  Forward-backward marginals
give the offending spans; a logistic model of their sum, maximum and density gives the document's score.

Spark tasks read the whole texts of the sample; the fitting task gets only the places of the features in them.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import ship, stored, table, text_slices
from metrivane.llm.tokens import hash_sums, sum_hashes

TRAIN_ROWS = 4000  # labelled documents of each label value in the sample
FEATURES = 4096  # features of the field at most
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that are features besides the whole word
DEVIATIONS = 4.0  # standard deviations by which toxic documents with a telling feature exceed what chance gives
SHARE = 0.5  # share of toxic ones among the documents that hold a telling feature
CUT = 0.7
BLOCK = 64
RESULT = "doc_id long, score double, spans array<struct<start:int,end:int,probability:double>>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, words of each text): words are runs of letters and bytes beyond ASCII."""
    data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    letter = _LETTER[data]
    change = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
    starts, ends = change[::2], change[1::2]
    upto = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return data, starts, ends, np.diff(np.concatenate([[0], upto]))


def feature_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Hashes of the whole words and of their beginnings; 0 where a word is shorter."""
    sums = hash_sums(data)
    out = [sum_hashes(sums, starts, ends)]
    for n in BEGINNINGS:
        long = ends - starts > n
        h = np.zeros(len(starts), np.uint64)
        h[long] = sum_hashes(sums, starts[long], starts[long] + n) | np.uint64(1)
        out.append(h)
    return out


def chain(emission: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Normalised forward messages of many chains in a row; ``first`` marks where a chain begins."""
    step = transition[None] * emission[:, None, :]
    step[first] = emission[first][:, None, :]
    return messages(step)


def messages(step: np.ndarray) -> np.ndarray:
    """The normalised row vectors that an even one becomes by the products of the first 1, 2, ... matrices.

    Blocks of matrices are multiplied side by side, then the block products by the same function's means, so the
    work is in numpy and not in a loop over words.
    """
    n = len(step)
    if n == 0:
        return np.zeros((0, 2))
    rows = -(-n // BLOCK)
    padded = np.broadcast_to(np.eye(2), (rows * BLOCK, 2, 2)).copy()
    padded[:n] = step
    prefix = padded.reshape(rows, BLOCK, 2, 2)
    for j in range(1, BLOCK):
        a, b = prefix[:, j - 1], prefix[:, j]
        prod = a[:, :, :1] * b[:, None, 0] + a[:, :, 1:] * b[:, None, 1]
        prefix[:, j] = prod / prod.sum((1, 2), keepdims=True)
    carry = np.empty((rows, 2))
    state = np.array([0.5, 0.5])
    for i, total in enumerate(prefix[:, -1].tolist()):
        carry[i] = state
        x = state[0] * total[0][0] + state[1] * total[1][0]
        y = state[0] * total[0][1] + state[1] * total[1][1]
        state = (x / (x + y), y / (x + y))
    out = carry[:, None, :1] * prefix[:, :, 0] + carry[:, None, 1:] * prefix[:, :, 1]
    out = out.reshape(-1, 2)[:n]
    return out / out.sum(1, keepdims=True)


def forward_backward(potential: np.ndarray, transition: np.ndarray, first: np.ndarray):
    """(marginal of the toxic state, forward messages, backward messages with their emissions)."""
    emission = np.stack([np.ones(len(potential)), np.exp(np.clip(potential, -30, 30))], 1)
    emission /= emission.sum(1, keepdims=True)
    ahead = chain(emission, transition, first)
    last = np.roll(first, -1) if len(first) else first
    back = chain(emission[::-1], transition.T, last[::-1])[::-1]
    both = ahead * back / emission
    return both[:, 1] / both.sum(1), ahead, back


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of the features
    weights: np.ndarray
    bias: float
    transition: np.ndarray
    document: np.ndarray  # of log sum, maximum, density, 1

    def __post_init__(self):
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def indices(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, features) of the hashes that are features."""
        at = np.flatnonzero(self.gate[(hashes >> np.uint64(48)).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[i] == hashes[at]
        return at[hit], i[hit]

    def potentials(self, hashes: list[np.ndarray]) -> np.ndarray:
        out = np.full(len(hashes[0]), self.bias)
        for h in hashes:
            at, i = self.indices(h)
            np.add.at(out, at, self.weights[i])
        return out

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, list[list]]:
        """Score and spans of each text; spans are in code points, words that follow each other are joined."""
        data, starts, ends, counts = words_of(texts)
        first = firsts(counts)
        marginal, _, _ = forward_backward(self.potentials(feature_hashes(data, starts, ends)), self.transition, first)
        score = sigmoid(document_features(marginal, counts) @ self.document)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        owner = np.repeat(np.arange(len(counts)), counts)
        spans: list[list] = [[] for _ in texts]
        before = (-2, -1)
        for i in np.flatnonzero(marginal >= 0.5).tolist():
            doc = int(owner[i])
            shift = points[begins[doc]]
            one = {"start": int(points[starts[i]] - shift), "end": int(points[ends[i]] - shift), "probability": float(marginal[i])}
            if before == (i - 1, doc):
                one["start"], one["probability"] = spans[doc][-1]["start"], max(one["probability"], spans[doc].pop()["probability"])
            spans[doc].append(one)
            before = (i, doc)
        return score, spans


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def firsts(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(int(counts.sum()), bool)
    begin = np.cumsum(counts) - counts
    out[begin[counts > 0]] = True
    return out


def document_features(marginal: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log(1 + sum), maximum and density of the marginals, and 1, for each text; zeros without words."""
    out = np.zeros((len(counts), 4))
    some = counts > 0
    begin = (np.cumsum(counts) - counts)[some]
    if some.any():
        sums = np.add.reduceat(marginal, begin)
        out[some, 0] = np.log1p(sums)
        out[some, 1] = np.maximum.reduceat(marginal, begin)
        out[some, 2] = np.sqrt(sums / counts[some])
    out[:, 3] = 1
    return out


def feature_counts(texts: list[bytes], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, toxic texts, other texts that hold them)."""
    held = []
    for text in texts:
        data, starts, ends, _ = words_of([text])
        held.append(np.unique(np.concatenate(feature_hashes(data, starts, ends))))
    keys, place = np.unique(np.concatenate(held), return_inverse=True)
    both = np.bincount(place, minlength=len(keys))
    bad = np.bincount(place, np.repeat(toxic, [len(h) for h in held]), len(keys)).astype(np.int64)
    return keys, bad, both - bad


def runs_of(inner: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of so many equal steps ``inner``: their products, and for each entry (i, j) the sum over the
    places in the run of the product in which that one step is 1 at (i, j) and 0 elsewhere; each run to a scale of its own."""
    square = np.zeros((4, 4, 4))
    square[:, :2, :2] = square[:, 2:, 2:] = inner
    square[[0, 1, 2, 3], [0, 0, 1, 1], [2, 3, 2, 3]] = 1
    power = np.broadcast_to(np.eye(4), (len(lengths), 4, 4, 4)).copy()
    left = lengths.copy()
    while left.any():
        odd = left % 2 == 1
        grown = power[odd] @ square
        power[odd] = grown / grown[:, :1, :2, :2].max((1, 2, 3), keepdims=True)
        square = square @ square
        square /= square[0, :2, :2].max()
        left //= 2
    # the scale of the squares is the same for all four entries, so the sums and the products stay in proportion
    return power[:, 0, :2, :2], power[:, :, :2, 2:]


def fit_field(counts: np.ndarray, toxic: np.ndarray, hits: list[tuple[np.ndarray, np.ndarray]], features: int, rounds: int = 60):
    """(weights, bias, transition) from the words of each text, its label, and the (words, features) it holds.

    Runs of words without features are all alike: they are one product of matrices each, so the work grows with the
    features that texts hold and not with their length, and every word counts.
    """
    begin = np.cumsum(counts) - counts
    word = np.concatenate([b + h[0] for b, h in zip(begin.tolist(), hits)] or [np.zeros(0, np.int64)]).astype(np.int64)
    feature = np.concatenate([h[1] for h in hits] or [np.zeros(0, np.int64)]).astype(np.int64)
    heads = begin[counts > 0]
    items = np.union1d(heads, word)  # words with features and first words; a run of words without them follows each
    at = np.searchsorted(items, word)
    first = np.isin(items, heads)
    gold = np.zeros(len(items))
    gold[at] = 1
    gold *= np.repeat(toxic, counts > 0)[np.cumsum(first) - 1]
    gap = np.diff(items, append=int(counts.sum())) - 1
    lengths, kind = np.unique(gap, return_inverse=True)
    inner = np.flatnonzero(~first)
    pairs = np.bincount((gold[inner - 1] * (gap[inner - 1] == 0) * 2 + gold[inner]).astype(int), minlength=4).reshape(2, 2).astype(float)
    pairs[1, 0] += (gold * (gap > 0)).sum()
    pairs[0, 0] += gap.sum() - (gold * (gap > 0)).sum()
    theta = np.zeros(features + 1 + 4)
    theta[features] = -2.0
    even = np.full((1, 2), 0.5)
    mean, square, scale = np.zeros_like(theta), np.zeros_like(theta), max(gold.sum(), 1.0)
    for r in range(1, rounds + 1 if len(items) else 1):
        slope = slopes(theta, at, feature, gold, first, kind, lengths, pairs, even) / scale
        slope += 1e-4 * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta -= 0.2 * (mean / (1 - 0.9**r)) / (np.sqrt(square / (1 - 0.99**r)) + 1e-8)
    return theta[:-5], float(theta[-5]), np.exp(theta[-4:]).reshape(2, 2)


def slopes(theta, at, feature, gold, first, kind, lengths, pairs, even) -> np.ndarray:
    """Expected less labelled counts of every feature, of toxic words and of transitions."""
    weights, bias, transition = theta[:-5], theta[-5], np.exp(theta[-4:]).reshape(2, 2)
    potential = np.full(len(gold), bias)
    np.add.at(potential, at, weights[feature])
    emission = np.stack([np.ones(len(gold)), np.exp(np.clip(potential, -30, 30))], 1)
    emission /= emission.sum(1, keepdims=True)
    plain = np.array([1, np.exp(np.clip(bias, -30, 30))])
    plain = transition * (plain / plain.sum())
    product, entries = runs_of(plain, lengths)
    step = transition[None] * emission[:, None, :]
    step[first] = emission[first][:, None, :]
    run = product[kind]
    whole = step @ run
    before = np.concatenate([even, messages(whole)[:-1]])
    after = np.concatenate([messages(whole[::-1].transpose(0, 2, 1))[::-1][1:], even])
    joint = before[:, :, None] * step * (run @ after[:, :, None]).transpose(0, 2, 1)
    joint /= joint.sum((1, 2), keepdims=True)
    marginal = joint[:, :, 1].sum(1)
    entered = (before[:, None, :] @ step)[:, 0]
    within = np.einsum("na,nkab,nb->nk", entered, entries[kind], after) / np.einsum("na,nab,nb->n", entered, run, after)[:, None]
    within = (within * plain.ravel()).sum(0).reshape(2, 2)
    error = marginal - gold
    moved = joint[~first].sum(0) + within - pairs
    return np.concatenate([np.bincount(feature, error[at], len(weights)), [error.sum() + within[:, 1].sum()], moved.ravel()])


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Weights of a logistic model with a little ridge, by Newton steps; a row counts ``share`` times."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ beta)
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, x.T @ (share * (p - y)) + 0.1 * beta)
        beta -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return beta


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of TRAIN_ROWS labelled documents of each label value that are not held out, by the hash of doc_id.

    Rows with a null doc_id or label and labels of no document are passed over; of repeated labels the larger counts,
    of repeated documents one.  Texts are read whole.  Label values of which not all documents are drawn are weighted
    up to all of them.  None where ``labels`` holds one value only; an error where it holds both and the documents do not.
    """
    ship(docs.sparkSession)
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    usable = known.filter(~held_out(F.col("doc_id"))).join(docs.select("doc_id"), "doc_id", "left_semi")
    usable = stored(usable.withColumn("draw", F.xxhash64("doc_id")), "toxic-labels")
    total = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    if set(total) != {0, 1}:
        kinds = {r.toxic for r in known.select("toxic").distinct().collect()}
        if kinds - {0, 1}:
            raise ValueError(f"labels other than 0 and 1: {sorted(kinds - {0, 1})[:5]}")
        if len(kinds) < 2 or docs.isEmpty():
            return None
        raise ValueError(f"labels are toxic and harmless, but those of documents that are not held out are not: {total}")
    drawn = np.array([min(TRAIN_ROWS, total[k]) for k in (0, 1)])
    share = np.array([total[0], total[1]]) / drawn
    one, other = (usable.filter(F.col("toxic") == k).orderBy("draw", "doc_id").limit(TRAIN_ROWS) for k in (0, 1))
    sample = one.union(other)  # a bounded table: it may be broadcast
    texts = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = stored(texts.groupBy("doc_id", "draw", "toxic").agg(F.min("text").alias("text")), "toxic-sample")
    model = Model(telling(texts, drawn, share), np.zeros(0), 0.0, np.full((2, 2), 0.5), np.zeros(4))
    model = field(texts, model)
    model.document = document_weights(texts, model, share)
    return model


def telling(texts: DataFrame, drawn: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Sorted hashes of the words and beginnings that toxic texts hold far more often than others do."""

    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for first, rows in text_slices(batch.column(0), 4 << 20):
                keys, bad, good = feature_counts(rows, toxic[first : first + len(rows)])
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bad), pa.array(good)], names=["key", "bad", "good"])

    rate, bad, good = float(drawn[1] / drawn.sum()), F.col("bad"), F.col("good")
    held = texts.select("text", "toxic").mapInArrow(run, "key long, bad long, good long").filter("key != 0")
    held = held.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    held = held.withColumn("excess", (bad - rate * (bad + good) - 1) / F.sqrt(rate * (1 - rate) * (bad + good)))
    held = held.filter((F.col("excess") >= DEVIATIONS) & (bad * float(share[1]) >= SHARE * (bad * float(share[1]) + good * float(share[0]))))
    keys = [r.key for r in held.orderBy(F.desc("excess"), "key").select("key").limit(FEATURES).collect()]
    return np.sort(np.array(keys or [-1], np.int64).view(np.uint64))


def field(texts: DataFrame, model: Model) -> Model:
    """``model`` with the weights of its features, bias and transitions, fitted in one task on the places of features."""

    def places(batches):
        for batch in batches:
            for first, rows in text_slices(batch.column(3)):
                words, features, counts = [], [], []
                for text in rows:
                    data, starts, ends, count = words_of([text])
                    hits = [model.indices(h) for h in feature_hashes(data, starts, ends)]
                    words.append(np.concatenate([h[0] for h in hits]))
                    features.append(np.concatenate([h[1] for h in hits]))
                    counts.append(int(count[0]))
                of_rows = [batch.column(i).slice(first, len(rows)) for i in range(3)]
                lists = [pa.array([x.astype(np.int32) for x in some], pa.list_(pa.int32())) for some in (words, features)]
                yield pa.RecordBatch.from_arrays([*of_rows, pa.array(counts, pa.int32()), *lists], names=["doc_id", "draw", "toxic", "n", "words", "features"])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("draw", "ascending"), ("doc_id", "ascending")])
        toxic = rows.column("toxic").to_numpy()
        # as many harmless texts as toxic ones are enough for the field
        bad = np.flatnonzero(toxic == 1)
        use = np.sort(np.concatenate([bad, np.flatnonzero(toxic == 0)[: len(bad)]]))
        rows = rows.take(pa.array(use))
        lists = [[x.values.to_numpy() for x in rows.column(c)] for c in ("words", "features")]
        found = fit_field(rows.column("n").to_numpy().astype(np.int64), toxic[use], list(zip(*lists)), len(model.keys))
        return pa.table({"field": pa.array([pickle.dumps(found)], pa.binary())})

    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "draw", "toxic", "text").mapInArrow(places, f"doc_id {id_type}, draw long, toxic long, n int, words array<int>, features array<int>")
    found = found.groupBy(F.lit(1).alias("all")).applyInArrow(run, "field binary").collect()
    return Model(model.keys, *pickle.loads(found[0]["field"]), model.document)


def document_weights(texts: DataFrame, model: Model, share: np.ndarray) -> np.ndarray:
    """Weights of the document features in the score, fitted in one task on the features of each text."""

    def features(batches):
        for batch in batches:
            for first, rows in text_slices(batch.column(3)):
                data, starts, ends, counts = words_of(rows)
                marginal, _, _ = forward_backward(model.potentials(feature_hashes(data, starts, ends)), model.transition, firsts(counts))
                found = document_features(marginal, counts)
                of_rows = [batch.column(i).slice(first, len(rows)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*of_rows, *(pa.array(found[:, i]) for i in range(4))], names=["doc_id", "draw", "toxic", "a", "b", "c", "d"])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("draw", "ascending"), ("doc_id", "ascending")])
        toxic = rows.column("toxic").to_numpy()
        beta = logistic(np.stack([rows.column(c).to_numpy() for c in "abcd"], 1), toxic, share[toxic])
        return pa.table({"beta": pa.array([beta.tolist()], pa.list_(pa.float64()))})

    id_type = texts.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "draw", "toxic", "text").mapInArrow(features, f"doc_id {id_type}, draw long, toxic long, a double, b double, c double, d double")
    return np.array(found.groupBy(F.lit(1).alias("all")).applyInArrow(run, "beta array<double>").collect()[0]["beta"])


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, spans of every row of ``docs``; whole texts, in slices of some megabytes.

    A null text is empty; texts without words get the score of a text without toxic words.  Without a model every score is 0.
    Repeated rows and null doc_ids get a row each; other columns play no part.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                score, spans = model.judge(texts) if model else (np.zeros(len(texts)), [[] for _ in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(score, pa.float64()), pa.array(spans, SPANS)], names=["doc_id", "score", "spans"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(run, RESULT)


def harmless(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with all their columns as they are."""
    model = train(docs, labels)
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            scores = [model.judge(rows)[0] if model else np.zeros(len(rows)) for _, rows in text_slices(texts)]
            keep = np.concatenate([*scores, np.zeros(0)]) < cut
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score_documents(docs, train(docs, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "spans")


def rejected_share(spark, sf_dir: str) -> DataFrame:
    """Counts of (label, predicted) among held-out documents: a quick look at the quality."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return op5_toxicity(spark, sf_dir).filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count()
