"""Toxicity by multiple-instance learning: documents are bags of sentences.

A sentence's score is a logistic function of the summed scores of its distinct
words; a word's score is the sum of the weights of its features (the word, its
first 3 to 6 and its last 4 characters), so words made of a known stem are
recognised.
A document is toxic if any of its sentences is: its score is the noisy-or
1 - Π(1 - p) of its sentences.  Only documents carry labels; the gradient of
their likelihood is shared among the sentences by what each adds to the
noisy-or, and so the model learns which sentences offend, and ``sentences``
returns them.

Sentences end at ``.!?`` (also full-width) or a line break, and after
``LONGEST`` words.  Training uses a bounded sample: at most ``SAMPLE`` texts of
either label, smallest hash first, of ``SAMPLE_BYTES`` together; a label's
texts weigh as much together as they do in the whole table.  Every document is
scored from all of its text.

Defined results: a null or empty text, and one without words, has no
sentences, and its score is 0; a document with several labels is toxic if one
says so; a null label says nothing; without documents of both labels every
score is 0; repeated rows keep a row each; an empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_key, written

THRESHOLD = 0.3
SAMPLE = 4000
SAMPLE_BYTES = 12 << 20
LONGEST = 16
BITS = 18
#: Passes over the sample, texts of a step, AdaGrad's rate, what its squares
#: start from, pull towards zero, and texts in which a feature must occur.
EPOCHS = 12
BATCH = 128
RATE = 1.0
FLOOR = 1e-2
DECAY = 1e-3
LEAST_DOCS = 3
PREFIXES = (3, 4, 5, 6)
SUFFIX = 4
#: Words whose scores a worker keeps at a time, and words scored together.
CACHE = 1 << 18
CHUNK = 1 << 16

_SENTENCE = re.compile(r"[^.!?\n。！？]+")
_WORD = re.compile(r"\w+")


def word_features(words: list[str]) -> np.ndarray:
    """Hashed features, one row per word: the word itself, prefixes, suffix."""
    from xxhash import xxh64_intdigest
    top = (1 << BITS) - 1
    rows = [[xxh64_intdigest(w, 1) & top, *[xxh64_intdigest(w[:k], k) & top for k in PREFIXES],
             xxh64_intdigest(w[-SUFFIX:], 2) & top] for w in words]
    return np.array(rows, np.int32).reshape(len(words), len(PREFIXES) + 2)


def sentences_of(text: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, distinct lower-case words) of every instance of a text, in
    code points."""
    for s in _SENTENCE.finditer(text or ""):
        words = _WORD.findall(s.group())
        if len(words) <= LONGEST:
            if words:
                yield s.start(), s.end(), list(dict.fromkeys([w.lower() for w in words]))
            continue
        part = []
        for w in _WORD.finditer(s.group()):
            part.append(w)
            if len(part) == LONGEST:
                yield _instance(s.start(), part)
                part = []
        if part:
            yield _instance(s.start(), part)


def _instance(at: int, words: list[re.Match]) -> tuple[int, int, list[str]]:
    return at + words[0].start(), at + words[-1].end(), list(dict.fromkeys([w.group().lower() for w in words]))


@dataclass
class Model:
    """Feature weights and the sentences' common bias; without weights every
    score is 0.  Of fixed size."""
    weights: np.ndarray | None = None
    bias: float = 0.0
    cache: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "cache": {}}

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Scores of a chunk of words; new words are scored together."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.cache]
        if new:
            self.cache.update(zip(new, self.weights[word_features(new)].sum(axis=1).tolist()))
        return np.fromiter(map(self.cache.__getitem__, words), np.float64, len(words))

    def sentence_scores(self, text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(spans, scores) of a text's instances, some at a time."""
        spans, words, sizes = [], [], []

        def scored():
            z = np.add.reduceat(self.word_scores(words), np.r_[0, np.cumsum(sizes)[:-1]]) + self.bias
            return np.array(spans), 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
        if self.weights is None:
            return
        for start, end, own in sentences_of(text):
            spans.append((start, end))
            words += own
            sizes.append(len(own))
            if len(words) >= CHUNK:
                yield scored()
                spans, words, sizes = [], [], []
        if sizes:
            yield scored()

    def score(self, text: str | None) -> float:
        clean = sum(float(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()) for _, p in self.sentence_scores(text))
        return float(-np.expm1(clean))


def fit(texts: list[str], toxic: list[int], share: tuple[float, float] | None = None, seed: int = 3) -> Model:
    """Learns the model from whole texts and their labels; ``share`` is the two
    labels' part of all documents (default: as in the sample)."""
    y = np.array(toxic, bool)
    if y.all() or not y.any():
        return Model()
    ids: dict[str, int] = {}
    token, size, doc = [], [], []
    for i, t in enumerate(texts):
        for _, _, words in sentences_of(t):
            token.append(np.array([ids.setdefault(w, len(ids)) for w in words], np.int32))
            size.append(len(words))
            doc.append(i)
    if not token:
        return Model()
    token, size, doc = np.concatenate(token), np.array(size), np.array(doc)
    feats = word_features(list(ids))
    del ids
    # features of fewer than LEAST_DOCS texts go to one place that stays zero
    seen = np.unique(np.repeat(doc, size).astype(np.int64) * len(feats) + token)
    docs_with = np.zeros(1 << BITS, np.int64)
    for column in feats.T:
        at = np.unique((seen // len(feats)) << BITS | column[seen % len(feats)])
        docs_with += np.bincount(at & ((1 << BITS) - 1), minlength=1 << BITS)
    del seen, at
    feats = np.where(docs_with[feats] >= LEAST_DOCS, feats, 1 << BITS)
    first_sentence = np.searchsorted(doc, np.arange(len(texts) + 1))
    first_token = np.r_[0, np.cumsum(size)]
    part = (1 - y.mean(), y.mean()) if share is None else share
    weight = np.where(y, part[1] / y.mean(), part[0] / (1 - y.mean()))
    w, squares = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, FLOOR)
    bias, bias_squares = -6.0, 1e-2
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            spans = [np.arange(first_sentence[d], first_sentence[d + 1]) for d in some]
            sent = np.concatenate(spans)
            if not len(sent):
                continue
            of = np.repeat(np.arange(len(some)), [len(x) for x in spans])
            n_words = size[sent]
            where = np.repeat(np.arange(len(sent)), n_words)
            start = np.repeat(first_token[sent] - np.r_[0, np.cumsum(n_words)[:-1]], n_words)
            vocab, word = np.unique(token[start + np.arange(n_words.sum())], return_inverse=True)
            score = w[feats[vocab]].sum(axis=1)
            z = bias + np.bincount(where, score[word], len(sent))
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            clean = np.bincount(of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(some))
            bag = np.maximum(-np.expm1(clean), 1e-9)
            # d(-log likelihood)/dz: p for a clean document, -p·(1-P)/P for a toxic one
            grad = np.where(y[some], -np.exp(clean) / bag, 1.0)[of] * p * weight[some][of] / len(some)
            rows, place = np.unique(feats[vocab], return_inverse=True)
            per_word = np.bincount(word, grad[where], len(vocab))
            g = np.bincount(place.ravel(), np.repeat(per_word, feats.shape[1]), len(rows)) + DECAY / len(some) * w[rows]
            squares[rows] += g ** 2
            w[rows] -= RATE * g / np.sqrt(squares[rows])
            w[-1] = 0.0
            bias_squares += grad.sum() ** 2
            bias -= RATE * grad.sum() / np.sqrt(bias_squares)
    return Model(w[:-1].astype(np.float32), float(bias))


def marks(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` (0 or 1) of the documents with a label."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    return known.filter("toxic is not null")


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model:
    """The model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``: the
    labelled texts with the smallest hashes, at most ``limit`` of each label and
    ``most_bytes`` together.  Only keys and sizes of texts are joined to the
    labels; of the texts themselves, no others than the sample's are moved."""
    docs = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", text_key().alias("key"))
    keys = written(docs.select("doc_id", "key", F.octet_length("text").cast("long").alias("size"))
                   .join(marks(labels), "doc_id").groupBy("toxic", "key")
                   .agg(F.count("*").alias("n"), F.max("size").alias("size")), "mil-keys")
    total = {r["toxic"]: (r["n"], r["texts"]) for r in keys.groupBy("toxic").agg(
        F.sum("n").alias("n"), F.count("*").alias("texts")).collect()}  # one row per label
    if len(total) < 2:
        return Model()
    # about twice the limit by a share of the hash range, then exactly the smallest
    part = F.create_map(*[F.lit(x) for y, (_, n) in total.items() for x in (y, min(1.0, 2.0 * limit / n))])
    place = F.pmod("key", F.lit(1 << 53)) / F.lit(float(1 << 53))
    low = keys.withColumn("place", place).filter(F.col("place") <= part[F.col("toxic")]).select(
        "place", "key", "toxic", "size").limit(16 * limit).collect()
    chosen, used, taken = [], 0, {0: 0, 1: 0}
    for r in sorted(low):
        if taken[r["toxic"]] < limit and used + r["size"] <= most_bytes:
            used += r["size"]
            taken[r["toxic"]] += 1
            chosen.append((r["key"], r["toxic"]))
    if not chosen:
        return Model()
    wanted = docs.sparkSession.createDataFrame(sorted({(k,) for k, _ in chosen}), "key long")
    texts = dict(docs.select("key", "text").join(F.broadcast(wanted), "key").groupBy("key").agg(
        F.min("text").alias("text")).collect())
    n = sum(a for a, _ in total.values())
    return fit([texts[k] for k, _ in chosen], [y for _, y in chosen], (total[0][0] / n, total[1][0] / n))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity",
          threshold: float = THRESHOLD) -> DataFrame:
    """Adds a struct ``out``: ``score`` of the whole text, and ``sentences``: start
    and length (code points) and score of each that reaches ``threshold``.  A
    column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kind = "struct<score:double,sentences:array<struct<start:int,length:int,score:double>>>"

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores, found = [], []
            for t in batch:
                clean, bad = 0.0, []
                for spans, p in shared.value.sentence_scores(t):
                    clean += float(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())
                    bad += [{"start": int(a), "length": int(b - a), "score": float(x)}
                            for (a, b), x in zip(spans[p >= threshold], p[p >= threshold])]
                scores.append(float(-np.expm1(clean)) if clean else 0.0)
                found.append(bad)
            yield pd.DataFrame({"score": scores, "sentences": found})
    return docs.withColumn(out, judge(F.col(text)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of ``op12``, and the offending sentences."""
    model = train(docs.filter(~held_out()), labels)
    rows = score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "toxicity.score",
                       (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"), "toxicity.sentences")
