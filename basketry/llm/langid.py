"""Language identification by a linear-chain conditional random field.

Each word of a text is a position of the chain, each learned language a label.
A word's features are its character n-grams of 2 to 4 bytes with the word's
borders (so n-grams at a border are its affixes) and, if it is in the learned
lexicon, itself.  Feature weights and label transitions are learned together
on chains of runs from different documents, so the model has seen switches.
Forward-backward gives each word's label probabilities; a document's language
is the label with the largest expected share of words, that share its score.

Training uses a bounded sample: at most ``SAMPLE`` distinct texts per language
value, the smallest by text hash, whole, and ``SAMPLE_BYTES`` of text together
(a language whose texts are all longer than its part of that is not learned).  Every document is predicted from all
of its text, in blocks of words whose transfer matrices are multiplied, so a
very long text takes no longer per word than a short one.

Defined results: a null text or one without letters is ``und`` with score 0;
ties go to the first label in order; with no labelled document at all every
text is ``und``; repeated rows keep a row each; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SAMPLE = 400
#: Bytes of all sampled texts together, in even parts for the languages.
SAMPLE_BYTES = 32 << 20
LEXICON_DOCS = 5
EPOCHS = 3
CHAIN = 64
BLOCK = 64
BATCH_BYTES = 1 << 19
#: Hash bits of the 2-, 3- and 4-byte n-gram tables and of the lexicon table.
BITS = {2: 16, 3: 17, 4: 18}
LEX_BITS = 17
UNKNOWN = "und"

_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_ASCII_LETTER = re.compile(r"[A-Za-z]")
_P = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _plain(text: str) -> bytes:
    """Lower-case UTF-8 with every ASCII non-letter made a space."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS)


@dataclass
class Words:
    """Words of some texts: document of each, n-gram rows and their words, and
    64-bit word hashes."""
    doc: np.ndarray
    grams: list[tuple[np.ndarray, np.ndarray]]  # per n: (hashed row, word), by word
    hashes: np.ndarray


def featurize(texts: list[bytes]) -> Words:
    """``texts`` as from ``_plain``."""
    raw = np.frombuffer(b" " + b"  ".join(texts) + b"    ", np.uint8)
    space = raw == 0x20
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    word = np.zeros(len(raw), np.int32)
    word[starts] = 1
    word = np.cumsum(word, dtype=np.int32) - 1
    ends = np.cumsum([1, *[len(t) + 2 for t in texts]])
    doc = np.searchsorted(ends, starts, side="right") - 1
    wide = raw.astype(np.uint32)
    grams = []
    for n, bits in BITS.items():
        m = len(raw) - n + 1
        code = wide[:m].copy()
        for k in range(1, n):
            code |= wide[k:m + k] << np.uint32(8 * k)
        inner = space[:m] & space[1:m + 1] if n == 2 else space[1:m + 1] | (space[2:m + 2] if n == 4 else False)
        at = np.flatnonzero(~inner)
        code = code[at]
        if n > 2:
            code = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
        owner = word[at + 1]
        if n == 2:  # a letter then a space belongs to the letter's word
            owner = np.where(space[at], word[at + 1], word[at])
        grams.append((code.astype(np.int32), owner))
    letters = np.flatnonzero(~space)
    owner = word[letters]
    place = letters - starts[owner] if len(starts) else letters
    power = np.cumprod(np.full(int(place.max(initial=0)) + 1, _P | np.uint64(1)))
    hashes = np.add.reduceat((raw[letters].astype(np.uint64) + np.uint64(1)) * power[place],
                             np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])) if len(letters) else \
        np.empty(0, np.uint64)
    return Words(doc, grams, hashes)


def _together(parts: list[Words], texts: int) -> Words:
    """The words of lists of ``texts`` texts each as of one list."""
    first = np.cumsum([0, *[len(p.hashes) for p in parts]]).astype(np.int32)
    return Words(np.concatenate([p.doc + texts * i for i, p in enumerate(parts)]),
                 [(np.concatenate([p.grams[k][0] for p in parts]),
                   np.concatenate([p.grams[k][1] + f for p, f in zip(parts, first)])) for k in range(len(BITS))],
                 np.concatenate([p.hashes for p in parts]))


def _lex_slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _P) >> np.uint64(64 - LEX_BITS)).astype(np.int64)


@dataclass
class Model:
    labels: list[str]
    tables: list[np.ndarray]     # per n: (2^bits, labels)
    lex_hash: np.ndarray         # 64-bit hash in each slot, 0 if free
    lex: np.ndarray              # (slots, labels)
    move: np.ndarray             # (labels, labels) transition weights

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each label for each word."""
        n = len(words.hashes)
        out = np.zeros((n, len(self.labels)), np.float32)
        if not n:
            return out
        for table, (row, owner) in zip(self.tables, words.grams):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            out[owner[first]] += np.add.reduceat(table[row], first, axis=0)
        slot = _lex_slot(words.hashes)
        out += np.where((self.lex_hash[slot] == words.hashes)[:, None], self.lex[slot], 0)
        return out


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Label probabilities of every word by forward-backward.  ``scores`` holds
    the words of all texts in a row, ``lengths`` the words of each text."""
    k = scores.shape[1]
    blocks_of = -(-lengths // BLOCK)
    n_blocks = int(blocks_of.sum())
    if not n_blocks:
        return np.zeros((0, k))
    text_first = np.r_[0, np.cumsum(blocks_of)[:-1]]
    word_first = np.r_[0, np.cumsum(lengths)[:-1]]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(scores)) - word_first[owner]
    block, step = text_first[owner] + place // BLOCK, place % BLOCK
    real = np.zeros((BLOCK, n_blocks), bool)
    real[step, block] = True
    emit = np.ones((BLOCK, n_blocks, k))
    emit[step, block] = np.exp(scores - scores.max(axis=1, keepdims=True))
    trans = np.exp(move - move.max())
    # transfer matrix of each block; padded steps leave it as it is
    through = np.broadcast_to(np.eye(k), (n_blocks, k, k)).copy()
    for t in range(BLOCK):
        on = np.flatnonzero(real[t])
        if not len(on):
            break
        m = (through[on].reshape(-1, k) @ trans).reshape(-1, k, k) * emit[t, on][:, None, :]
        through[on] = m / np.maximum(m.max(axis=(1, 2), keepdims=True), 1e-300)
    # messages at block borders, over the texts' n-th blocks together
    enter, leave = np.full((n_blocks, k), 1.0 / k), np.full((n_blocks, k), 1.0 / k)
    order = np.argsort(-blocks_of, kind="stable")
    most = int(blocks_of.max())
    alive = np.searchsorted(-blocks_of[order], -np.arange(most), side="left")  # texts with more than b blocks
    for b in range(1, most):
        at = text_first[order[:alive[b]]] + b
        enter[at] = _scaled(np.einsum("nk,nkj->nj", enter[at - 1], through[at - 1]))
    for b in range(most - 2, -1, -1):
        at = text_first[order[:alive[b + 1]]] + b
        leave[at] = _scaled(np.einsum("nkj,nj->nk", through[at + 1], leave[at + 1]))
    # inside the blocks
    ahead, state = np.empty((BLOCK, n_blocks, k)), enter
    for t in range(BLOCK):
        state = np.where(real[t][:, None], _scaled((state @ trans) * emit[t]), state)
        ahead[t] = state
    state = leave
    for t in range(BLOCK - 1, -1, -1):
        both = _scaled(ahead[t] * state)
        state = np.where(real[t][:, None], _scaled((state * emit[t]) @ trans.T), state)
        ahead[t] = both
    return ahead[step, block]


def fit(texts: list[str], langs: list[str], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Learns weights and transitions on the sampled texts (on the driver; the
    sample is bounded)."""
    labels = sorted(set(langs))
    k = len(labels)
    rng = np.random.default_rng(seed)
    words = _together([featurize([_plain(t) for t in texts[i:i + 100]]) for i in range(0, max(1, len(texts)), 100)], 100)
    gold_doc = np.array([labels.index(x) for x in langs], np.int64)
    gold = gold_doc[words.doc] if len(words.doc) else np.empty(0, np.int64)
    model = Model(labels, [np.zeros((1 << b, k), np.float32) for b in BITS.values()],
                  np.zeros(1 << LEX_BITS, np.uint64), np.zeros((1 << LEX_BITS, k), np.float32),
                  np.zeros((k, k)))
    # lexicon: words of at least LEXICON_DOCS texts
    seen = np.unique(np.stack([words.hashes, words.doc.astype(np.uint64)]), axis=1)[0]
    values, counts = np.unique(seen, return_counts=True)
    lexicon = values[counts >= LEXICON_DOCS]
    model.lex_hash[_lex_slot(lexicon)] = lexicon
    # chains: runs of 8 to 40 words of one text, in random order
    cuts, at = [], 0
    for n in np.bincount(words.doc, minlength=len(texts)):
        left = int(n)
        while left:
            take = min(left, int(rng.integers(8, 41)))
            cuts.append((at, take))
            at, left = at + take, left - take
    stream = np.concatenate([np.arange(*(cuts[i][0], sum(cuts[i]))) for i in rng.permutation(len(cuts))]) \
        if cuts else np.empty(0, np.int64)
    chains = stream[:len(stream) // CHAIN * CHAIN].reshape(-1, CHAIN) if len(stream) >= CHAIN else \
        np.empty((0, CHAIN), np.int64)
    first = [np.searchsorted(owner, np.arange(len(gold) + 1)).astype(np.int32) for _, owner in words.grams]
    words.grams = [(row, None) for row, _ in words.grams]  # the starts stand for the owners
    lex_slot = _lex_slot(words.hashes)
    lex_hit = model.lex_hash[lex_slot] == words.hashes
    tables = [*model.tables, model.lex]
    squares = [np.full_like(t, 1e-6) for t in tables]
    move_squares = np.full((k, k), 1e-6)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(chains)), max(1, len(chains) // 64)):
            if not len(part):
                continue
            token = chains[part].reshape(-1)
            n = len(token)
            score = np.where(lex_hit[token][:, None], model.lex[lex_slot[token]], 0).astype(np.float64)
            used = []
            for (row, _), start, table in zip(words.grams, first, model.tables):
                size = start[token + 1] - start[token]
                local = np.repeat(np.arange(n), size)
                idx = row[np.repeat(start[token] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())]
                used.append((idx, local))
                for j in range(k):
                    score[:, j] += np.bincount(local, table[idx, j], n)
            emit = np.exp(score - score.max(axis=1, keepdims=True)).reshape(-1, CHAIN, k)
            trans = np.exp(model.move)
            ahead = np.empty_like(emit)
            state = np.full((len(part), k), 1.0 / k)
            for t in range(CHAIN):
                state = _scaled((state @ trans if t else state) * emit[:, t])
                ahead[:, t] = state
            node, back = np.empty_like(emit), np.ones((len(part), k))
            pairs = np.zeros((k, k))
            for t in range(CHAIN - 1, -1, -1):
                node[:, t] = _scaled(ahead[:, t] * back)
                if t:
                    right = emit[:, t] * back
                    joint = ahead[:, t - 1][:, :, None] * trans[None] * right[:, None, :]
                    pairs += (joint / np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)
                    back = _scaled(right @ trans.T)
            want = gold[token].reshape(-1, CHAIN)
            grad = node.reshape(n, k)
            grad[np.arange(n), gold[token]] -= 1
            np.subtract.at(pairs, (want[:, :-1].ravel(), want[:, 1:].ravel()), 1)
            pairs /= n
            move_squares += pairs ** 2
            model.move -= 0.2 * pairs / np.sqrt(move_squares)
            hit = np.flatnonzero(lex_hit[token])
            used.append((lex_slot[token[hit]], hit))
            for (idx, local), table, square in zip(used, tables, squares):
                rows, where = np.unique(idx, return_inverse=True)
                g = np.stack([np.bincount(where, grad[local, j], len(rows)) for j in range(k)], axis=1) / n \
                    if len(rows) else np.zeros((0, k))
                square[rows] += g ** 2
                table[rows] -= (0.1 * (g / np.sqrt(square[rows]) + 1e-3 * table[rows])).astype(np.float32)
    return model


def label_texts(texts: list[str | None], model: Model, spans: bool = False, certainty: bool = False):
    """(label, score) per text; with ``spans`` also the runs of words with one
    most probable label, as lists of (label, first word, words); with
    ``certainty`` also how far the words' best marginals are above chance on
    average (0 to 1; 1 if there is one label)."""
    out = [(UNKNOWN, 0.0, [], 0.0)[:4 if certainty else 3]] * len(texts)
    usable = [i for i, t in enumerate(texts) if model.labels and has_letter(t)]
    at = 0
    while at < len(usable):
        part, size = [], 0
        while at < len(usable) and (not part or size < BATCH_BYTES):
            part.append((usable[at], _plain(texts[usable[at]])))
            size += len(part[-1][1])
            at += 1
        words = featurize([p for _, p in part])
        lengths = np.bincount(words.doc, minlength=len(part))
        prob = marginals(model.emissions(words), lengths, model.move)
        share = np.stack([np.bincount(words.doc, prob[:, j], len(part)) for j in range(len(model.labels))], axis=1) \
            / np.maximum(lengths, 1)[:, None]
        best = share.argmax(axis=1)
        top = prob.argmax(axis=1) if spans else None
        k = len(model.labels)
        sure = np.bincount(words.doc, prob.max(axis=1), len(part)) / np.maximum(lengths, 1)
        sure = (sure - 1 / k) / (1 - 1 / k) if k > 1 else np.ones(len(part))
        first = np.r_[0, np.cumsum(lengths)]
        for j, (i, _) in enumerate(part):
            runs = []
            if spans:
                mine = top[first[j]:first[j + 1]]
                cut = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else np.empty(0, int)
                runs = [(model.labels[mine[c]], int(c), int(n)) for c, n in zip(cut, np.diff(np.r_[cut, len(mine)]))]
            if lengths[j]:
                out[i] = (model.labels[best[j]], float(min(1.0, share[j, best[j]])), runs,
                          float(min(1.0, max(0.0, sure[j]))))[:4 if certainty else 3]
    return out


def training_sample(docs: DataFrame, lang: str = "lang", text: str = "text", limit: int = SAMPLE,
                    most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``limit`` distinct texts per language value, smallest hash first,
    and at most ``most_bytes`` of text for all languages together."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    every = rows.groupBy("lang", "h").agg(F.max(F.octet_length("text").cast("long")).alias("size"))
    room = F.lit(most_bytes) / F.greatest(F.lit(1), every.select(F.count_distinct("lang")).scalar())
    distinct = every.filter(F.col("size") <= room)
    # about twice the limit by a share of the hash range, then exactly the smallest; a row per language, broadcast
    # so that only what the share leaves is dealt by language
    share = distinct.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(2.0 * limit) / F.count("*")).alias("share"))
    place = (F.pmod("h", F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("place")
    few = (distinct.select("lang", "h", "size", place).join(F.broadcast(share), "lang").filter(F.col("place") <= F.col("share"))
           .withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("place", "h"))).filter(F.col("r") <= limit)
           .withColumn("used", F.sum("size").over(W.partitionBy("lang").orderBy("r"))).filter(F.col("used") <= room)
           .select("lang", "h"))  # bounded by limit and the number of languages
    return rows.join(F.broadcast(few), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))


def train(labelled: DataFrame, limit: int = SAMPLE) -> Model:
    rows = training_sample(labelled, limit=limit).orderBy("lang", "h").collect()
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: Model, text: str = "text", spans: bool = False, out: str = "language") -> DataFrame:
    """Adds to every row a struct ``out`` of ``lang_pred``, ``score``, ``certainty`` and
    ``lang_spans`` (runs of words of one language, if asked for), from its text
    alone.  A column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kind = "struct<lang_pred:string,score:double,certainty:double,lang_spans:array<struct<lang:string,first_word:int,n_words:int>>>"

    @F.pandas_udf(kind)
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = label_texts(batch.tolist(), shared.value, spans, certainty=True)
            yield pd.DataFrame({"lang_pred": [g[0] for g in got], "score": [g[1] for g in got],
                                "certainty": [g[3] for g in got],
                                "lang_spans": [[{"lang": a, "first_word": b, "n_words": c} for a, b, c in g[2]]
                                               for g in got]})
    return docs.withColumn(out, label(F.col(text)))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op5``: trained on the documents not held out."""
    model = train(docs.filter(~held_out()).select("lang", "text"))
    rows = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "language.lang_pred", "language.score")
