"""Edit-aware token counts: a segment tree of pre-token blocks per document.

Pre-tokens are encoded independently of each other (an added token of the
vocabulary file is a pre-token of its own, with one id), so a document's token
count is the sum over its pre-tokens.  A document's state is a segment tree
whose leaves are blocks of ``LEAF`` consecutive pre-tokens with their length in
characters and their tokens; inner nodes hold the sums.  An edit (start,
length, replacement) descends by characters to the blocks it touches, steps
back over the boundary context, pre-tokenizes the new text from that block's
start until a pre-token border falls on the border of an untouched block, and
encodes only those pre-tokens; the leaves' sums then go up the tree.

The state is a table (``doc_id, text, tree_chars, tree_tokens``) that is kept
between rounds of edits.  Edits of one document apply in order, each in the
coordinates of the text it meets; starts and lengths are clipped to the text.

Defined results: a null text is empty (0 tokens) and stays editable; null
start, length or replacement count as 0, 0 and empty; documents without edits
keep their state; edits of unknown documents are ignored; repeated documents
each get the edits of their id; an empty table gives no rows; other columns
are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .encode import Encoder, encoder

LEAF = 32
#: A border that lies this many characters, and the longest added token's,
#: before an edit cannot move: the longest look-ahead of the pre-token pattern
#: is two characters, and an edit may complete or break an added token.
CONTEXT = 3

STATE = "text string, tree_chars array<int>, tree_tokens array<int>, n_tokens long, n_encoded long, n_edits long"


class CountTree:
    """Segment tree over the blocks of one document; ``chars`` and ``tokens``
    are heaps: node k has children 2k and 2k+1, leaves stand in the last half."""

    def __init__(self, text: str, code: Encoder, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.text, self.code, self.encoded = text, code, 0
        if chars is None:
            self._build(self._blocks(*self._scan(text)))
        else:
            self.chars, self.tokens, self.half = chars, tokens, len(chars) // 2

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _scan(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of each pre-token."""
        chars, tokens = [], []
        for k, part in enumerate(self.code.parts(text)):
            if k % 2:
                chars.append(len(part))
                tokens.append(1)
                continue
            found = self.code.split.findall(part)
            chars += map(len, found)
            tokens += self.code.counts(found)
        self.encoded += len(chars)
        return chars, tokens

    @staticmethod
    def _blocks(chars: list[int], tokens: list[int], n: int | None = None) -> list[tuple[int, int]]:
        """Sums of consecutive pre-tokens: blocks of about LEAF, or ``n`` even ones
        (which may be empty)."""
        n = n or -(-len(chars) // LEAF)
        cuts = [len(chars) * k // n for k in range(n + 1)] if n else [0]
        return [(sum(chars[i:j]), sum(tokens[i:j])) for i, j in zip(cuts, cuts[1:])]

    def _build(self, blocks: list[tuple[int, int]]) -> None:
        self.half = 1 << max(0, len(blocks) - 1).bit_length()
        pad = [(0, 0)] * (self.half - len(blocks))
        self.chars = [0] * self.half + [a for a, _ in blocks + pad]
        self.tokens = [0] * self.half + [b for _, b in blocks + pad]
        for k in range(self.half - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _find(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) of the block that holds character ``at``
        (the last used block for the end of the text)."""
        k, first = 1, 0
        at = min(at, self.chars[1] - 1)
        while k < self.half:
            k *= 2
            if at >= first + self.chars[k]:
                first += self.chars[k]
                k += 1
        return k - self.half, first

    def edit(self, start: int, length: int, new: str) -> None:
        old = len(self.text)
        start = min(max(0, start), old)
        length = min(max(0, length), old - start)
        self.text = self.text[:start] + new + self.text[start + length:]
        if not old:
            self._build(self._blocks(*self._scan(self.text)))
            return
        low, first = self._find(max(0, start - CONTEXT - self.code.longest))
        high, _ = self._find(start + length)
        shift = len(new) - length
        # go on until a pre-token ends where, moved by the shift, an old block at or after ``high`` ends
        chars, tokens, leaf, end = [], [], low, first + self.chars[self.half + low]
        last = self.half - 1
        for begin, stop, count in self.code.borders(self.text, first):
            chars.append(stop - begin)
            tokens.append(count)
            while leaf < self.half - 1 and (leaf < high or end + shift < stop):
                leaf += 1
                end += self.chars[self.half + leaf]
            if leaf >= high and end + shift == stop >= start + len(new):
                last = leaf
                break
        self.encoded += len(chars)
        span = last - low + 1
        blocks = self._blocks(chars, tokens, span) if chars else [(0, 0)] * span
        if len(chars) > 8 * LEAF * span:  # grown far beyond the leaves: lay the blocks out anew, encoding nothing
            kept = list(zip(self.chars[self.half:], self.tokens[self.half:]))
            self._build([b for b in kept[:low] + self._blocks(chars, tokens) + kept[last + 1:] if b[0]])
            return
        for leaf, (a, b) in zip(range(low, last + 1), blocks):
            self.chars[self.half + leaf], self.tokens[self.half + leaf] = a, b
        touched = range((self.half + low) // 2, (self.half + last) // 2 + 1)
        while touched.stop > 1:
            for k in touched:
                if k:
                    self._sum(k)
            touched = range(touched.start // 2, (touched.stop - 1) // 2 + 1)


def build_state(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """State of every document: ``doc_id``, ``text`` and its count tree, with
    ``n_tokens`` and the ``n_encoded`` pre-tokens."""
    return _each(docs.select("doc_id", F.col("text"), F.lit(None).cast("array<int>").alias("tree_chars"),
                             F.lit(None).cast("array<int>").alias("tree_tokens"),
                             F.lit(None).cast("array<struct<start:int,length:int,new:string>>").alias("edits")),
                 vocabulary)


def apply_edits(state: DataFrame, edits: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """The state after ``edits(doc_id, seq, start, length, new)``; ``n_encoded``
    counts the pre-tokens that this round encoded."""
    e = F.struct("seq", F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length"),
                 F.col("new").alias("new"))
    lists = edits.groupBy(F.col("doc_id").alias("_id")).agg(F.array_sort(F.collect_list(e)).alias("e"))
    lists = lists.select("_id", F.transform("e", lambda x: F.struct(
        x["start"].alias("start"), x["length"].alias("length"), x["new"].alias("new"))).alias("edits"))
    joined = state.join(lists, state["doc_id"].eqNullSafe(lists["_id"]), "left")
    return _each(joined.select("doc_id", "text", "tree_chars", "tree_tokens", "edits"), vocabulary)


def apply_own_edits(state: DataFrame, vocabulary: str = "byte_bpe_50k.json", keep: list[str] = ()) -> DataFrame:
    """As ``apply_edits``, with each row's edits in its column ``edits``; the
    columns ``keep`` are passed on."""
    return _each(state.select("doc_id", "text", "tree_chars", "tree_tokens", "edits", *keep), vocabulary, list(keep))


def _values(column: pa.Array) -> Iterator[str | None]:
    """Texts one at a time: a batch of long ones is not copied whole."""
    return (x.as_py() for x in column)


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    return (x.values.to_numpy().tolist() if x.is_valid else None for x in column)


def _each(rows: DataFrame, vocabulary: str, keep: list[str] = ()) -> DataFrame:
    schema = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(STATE).fields,
                           *[rows.schema[c] for c in keep]])

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary)
        if code.words:
            raise ValueError("a vocabulary that normalises texts has no character positions to keep")
        for b in batches:
            out = []
            for text, chars, tokens, edits in zip(_values(b.column("text")), _lists(b.column("tree_chars")),
                                                  _lists(b.column("tree_tokens")), b.column("edits").to_pylist()):
                edits = edits or []
                tree = CountTree(text or "", code, chars, tokens)
                for e in edits:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["new"] or "")
                out.append((tree.text if text is not None or edits else None, tree.chars, tree.tokens,
                            tree.total, tree.encoded, len(edits)))
            columns = list(zip(*out)) or [()] * 6
            types = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)], *[b.column(c) for c in keep]],
                schema.names)
    return rows.mapInArrow(update, schema)
