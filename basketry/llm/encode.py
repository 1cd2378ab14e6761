"""Tokenizer helpers used inside tasks: the public vocabulary files through
the ``tokenizers`` library, with a bounded cache of encoded chunks.

A text is first split at the file's added tokens, which stand for their own
ids, as the library does by default; what follows holds for the parts between.
Both vocabularies split a text into pre-tokens before any merge, whose ids do
not depend on each other, so repeated ones are encoded once per worker.
``byte`` texts are split into pre-tokens at once, by a pattern of plain
character classes if all characters lie below U+0250; ``word`` texts (white
space dropped) are first cut into chunks at spaces and line ends.  Ids are kept as
little-endian unsigned 32-bit bytes; a single pre-token is a chunk of its own,
so both share one cache.
"""
from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

#: Chunks in each half of the cache (about 200 bytes each).
CACHE = 400_000

# letters, digits and white space below U+0250, as the Unicode classes L and N and White_Space have them
_LETTER, _DIGIT, _WHITE = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_FAR = re.compile("[^\0-\u024f]")
_NEAR_BYTE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_WHITE}{_LETTER}{_DIGIT}]+"
                        rf"|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_ID = attrgetter("id")
_encoders: dict[str, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes whole texts with one vocabulary file."""

    def __init__(self, name: str, path: str | None = None):
        import regex
        import tokenizers
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(name)
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("added tokens must match as they are")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        #: characters of the longest added token
        self.longest = max(map(len, self.added), default=0)
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if added else None
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.space = self.letters[0x20]
        # word vocabularies normalise first; byte vocabularies have no normalizer
        self.words = self.tokenizer.normalizer is not None
        rule = r"'s|'t|'re|'ve|'m|'ll|'d|"
        self.split = regex.compile(
            rule + (r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+" if self.words
                    else r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"))
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pretokens(self, chunk: str) -> list[str]:
        if self.words:
            chunk = _lower(unicodedata.normalize("NFC", chunk))
        return self.split.findall(chunk)

    def _pretoken(self, token: str) -> bytes:
        if token.isascii():
            if token.isalpha():
                letters = token
            else:
                rest = token[1:]
                letters = self.space + rest if token[0] == " " and rest.isalpha() else token.translate(self.letters)
        else:
            letters = token.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", map(_ID, self.model.tokenize(letters))).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a chunk of a word vocabulary, through the cache."""
        out = self.cache.get(chunk)
        if out is None:
            out = self.old.get(chunk)
            if out is None:
                plain = chunk.isascii() and chunk.isalpha() and chunk.islower()
                tokens = [chunk] if plain else self.pretokens(chunk)
                if len(tokens) == 1:
                    out = self._pretoken(chunk) if tokens[0] == chunk else self._known(tokens[0])
                else:
                    out = b"".join([self._known(t) for t in tokens])
            if len(self.cache) >= CACHE:
                self.old, self.cache = self.cache, {}
            self.cache[chunk] = out
        return out

    def _known(self, token: str) -> bytes:
        """Ids of one pre-token, through the cache."""
        cache = self.cache
        ids = cache.get(token)
        if ids is None:
            ids = self.old.get(token)
            if ids is None:
                ids = self._pretoken(token)
            if len(cache) >= CACHE:  # what was not asked for since the last turn is forgotten
                self.old, self.cache = cache, {token: ids}
            else:
                cache[token] = ids
        return ids

    def count(self, token: str) -> int:
        """Tokens of one pre-token of a byte vocabulary."""
        return len(self.cache.get(token) or self._known(token)) // 4

    def counts(self, tokens: list[str]) -> list[int]:
        """Tokens of each of some pre-tokens of a byte vocabulary."""
        get, known = self.cache.get, self._known
        return [len(x if (x := get(t)) is not None else known(t)) >> 2 for t in tokens]

    def parts(self, text: str) -> list[str]:
        """Text and added token in turn, from text to text (which may be empty)."""
        for token in self.added:
            if token in text:
                return self.at_added.split(text)
        return [text]

    def borders(self, text: str, first: int = 0) -> Iterator[tuple[int, int, int]]:
        """(first character, end, tokens) of each pre-token and added token of a
        byte vocabulary, from a border on."""
        for k, part in enumerate(self.parts(text[first:])):
            end = first + len(part)
            if k % 2:
                yield first, end, 1
            else:  # the pattern must not see what follows the part
                for m in self.split.finditer(text, first, end):
                    yield m.start(), m.end(), self.count(m.group())
            first = end

    def ids(self, text: str | None) -> bytes:
        """Ids of the text, as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        parts = self.parts(text)
        if len(parts) > 1:
            return b"".join([self.added[p] if k % 2 else self._plain(p) for k, p in enumerate(parts) if p])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if self.words:
            return b"".join(self._looked_up(text.replace("\n", " ").split(" "), self._chunk))
        split = _NEAR_BYTE if _FAR.search(text) is None else self.split
        return b"".join(self._looked_up(split.findall(text), self._known))

    def _looked_up(self, keys: list[str], miss: Callable[[str], bytes]) -> list[bytes]:
        """The ids of each key: all are looked up first, those not there follow."""
        found = list(map(self.cache.get, keys))
        if None in found:
            found = [miss(k) if x is None else x for k, x in zip(keys, found)]
        return found


def _lower(s: str) -> str:
    """Lower case character by character, without rules for word ends."""
    return s.lower() if s.isascii() or "Σ" not in s else "".join(c.lower() for c in s)


def vocabulary_size(name: str) -> int:
    """Ids of a vocabulary file, added tokens included."""
    import tokenizers
    if os.sep not in name:
        import public_tokenizers
        name = public_tokenizers.path(name)
    return tokenizers.Tokenizer.from_file(name).get_vocab_size(with_added_tokens=True)


def encoder(name: str) -> Encoder:
    """The worker's encoder for a vocabulary file (by name, or a path)."""
    if name not in _encoders:
        _encoders[name] = Encoder(name, name if os.sep in name else None)
    return _encoders[name]
