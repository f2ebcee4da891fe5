"""Pre-splitting of texts for byte-level BPE, shared by packing and encoding.

A text is first cut at the added tokens of the vocabulary file, then into
pre-tokens by the file's byte-level pattern.  Most of the time goes into
words that repeat, so texts are walked in chunks: a chunk starts at a single
space that follows a non-space, which is always a pre-token border, and a
bounded memo maps a chunk to its ids.  Texts in which a space follows other
white space, and texts with characters that the pattern library and the
tokenizers library class differently (letters of newer Unicode versions), are
split as a whole instead.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import regex

#: The byte-level pattern of the vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Entries a memo may hold; later words are computed each time.
MEMO = 700_000

_SPACE_AFTER_SPACE = re.compile(r"\s\x20")
_ASCII_PAIRS = [c + " " for c in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"]


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable
    Latin-1, else the next one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHAR = byte_chars()


def to_chars(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(BYTE_CHAR)


class Vocabulary:
    """A vocabulary file: ids, merges, added tokens and the library's tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        self._cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._pattern = regex.compile(PATTERN)
        self.library = Tokenizer.from_file(path)
        self._agreed: dict[str, bool] = {}
        self._odd: set[str] = set()  # characters that the two libraries class differently

    def _agrees(self, c: str) -> bool:
        """Whether both libraries put ``c`` into the same class (asked once per character)."""
        probe = f"a{c}b1{c}2!{c}! {c} {c}{c}"
        return self.split_by_library(probe) == self._pattern.findall(probe)

    def split_by_library(self, s: str) -> list[str]:
        return [s[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(s)]

    def chunks(self, s: str) -> list[str]:
        """A text without added tokens, cut at pre-token borders."""
        if s.isascii():
            unsafe = "\0" in s or any(p in s for p in _ASCII_PAIRS)
        else:
            known = self._agreed
            for c in set(s).difference(known):
                known[c] = self._agrees(c)
                if not known[c]:
                    self._odd.add(c)
            if self._odd and not self._odd.isdisjoint(s):
                return self.split_by_library(s)
            unsafe = "\0" in s or _SPACE_AFTER_SPACE.search(s)
        if unsafe:
            return self._pattern.findall(s)
        parts = s.replace(" ", "\0 ").split("\0")
        return parts if parts[0] else parts[1:]

    def pretokens(self, chunk: str) -> list[str]:
        if self._odd and not self._odd.isdisjoint(chunk):
            return [chunk]  # came from split_by_library: is one pre-token
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha():
            return [chunk]
        if chunk[-1] in ".,!?" and word[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self._pattern.findall(chunk)

    def segments(self, text: str):
        """(text, None) and ("", added id) in order."""
        if self._cut is None or not any(a in text for a in self.added):
            yield text, None
            return
        at = 0
        for m in self._cut.finditer(text):
            if m.start() > at:
                yield text[at:m.start()], None
            yield "", self.added[m.group()]
            at = m.end()
        if at < len(text):
            yield text[at:], None


class Memo(dict):
    """A dict that computes missing entries and keeps the first ``limit`` of them.

    Frequent words come early, so a memo that only fills up keeps them."""

    def __init__(self, make, limit: int = MEMO):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        value = self._make(key)
        if len(self) < self._limit and len(key) <= 48:
            self[key] = value
        return value


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: What is kept by a Python worker for its next task that encodes texts.
KEPT = [vocabulary]


def forget() -> None:
    """Drop vocabularies and memos: tasks that encode nothing run in the same workers."""
    for f in KEPT:
        f.cache_clear()


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
