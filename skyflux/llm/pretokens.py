"""Cutting texts into pre-tokens exactly as a byte-level tokenizer library does.

The `regex` module knows a newer Unicode than the tokenizer libraries: it calls
some code points letters or numbers that are unassigned for them. These are
found by comparison (`newer_code_points`) and read as a private-use character
while cutting, so the pieces come out as the library's.
"""

from __future__ import annotations

import functools

import regex

_ALL = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
_PRIVATE = 0xE000
_CLASSES = (r"\p{L}", r"\p{N}", r"\s")


@functools.cache
def newer_code_points() -> str:
    """Code points whose letter/number/space class differs between `regex` and
    the tokenizer libraries (both of which use the same tables)."""
    import tiktoken
    one_byte = {bytes([i]): i for i in range(256)}
    odd: set[str] = set()
    for cls in _CLASSES:
        enc = tiktoken.Encoding("cls" + cls, pat_str=cls, mergeable_ranks=one_byte, special_tokens={})
        theirs = set(bytes(enc.encode_ordinary(_ALL)).decode("utf-8"))
        odd |= theirs ^ set(regex.findall(cls, _ALL))
    return "".join(sorted(odd))


class Cutter:
    """findall of the pattern; ``odd`` code points count as neither letter, number nor space."""

    def __init__(self, pattern: str, odd: str):
        self._find = regex.compile(pattern).findall
        self._iter = regex.compile(pattern).finditer
        self._odd = frozenset(odd)
        self._map = dict.fromkeys(map(ord, odd), _PRIVATE)
        self._first = min(odd, default="\U0010ffff")

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self._plain(text):
            return self._find(text)
        masked = text.translate(self._map)
        return [text[m.start():m.end()] for m in self._iter(masked)]

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
            return self._first > "\xff"
        except UnicodeEncodeError:
            return self._odd.isdisjoint(text)


class PieceCache:
    """Values of pre-tokens, kept by a worker. ``make`` gets all pieces of a
    chunk that are not known yet at once. When more than ``size`` bytes would be
    held, only those of the current chunk stay."""

    def __init__(self, make, size: int):
        self._make, self._size, self.values, self._held = make, size, {}, 0

    @staticmethod
    def _bytes(pieces) -> int:
        return sum(map(len, pieces)) * 2 + 200 * len(pieces)   # key, value, their headers and the dictionary's slot

    def load(self, texts: list[list[str]]) -> None:
        """Afterwards ``values`` has every piece of these texts."""
        need = set().union(*texts)
        have = self.values
        new = sorted(need.difference(have))
        more = self._bytes(new)
        if self._held + more > self._size:
            have = self.values = {p: have[p] for p in need.intersection(have)}
            self._held = self._bytes(have)
        self._held += more
        have.update(zip(new, self._make(new)))


def chunks(texts: list[str], chars: int):
    """Slices of a list of texts with about ``chars`` characters each (a longer text is its own slice)."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= chars:
            yield texts[at:i + 1]
            at, n = i + 1, 0
    if at < len(texts):
        yield texts[at:]
