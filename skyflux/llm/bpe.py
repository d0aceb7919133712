"""Byte-level BPE as a lazily determinised finite-state transducer.

A sequence of tokens is what the merges give exactly when every adjacent pair
is: encoding the bytes of the pair gives the pair back. So after any prefix of
a pre-token one thread per place where the current token may have started is
enough: (node of the vocabulary's trie, token before it, tokens found since the
last output). Reading a byte moves all threads at once; a set of threads is one
state of the determinised machine, made when first reached and kept. What all
threads agree on is emitted at once, so the lookahead is the length of the
current ambiguity, at most the longest token plus its neighbours. Closing a
pre-token emits what the thread that ends on a token boundary still holds.

The trie is three flat arrays, and what a worker keeps (pre-tokens, states,
pairs of tokens) is bounded in bytes. Texts are cut into pre-tokens first.
Decoding streams token bytes through a UTF-8 state machine, STEP tokens at a
time.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skyflux.llm.common import by_chars, claim, worker_cache
from skyflux.llm.pretokens import Cutter, PieceCache, newer_code_points

#: Bytes of pre-tokens kept by a worker; states (under 1 kB each) and a quarter
#: of the pairs (100 bytes each); characters encoded and tokens decoded at a time.
CACHE_BYTES = 100_000_000
STATES = 150_000
CHUNK = 3_000_000
STEP = 4_096


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of (base64 of the token's bytes, rank)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def merge_by_rank(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[int]:
    """The definition: merge the adjacent pair of lowest rank (leftmost first)
    until none is left or only ``stop`` parts are."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Trie:
    """Tokens by their bytes. Nodes are numbered level by level, so that the
    children of a node follow each other: node n has the arcs ``labels[first[n]:
    first[n + 1]]``, and arc k leads to node k + 1. ``token`` is -1 inside."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks)
        self.first, self.token, labels = array("I"), array("i"), bytearray()
        level, depth = [(0, len(tokens))], 0
        while level:
            below = []
            for lo, hi in level:
                self.first.append(len(labels))
                whole = lo < hi and len(tokens[lo]) == depth
                self.token.append(ranks[tokens[lo]] if whole else -1)
                lo += whole
                while lo < hi:
                    at, label = lo, tokens[lo][depth]
                    while lo < hi and tokens[lo][depth] == label:
                        lo += 1
                    labels.append(label)
                    below.append((at, lo))
            level, depth = below, depth + 1
        self.first.append(len(labels))
        self.labels = bytes(labels)


class _State(dict):
    """byte -> next state. ``out`` is what is emitted on reaching the state,
    ``end`` what closing the pre-token here adds (None: no single thread)."""

    __slots__ = ("threads", "out", "end")


class Transducer:
    """Pre-token bytes -> token ids (little-endian unsigned 32-bit integers).

    At most ``max_states`` states are kept; beyond that, states are made for
    the piece at hand and forgotten."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._trie = Trie(ranks)
        self._pairs: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self._known: dict[tuple, _State] = {}
        self._start = self._state(b"", ((0, -1, ()),))

    def _state(self, out: bytes, threads: tuple) -> _State:
        got = self._known.get((out, threads))
        if got is None:
            got = _State()
            got.threads, got.out = threads, out
            ends = [held for node, _, held in threads if node == 0]
            got.end = np.array(ends[0], dtype="<u4").tobytes() if len(ends) == 1 else None
            if len(self._known) < self.max_states:
                self._known[out, threads] = got
        return got

    def _split(self, tok: int) -> tuple[int, int] | None:
        """The two tokens whose merge is ``tok``; None for one byte; (-1, -1) when no merges lead to it."""
        got = self._splits.get(tok, 0)
        if got == 0:
            piece = self.bytes_of[tok]
            if len(piece) == 1:
                got = None
            else:
                parts = merge_by_rank(piece, self.ranks, stop=2)
                got = (parts[0], parts[1]) if len(parts) == 2 else (-1, -1)
            self._splits[tok] = got
        return got

    def _edge(self, tok: int, side: int) -> list[tuple[bytes, int]]:
        """Tokens that stand at the right (1) or left (0) edge while ``tok`` is
        built, each with the rank of the merge that uses it up."""
        got = self._edges[side].get(tok)
        if got is None:
            got, t, until = [], tok, 1 << 60
            while True:
                got.append((self.bytes_of[t], until))
                parts = self._split(t)
                if parts is None:
                    break
                until, t = t, parts[side]
            self._edges[side][tok] = got
        return got

    def _fits(self, before: int, tok: int) -> bool:
        """Whether ``tok`` can stand after ``before`` (-1: at the start) in an
        encoding: no merge across the border comes before the merges that use
        up the two edges (of equal ranks the left one is first)."""
        if self._split(tok) == (-1, -1):
            return False
        if before < 0:
            return True
        pair = before << 32 | tok
        ok = self._pairs.get(pair)
        if ok is None:
            if len(self._pairs) >= 4 * self.max_states:
                self._pairs.clear()
            rank, left = self.ranks.get, self._edge(tok, 0)
            ok = True
            for x, until in self._edge(before, 1):
                for y, until_y in left:
                    m = rank(x + y)
                    if m is not None and m < until and m <= until_y:
                        ok = False
                        break
                if not ok:
                    break
            self._pairs[pair] = ok
        return ok

    def _next(self, state: _State, byte: int) -> _State:
        """Build one arc: move all threads by a byte, emit what they share."""
        moved, first, token, find = [], self._trie.first, self._trie.token, self._trie.labels.find
        for node, before, held in state.threads:
            nxt = find(byte, first[node], first[node + 1]) + 1
            if not nxt:
                continue
            if first[nxt] < first[nxt + 1]:
                moved.append((nxt, before, held))
            tok = token[nxt]
            if tok >= 0 and self._fits(before, tok):
                moved.append((0, tok, (*held, tok)))
        out = b""
        if moved:
            first = moved[0][2]
            k = len(first)
            for _, _, h in moved:
                while h[:k] != first[:k]:
                    k -= 1
            if k:
                out = np.array(first[:k], dtype="<u4").tobytes()
                moved = [(node, before, h[k:]) for node, before, h in moved]
        got = self._state(out, tuple(moved))
        if len(self._known) < self.max_states:
            state[byte] = got
        return got

    def encode(self, piece: bytes) -> bytes:
        return self.encode_sorted([piece])[0]

    def encode_sorted(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many pieces in sorted order: the path through the machine is
        kept as far as a piece agrees with the one before.

        A piece that is itself a token is that token; a vocabulary whose merges
        leave no single thread falls back to the definition."""
        ranks, start, result = self.ranks, self._start, []
        last, path, outs = b"", [start], []
        for piece in pieces:
            whole = ranks.get(piece)
            if whole is not None:
                result.append(whole.to_bytes(4, "little"))
                continue
            k = 0
            for x, y in zip(piece, last):
                if x != y:
                    break
                k += 1
            del path[k + 1:], outs[k:]
            state = path[k]
            for b in piece[k:]:
                nxt = state.get(b)
                state = nxt if nxt is not None else self._next(state, b)
                outs.append(state.out)
                path.append(state)
            last = piece
            result.append(b"".join(outs) + state.end if state.end is not None
                          else np.array(merge_by_rank(piece, ranks), dtype="<u4").tobytes())
        return result


_RUNS = re.compile(rb"[\x00-\x7F]+|[\x80-\xFF]+")


class Utf8Stream:
    """Incremental UTF-8: bytes of any cut in, text out. The state is how many
    bytes the open character still needs, its code point so far, and the bounds
    of the next byte. Ill-formed bytes become U+FFFD, one for each longest
    beginning of a character."""

    def __init__(self):
        self._need, self._code, self._low, self._high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes, end: bool = False) -> str:
        out = []
        need, code, low, high = self._need, self._code, self._low, self._high
        for run in _RUNS.findall(data):
            if run[0] < 0x80:                             # needs no state of its own
                if need:
                    out.append("\ufffd")
                    need, low, high = 0, 0x80, 0xBF
                out.append(run.decode("ascii"))
                continue
            for b in run:
                if need:
                    if low <= b <= high:
                        code, need, low, high = code << 6 | b & 0x3F, need - 1, 0x80, 0xBF
                        if not need:
                            out.append(chr(code))
                        continue
                    out.append("\ufffd")
                    need, low, high = 0, 0x80, 0xBF
                if 0xC2 <= b <= 0xDF:
                    need, code = 1, b & 0x1F
                elif 0xE0 <= b <= 0xEF:
                    need, code, low, high = 2, b & 0x0F, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF
                elif 0xF0 <= b <= 0xF4:
                    need, code, low, high = 3, b & 0x07, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF
                else:
                    out.append("\ufffd")
        if end and need:
            out.append("\ufffd")
            need, low, high = 0, 0x80, 0xBF
        self._need, self._code, self._low, self._high = need, code, low, high
        return "".join(out)


class Coder:
    """texts -> ids, by the pieces that a pattern cuts."""

    def __init__(self, ranks: bytes, pattern: str, odd: str, states: int = STATES, cache_bytes: int = CACHE_BYTES):
        self._cut, fst = Cutter(pattern, odd), Transducer(parse_ranks(ranks), states)
        self.bytes_of = fst.bytes_of
        self._cache = PieceCache(lambda ps: fst.encode_sorted([p.encode("utf-8", "surrogatepass") for p in ps]), cache_bytes)

    def __call__(self, texts: list[str]) -> list[bytes]:
        pieces = [self._cut(t) for t in texts]
        self._cache.load(pieces)
        get = self._cache.values.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


_CODERS: dict[tuple[int, str, int, int], Coder] = worker_cache()


def _coder(ranks: bytes, pattern: str, odd: str, states: int, cache_bytes: int) -> Coder:
    """The worker's coder of a vocabulary; one is kept per worker."""
    claim("bpe")
    key = (hash(ranks), pattern, states, cache_bytes)
    if key not in _CODERS:
        _CODERS.clear()
        gc.set_threshold(200_000, 20, 100)                # states and caches are long-lived: scan them rarely
        _CODERS[key] = Coder(ranks, pattern, odd, states, cache_bytes)
    return _CODERS[key]


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())      # one vocabulary file: its size is fixed


def _decoder(bytes_of: dict[int, bytes], step: int):
    """ids as bytes -> text, ``step`` tokens at a time through the UTF-8 machine."""
    of = bytes_of.__getitem__

    def decode(data: bytes) -> str:
        ids = np.frombuffer(data, dtype="<u4")
        utf8, out = Utf8Stream(), []
        for at in range(0, len(ids), step):
            out.append(utf8.feed(b"".join(map(of, ids[at:at + step].tolist()))))
        out.append(utf8.feed(b"", end=True))
        return "".join(out)
    return decode


def bpe_encode(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
               n_col: str = "n_tokens", decoded_col: str | None = None, keep: list[str] | None = None,
               step: int = STEP, states: int = STATES, cache_bytes: int = CACHE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """``keep`` columns (all but the text by default) plus ``ids_col`` (binary:
    little-endian unsigned 32-bit ids), ``n_col`` (long) and, when named,
    ``decoded_col``: the text that the ids give back, decoded in the same pass.

    Every match of ``pattern`` is encoded separately, without special tokens.
    Null text counts as empty and gives no ids. Rows are neither dropped nor
    merged; columns named like the new ones are replaced. ``states``,
    ``cache_bytes`` and ``chunk`` (bytes of text encoded at a time) bound a worker's memory and
    change its speed only.
    """
    vocab, odd = _vocabulary(docs.sparkSession, vocab_path), newer_code_points()
    new = [T.StructField(ids_col, T.BinaryType()), T.StructField(n_col, T.LongType())]
    if decoded_col:
        new.append(T.StructField(decoded_col, T.StringType()))
    names = [f.name for f in new]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text_col, *names)]
    schema = T.StructType([docs.schema[c] for c in keep] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _coder(vocab.value, pattern, odd, states, cache_bytes)
        decode = _decoder(encode.bytes_of, step) if decoded_col else None
        for batch in batches:
            for b in by_chars(batch, text_col, chunk):
                ids = encode([t or "" for t in b.column(text_col).to_pylist()])
                cols = [b.column(c) for c in keep] + [pa.array(ids, pa.binary()),
                                                      pa.array([len(x) // 4 for x in ids], pa.int64())]
                if decode:
                    cols.append(pa.array(map(decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *names])

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def bpe_decode(docs: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded",
               step: int = STEP) -> DataFrame:
    """``docs`` with ``text_col``: the text of the ids. Null ids give an empty
    text; an id outside the vocabulary is an error."""
    vocab = _vocabulary(docs.sparkSession, vocab_path)
    keep = [c for c in docs.columns if c != text_col]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder({i: t for t, i in parse_ranks(vocab.value).items()}, step)
        for batch in batches:
            for b in by_chars(batch, ids_col, CHUNK):
                texts = pa.array([decode(x.as_py() or b"") for x in b.column(ids_col)], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [texts], names=[*keep, text_col])

    return docs.mapInArrow(run, schema)
