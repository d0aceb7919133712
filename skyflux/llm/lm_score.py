"""Language-model scores by a weighted backoff automaton.

The model is a smoothed word trigram model learned from the training documents
of the whole input. Its states are the last two words if they were seen in a
row, else the last word, else the root; the start of a text counts as a word
before its first. A state has an arc for every word seen after it in training;
on any other word its failure arc is taken, which has a weight, to the state of
one word less. The root has an arc for every word. Weights are log10 of

    root arc        p(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    arc v -> w      p(w|v)   = (c(vw) + MU p(w)) / (c(v) + MU)
    arc uv -> w     p(w|uv)  = (c(uvw) + MU p(w|v)) / (c(uv) + MU)
    failure of h    MU / (c(h) + MU)

so that failure arcs and the arc found after them give the smoothed probability
of an unseen n-gram. One left-to-right pass carries the state and adds weights up.
Weights are whole multiples of 1 / UNIT and a text's are added as whole numbers
and rounded once, so that a score is the same double whatever the order of the
sum, and within half a unit a weight of the real number.

Documents are dealt to shards of bounded size. A shard sends its distinct words,
pairs and triples with their training counts, packed and by hash range, to the
counting tasks; these add them up over all shards and answer every shard with
the totals of what it asked for. That way counts and lookups are one exchange, a
word that is in every document travels once per shard, and a shard holds the
part of the automaton that its own texts can reach, whatever the size of the
whole. Shards and hash ranges both grow with the bytes of the input, so that no
task does; a shard sends one row per range that it has n-grams of, which never
are more rows than n-grams.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflux.llm.common import MULT, by_chars, checkpoint_table, give_back_memory, shuffle_partitions, text_or_empty, word_hashes

MU = 5.0
ORDER = 3
SHARD_BYTES = 12_000_000
#: Bytes of text whose n-grams one hash range is to hold, over all shards.
RANGE_BYTES = 12_000_000
#: Weights are multiples of its inverse.
UNIT = 2.0 ** 44
#: Tokens that one lane of the automaton's run reads.
LANE = 512
#: Token of the end of a text, and the state before its first word.
END, START = np.uint64(0x9B0F6C1E5D2A4783), np.uint64(0x27D4EB2F165667C5)


def _squeeze(raw) -> bytes:
    """Bytes compressed, after their length."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _loosen(data: bytes) -> bytes:
    return pa.decompress(memoryview(data)[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, before the shuffle to their shards."""
    for batch in batches:
        for part in by_chars(batch, "text", 8_000_000):
            text = pa.array([_squeeze(x.as_buffer()) for x in part.column("text")], pa.binary())
            yield part.set_column(part.schema.get_field_index("text"), "text", text)


def _planes(values: np.ndarray) -> bytes:
    """Eight-byte numbers with the bytes of one place together."""
    return _squeeze(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _values(data: bytes) -> np.ndarray:
    return np.frombuffer(_loosen(data), dtype=np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys, as differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_values(data), dtype=np.uint64)


def _pack_counts(n: np.ndarray) -> bytes:
    return _planes(n.astype(np.uint64))


def _unpack_counts(data: bytes) -> np.ndarray:
    return _values(data).astype(np.int64)


def _tokens(texts: Iterable[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """(keys, begin): for all texts' tokens in a row the keys of the n-grams of
    one, two and three words that end there, and where each text begins. The
    start of a text is a word before its first, so the first has no triple; its
    place holds START alone, which no state asks for."""
    end = np.array([END])
    parts = [x for t in texts for x in (word_hashes(t.lower().split()), end)]       # as common.words does
    begin = np.cumsum([0] + [len(parts[i]) + 1 for i in range(0, len(parts), 2)])[:-1]
    keys = [np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)]
    del parts
    for _ in range(1, ORDER):
        before = np.empty_like(keys[0])
        before[1:] = keys[-1][:-1]
        before[begin] = START
        keys.append(pair_keys(before, keys[0]))
    for k in keys[2:]:
        k[begin] = START
    return keys, begin


def pair_keys(before: np.ndarray, tok: np.ndarray) -> np.ndarray:
    """One key per (state, token); ``before`` is used up."""
    before *= MULT
    before += tok
    for _ in range(2):
        before ^= before >> np.uint64(31)
        before *= MULT
    return before


def _places(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the sorted distinct ones."""
    by = np.argsort(keys)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[by[1:]] != keys[by[:-1]]
    at = np.empty(len(keys), dtype=np.int32)
    at[by] = np.cumsum(new, dtype=np.int32) - 1
    return at


def _asked(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each occurs in training tokens."""
    known, n = np.unique(keys[train], return_counts=True)
    every = np.union1d(known, keys[~train]) if not train.all() else known
    counts = np.zeros(len(every), dtype=np.int64)
    counts[np.searchsorted(every, known)] = n
    return every, counts


def _requests(sharded: DataFrame, buckets: int) -> DataFrame:
    bits = max(1, int(np.ceil(np.log2(buckets))))
    shift = np.uint64(64 - bits)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        give_back_memory()
        every, begin = _tokens(map(_loosen, pdf["text"]))
        train = np.repeat(~pdf["held_out"].to_numpy(dtype=bool), np.diff(np.append(begin, len(every[0]))))
        shard = int(pdf["shard"].iloc[0])
        rows = []
        for kind in range(ORDER, 0, -1):
            keys, n = _asked(every.pop(), train)
            cut = np.searchsorted((keys >> shift).astype(np.int64), np.arange((1 << bits) + 1))
            rows += [(shard, b, kind, _pack(keys[a:z]), _pack_counts(n[a:z])) for b, (a, z) in enumerate(zip(cut, cut[1:])) if z > a]
        return pd.DataFrame(rows, columns=["shard", "bucket", "kind", "keys", "n"])

    return sharded.groupBy("shard").applyInPandas(ask, "shard long, bucket int, kind int, keys binary, n binary")


def _answers(requests: DataFrame) -> DataFrame:
    """(shard, bucket, kind, n): totals in the order of the keys asked for; a row
    of kind 0 has the tokens and types of the bucket."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        give_back_memory()
        bucket, kind = int(pdf["bucket"].iloc[0]), int(pdf["kind"].iloc[0])
        keys = [_unpack(k) for k in pdf["keys"]]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        every, inv = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        total = np.bincount(inv, weights=np.concatenate([_unpack_counts(x) for x in pdf["n"]]), minlength=len(every)).astype(np.int64)
        rows = [(s, bucket, kind, _pack_counts(t), 0, 0) for s, t in zip(pdf["shard"], np.split(total[inv], ends))]
        if kind == 1:
            rows.append((-1, bucket, 0, b"", int(total.sum()), int((total > 0).sum())))
        return pd.DataFrame(rows, columns=["shard", "bucket", "kind", "n", "tokens", "types"])

    return checkpoint_table(requests.groupBy("bucket", "kind").applyInPandas(
        add, "shard long, bucket int, kind int, n binary, tokens long, types long"), "lm")


def _weight(p: np.ndarray) -> np.ndarray:
    return np.floor(np.log10(p) * UNIT + 0.5) / UNIT


def _add_up(weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The exact sum of each text's weights, as the nearest double."""
    units = (weights * UNIT).astype(np.int64)
    high, low = (np.add.reduceat(x, begin).astype(float) for x in (units >> 24, units & 0xFFFFFF))     # neither can overflow
    return (high * 2.0 ** 24 + low) / UNIT


class BackoffAutomaton:
    """The part of the automaton that some texts can reach. ``at`` has for every
    token the places of its word, pair and triple among the distinct ones, ``n``
    their training counts, ``starts`` the training texts.

    States: 0 the root, then one per word, the start of a text, one per pair.
    ``fail`` and ``fail_to`` are a state's failure arc; ``arc[k]`` are the
    weights of the arcs into words, pairs and triples, which exist where ``n`` is
    positive (into a word always: from the root)."""

    def __init__(self, at: list[np.ndarray], n: list[np.ndarray], begin: np.ndarray, starts: int,
                 tokens: int, types: int, mu: float = MU):
        self.at, self.n, self.begin = at, n, begin
        self.start = len(n[0]) + 1
        self.pairs = self.start + 1
        count = np.concatenate([[0], n[0], [starts], n[1]])
        first = np.zeros(len(at[0]), dtype=bool)
        first[begin] = True
        some = [np.zeros(len(x), dtype=np.int64) for x in n]              # a token at which the n-gram ends
        for s, x in zip(some, at):
            s[x] = np.arange(len(x))
        p = [(n[0] + 0.1) / (tokens + 0.1 * (types + 1))]
        here = some[1]
        history = np.where(first[here], self.start, 1 + at[0][here - 1])
        p.append((n[1] + mu * p[0][at[0][here]]) / (count[history] + mu))
        here = some[2]
        p.append((n[2] + mu * p[1][at[1][here]]) / (n[1][at[1][here - 1]] + mu))
        self.p, self.arc = p, [_weight(x) for x in p]
        self.fail = _weight(mu / (count + mu))
        self.fail_to = np.zeros(len(count), dtype=np.int64)
        self.fail_to[self.pairs:] = 1 + at[0][some[1]]

    def _after(self, t: np.ndarray) -> np.ndarray:
        """The state after token ``t``: its pair if that was seen in training, else its word."""
        return np.where(self.n[1][self.at[1][t]] > 0, self.pairs + self.at[1][t], 1 + self.at[0][t])

    def run(self, lane: int = LANE) -> np.ndarray:
        """The weight of every token, left to right: all texts go ahead together,
        each with its state. Long texts are cut into lanes of ``lane`` tokens, as
        the state after a token depends on no more than the last two."""
        size = len(self.at[0])
        cuts = [np.arange(a, z, lane) for a, z in zip(self.begin, np.append(self.begin[1:], size))]
        pos = np.concatenate(cuts) if cuts else np.zeros(0, dtype=np.int64)
        length = np.diff(np.append(pos, size))
        state = np.where(np.isin(pos, self.begin), self.start, self._after(pos - 1))
        longest = np.argsort(-length, kind="stable")
        pos, state, length = pos[longest], state[longest], length[longest]
        weight = np.zeros(size)
        for i in range(int(length[0]) if len(length) else 0):
            k = int(np.searchsorted(-length, -i))                         # lanes that are longer than i
            t, s = pos[:k] + i, state[:k]
            word, pair, triple = (x[t] for x in self.at)
            by_triple = (s >= self.pairs) & (self.n[2][triple] > 0)
            w = np.where(by_triple, self.arc[2][triple], 0.0)
            down = ~by_triple & (s >= self.pairs)                         # from two words to one
            w += np.where(down, self.fail[s], 0.0)
            s = np.where(down, self.fail_to[s], s)
            by_pair = ~by_triple & (s > 0) & (self.n[1][pair] > 0)
            w += np.where(by_pair, self.arc[1][pair], 0.0)
            root = ~by_triple & ~by_pair                                  # from one word to the root
            w += np.where(root, self.fail[s] + self.arc[0][word], 0.0)
            state[:k] = np.where(root, 1 + word, self.pairs + pair)
            weight[t] = w
        return weight


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", mu: float = MU,
              shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens,
    base_score (root weights only), score (log10 probability of the text).

    The model learns from the rows for which ``held_out`` is false (null counts
    as false). Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, then one
    end token. Null text counts as empty: one token, the end. Without training
    rows all counts are 0. Repeated rows are scored each and counted each; an
    empty table gives an empty result; other columns are ignored. Words are
    told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    sharded = src.select("id", F.col("text").cast("binary").alias("text"), "held_out",
                         F.pmod(F.xxhash64("id", "text"), F.lit(shards)).alias("shard"))
    sharded = sharded.mapInArrow(_squeezed, sharded.schema)
    answers = _answers(_requests(sharded, max(shuffle_partitions(spark), -(-size // range_bytes))))
    tokens, types = answers.filter("kind = 0").agg(F.sum("tokens"), F.sum("types")).first()
    tokens, types = tokens or 0, types or 0
    starts = src.filter(~F.col("held_out")).count()

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({c: [] for c in ("id", "held_out", "n_tokens", "n_known", "base_score", "score")})
        give_back_memory()
        keys, begin = _tokens(map(_loosen, left["text"]))
        got = right.sort_values("bucket")
        n = [np.concatenate([_unpack_counts(x) for x in got["n"][got["kind"] == k]]) for k in range(1, ORDER + 1)]
        del got
        at = []
        while keys:
            at.append(_places(keys.pop(0)))
        fsa = BackoffAutomaton(at, n, begin, starts, tokens, types, mu)
        return pd.DataFrame({
            "id": left["id"], "held_out": left["held_out"], "n_tokens": np.diff(np.append(begin, len(at[0]))),
            "n_known": np.add.reduceat((n[0] > 0)[at[0]].astype(np.int64), begin),
            "base_score": _add_up(fsa.arc[0][at[0]], begin), "score": _add_up(fsa.run(), begin)})

    id_type = src.schema["id"].dataType.simpleString()
    out = sharded.groupBy("shard").cogroup(answers.filter("kind > 0").select("shard", "bucket", "kind", "n").groupBy("shard")).applyInPandas(
        score, f"id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
