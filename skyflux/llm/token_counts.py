"""Token counts by a two-tier lookup at the map side.

Tier one is a compact table of frequent pre-tokens and their lengths in
tokens, broadcast to all workers. Its entries come from all documents: every
task keeps a mergeable summary of its most frequent words (counts above the
first ``size`` are subtracted from all, so any word with more than a
1/``size`` share is in it), and summaries are merged in a tree. Tier two is a
worker's own bounded cache of what the tokenizer made of all other pre-tokens.
Pre-tokens themselves are never shuffled, and the counts do not depend on
what either tier holds.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyflux.llm.common import claim, worker_cache
from skyflux.llm.pretokens import Cutter, PieceCache, chunks, newer_code_points

TABLE = 32_768
CACHE_BYTES = 100_000_000
CHUNK = 4_000_000
_FAN_IN = 32


def _trim(c: Counter, size: int) -> Counter:
    """Keep ``size`` entries: subtract the largest count left out from all."""
    if len(c) <= size:
        return c
    top = c.most_common(size + 1)
    cut = top[-1][1]
    return Counter({w: n - cut for w, n in top if n > cut})


def _summaries(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for b in batches:
        for part in chunks([t or "" for t in b.column(0).to_pylist()], CHUNK):
            for t in part:
                seen.update(t.split())
            seen = _trim(seen, 8 * size)
    yield pa.RecordBatch.from_pydict({"summary": [pickle.dumps(dict(_trim(seen, size)))]})


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = TABLE) -> list[str]:
    """At most ``size`` of the most frequent words of all texts. What reaches
    the driver is one summary of ``size`` entries, whatever the input."""
    one = docs.select(text_col).mapInArrow(lambda it: _summaries(it, size), "summary binary")
    parts = max(1, one.rdd.getNumPartitions())
    one = one.select((F.spark_partition_id()).alias("g"), "summary")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total: Counter = Counter()
        for x in pdf["summary"]:
            total.update(pickle.loads(x))
            total = _trim(total, 8 * size)
        return pd.DataFrame({"g": [int(pdf["g"].iloc[0])], "summary": [pickle.dumps(dict(_trim(total, size)))]})

    while parts > 1:
        one = one.withColumn("g", F.floor(F.col("g") / _FAN_IN).cast("int")).groupBy("g").applyInPandas(
            merge, "g int, summary binary")
        parts = -(-parts // _FAN_IN)
    return sorted(w for r in one.collect() for w in pickle.loads(r["summary"]))


_TOKENIZERS: dict[int, tuple] = worker_cache()


def _lengths(spec: bytes, pattern: str, odd: str, table: dict[str, int]):
    """The worker's cutter, tokenizer, special strings and piece cache."""
    claim("token_counts")
    key = hash((spec, len(table)))
    if key not in _TOKENIZERS:
        import json

        from tokenizers import Tokenizer
        _TOKENIZERS.clear()
        tok = Tokenizer.from_str(spec.decode("utf-8"))
        tok.no_truncation()
        tok.no_padding()
        special = [t["content"] for t in json.loads(spec)["added_tokens"]]

        def many(pieces: list[str]) -> list[int]:
            asked = [p for p in pieces if p not in table]
            got = dict(zip(asked, (len(e) for p in range(0, len(asked), 20_000)
                                   for e in tok.encode_batch_fast(asked[p:p + 20_000], add_special_tokens=False))))
            return [table[p] if p in table else got[p] for p in pieces]
        _TOKENIZERS[key] = (Cutter(pattern, odd), tok, special, PieceCache(many, CACHE_BYTES))
    return _TOKENIZERS[key]


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, text_col: str = "text", limit: int = 1024,
                 keep: list[str] | None = None, size: int = TABLE) -> DataFrame:
    """``keep`` columns (all but the text by default) plus n_bytes (UTF-8),
    n_tokens and over_limit (n_tokens > ``limit``).

    Counts are those of the byte-level tokenizer file at ``tokenizer_path``,
    without begin, end or added special tokens; special strings inside a text
    are one token, as is the library's default. Null text counts as empty (0
    tokens). Rows are neither dropped nor merged; columns with the new names
    are replaced. A text that holds an added string is given to
    the tokenizer whole.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    odd = newer_code_points()
    cut = Cutter(pattern, odd)
    words = {p for w in frequent_words(docs, text_col, size) for form in (w, " " + w) for p in cut(form)}
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(data.decode("utf-8"))
    tok.no_truncation()
    tok.no_padding()
    words = sorted(words)
    table = dict(zip(words, (len(e) for e in tok.encode_batch_fast(words, add_special_tokens=False))))
    spec, known = spark.sparkContext.broadcast(data), spark.sparkContext.broadcast(table)   # a file; <= size words' pieces
    keep = [c for c in (keep if keep is not None else docs.columns)
            if c not in (text_col, "n_bytes", "n_tokens", "over_limit")]
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # one core a task
        cut, tok, special, cache = _lengths(spec.value, pattern, odd, known.value)
        for b in batches:
            counts, sizes = [], []
            for part in chunks([t or "" for t in b.column(text_col).to_pylist()], CHUNK):
                whole = [any(s in t for s in special) for t in part]
                pieces = [[] if w else cut(t) for t, w in zip(part, whole)]
                cache.load(pieces)
                get = cache.values.__getitem__
                counts += [len(tok.encode(t, add_special_tokens=False)) if w else sum(map(get, p))
                           for t, w, p in zip(part, whole, pieces)]
                sizes += [len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass")) for t in part]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [
                pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    return docs.select(*keep, text_col).mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
