"""Queries of the folder and the stages of the corpus pipeline on the smallest tables."""

import hashlib
import re

import numpy as np
import pytest

pytest.importorskip("skyflux.llm")

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from skyflux.llm import bpe, mixing  # noqa: E402
from skyflux.llm.common import checkpoint_table, table  # noqa: E402
from test_operators import brute_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "encoding"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpoint_table(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_order(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    ids = [set(rows(df)) for df in stages]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    for a, b in zip(stages[:-2], stages[1:-1]):
        before, after = rows(a), rows(b)
        assert all(before[i] == after[i] for i in after)


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = rows(table(spark, SF, "labels"))
    kept = set(rows(stages[1]))
    toxic = [i for i, r in labels.items() if r["toxic"] == 1]
    clean = [i for i, r in labels.items() if r["toxic"] == 0]
    assert sum(i in kept for i in toxic) <= 0.1 * len(toxic) + 1
    assert sum(i not in kept for i in clean) <= 0.02 * len(clean) + 1


def test_exact_dedup_stage(stages):
    first = {}
    for i, r in sorted(rows(stages[1]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), i)
    assert set(rows(stages[2])) == set(first.values())


def test_near_dedup_stage(stages):
    found = brute_components([(i, r["text"]) for i, r in rows(stages[2]).items()])
    assert set(rows(stages[3])) == {i for i, (_, c) in found.items() if c == i}


def test_mixing_stage(stages):
    decided = mixing.mix_decisions(stages[3], mixing.TARGETS).collect()
    assert set(rows(stages[4])) == {r["doc_id"] for r in decided if r["mix_kept"]}
    total = sum(r["mix_tokens"] for r in decided)
    assert sum(r["mix_tokens"] * r["mix_p"] for r in decided) == pytest.approx(mixing.TARGETS.keep * total, rel=1e-6)


def test_encoding_stage(stages):
    import public_tokenizers as P
    import tiktoken
    ranks = bpe.parse_ranks(open(P.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    tok = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before, after = rows(stages[4]), rows(stages[5])
    assert set(before) == set(after)
    for i, r in after.items():
        ids = tok.encode_ordinary(before[i]["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((before[i]["text"] or "").encode()).hexdigest()


def test_empty_input(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = checkpoint_table(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """Nulls in every column, repeated rows, and columns named like the stages' own."""
    from pyspark.sql import functions as F
    base = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, None, None, None, None), (900002, "", "en", "s", 0)] * 2, base.schema)
    docs = base.limit(40).unionByName(odd).withColumn("toxic", F.lit(7)).withColumn("_id", F.lit("x")).withColumn("_gone", F.lit(1)) \
        .withColumn("sig", F.lit("y")).withColumn("n", F.lit(3)).withColumn("_sha", F.lit("z"))
    for name, stage in corpus_pipeline.STAGES:
        out = checkpoint_table(stage(spark, docs, SF), "test-odd")
        if name != "encoding":
            assert out.columns == docs.columns and out.count() > 0
        docs = out
