"""The operators of the training-data folder against brute force on small rows:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import datetime as dt
import hashlib
import math
import pickle
import random
import re
import textwrap
import zlib

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("skyflux.llm")

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from skyflux.llm import ann, bpe, exact_dedup, licenses, lm_score, mixing, pretokens, shingle_join, token_counts, toxicity, url_filter  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, sig string, n long, row long, bucket int"
WORDS = "the of and red green blue one two three Ünder straße é ß 日本 x".split()


def random_text(rnd, n):
    return "".join(rnd.choice(WORDS) + rnd.choice([" ", " ", "  ", "\n", ".\n", ", ", "\t"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = [random_text(rnd, n) for n in (0, 1, 3, 4, 5, 6, 40, 60, 200, 400)]
    near = [b.replace("red", "rose", 2) for b in base[6:]] + [b + " tail end" for b in base[6:]]
    out = [None, "", " ", "\n\t "] + base + near + base[5:] + [" ".join(base), "Zebra " * 30_000]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "src0" if i % 2 else None, "a", 1, 2, 3) for i, t in texts]
    return spark.createDataFrame([*rows, rows[8], (None, "null id text", "en", "s", "b", 1, 1, 1)], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_url_filter(spark):
    day = dt.date
    caps = spark.createDataFrame([
        (1, "https://u@A.b.example.com:80/x/?q#f", day(2024, 1, 5), "clash"), (2, "http://b.example.com/x", day(2024, 2, 1), "c"),
        (3, "http://b.example.com/x/", day(2024, 3, 1), "c"), (4, None, day(2024, 3, 1), "c"), (5, "no url", day(2024, 3, 1), "c"),
        (6, "http://example.com", None, "c"), (3, "http://b.example.com/x/", day(2024, 3, 1), "c"),
        (7, "http://other.org/", day(2030, 1, 1), "c")], "id long, url string, fetched_at date, matched string")
    ents = spark.createDataFrame([
        ("domain", "example.com", "block", day(2024, 1, 1)), ("domain", "b.example.com", "allow", day(2024, 2, 1)),
        ("domain", "b.example.com", "block", day(2024, 2, 1)), ("domain", "b.example.com", "allow", day(2024, 2, 20)),
        ("page", "b.example.com/x", "block", day(2024, 3, 1)), ("page", "b.example.com/x", "block", None),
        ("domain", "other.org", "block", day(2024, 1, 1))], "kind string, value string, action string, effective date")
    got = sorted((r["id"], r["matched"], r["rule_value"], r["blocked"]) for r in
                 url_filter.temporal_url_filter(caps, ents).fillna({"rule_value": ""}).collect())
    assert got == [(1, 1, "example.com", True), (2, 2, "b.example.com", True), (3, 3, "b.example.com/x", True),
                   (3, 3, "b.example.com/x", True), (4, 0, "", False), (5, 0, "", False), (6, 0, "", False), (7, 1, "other.org", True)]
    assert url_filter.temporal_url_filter(caps.limit(0), ents).count() == 0
    assert url_filter.temporal_url_filter(caps, ents.limit(0)).filter("blocked").count() == 0


def test_url_filter_instants_and_odd_years(spark):
    """Entries and captures of one day, years from 1 to 9999, trailing dots, IPv6, upper case in the list."""
    t = dt.datetime
    caps = [(1, "http://a.com/x", t(2024, 1, 5, 8)), (2, "http://a.com./x", t(2024, 1, 5, 12)), (3, "http://a.com/x", t(2024, 1, 5, 13)),
            (4, "http://a.com/x", t(2024, 1, 5, 18)), (5, "http://old.org/", t(1, 1, 2)), (6, "http://old.org/", t(999, 5, 5)),
            (7, "http://old.org/", t(9999, 12, 30)), (8, "http://[::1]:80/p", t(2024, 1, 1)), (9, "http://UP.net/Path", t(2024, 1, 1))]
    ents = [("domain", "a.com", "block", "2024-01-05 12:00:00"), ("domain", "a.com", "allow", "2024-01-05 13:00:00"),
            ("domain", "A.com.", "block", "2024-01-05 18:00:00"), ("domain", "a.com", "allow", "2024-01-05 18:00:00"), ("domain", "a.com", "allow", "no time"),
            ("domain", "old.org", "block", "0500-01-01 00:00:00"), ("domain", "[::1]", "block", "2023-01-01 00:00:00"),
            ("page", "Up.NET/Path", "block", "2023-01-01 00:00:00")]
    got = url_filter.temporal_url_filter(spark.createDataFrame(caps, "id int, url string, fetched_at timestamp_ntz").withColumn(
        "fetched_at", F.col("fetched_at").cast("timestamp")), spark.createDataFrame(ents, "kind string, value string, action string, effective string"))
    assert sorted((r["id"], r["blocked"]) for r in got.select("id", "blocked").collect()) == [
        (1, False), (2, True), (3, False), (4, True), (5, False), (6, True), (7, True), (8, True), (9, True)]
    assert got.filter("id = 3").first()["rule_since"].startswith("2024-01-05 13")


def test_intervals_follow_each_other(spark):
    e = spark.createDataFrame([("d", "x", "block", dt.date(2024, 1, d)) for d in (1, 5, 9)], "kind string, value string, action string, effective date")
    got = sorted((r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None) for r in url_filter.intervals(e).collect())
    assert got == [(1, 5), (5, 9), (9, None)]


def test_exact_dedup(docs, empty, texts):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = [(i, norm(t)) for i, t in texts] + [(texts[8][0], norm(texts[8][1])), (None, "null id text")]
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    got = exact_dedup.exact_dedup(docs, fan_in=2).collect()
    assert len(got) == len(rows)
    for t, ids in groups.items():
        mine = [r for r in got if r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()]
        assert {(r["keep_id"], r["group_size"]) for r in mine} == {(min((i for i in ids if i is not None), default=None), len(ids))}
        assert sum(r["kept"] for r in mine) == 1
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_exact_dedup_largest_id(spark):
    big = 2 ** 63 - 1
    got = exact_dedup.exact_dedup(spark.createDataFrame([(big, "a"), (None, "a"), (big, "b")], "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str) == sorted(
        [(big, big, 2, True), (None, big, 2, False), (big, big, 1, True)], key=str)


def brute_components(rows, width=5):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_shingle_components(docs, empty, texts):
    want = brute_components(texts)
    got = shingle_join.shingle_components(docs).collect()
    assert len(got) == len(texts) + 2
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert shingle_join.shingle_components(empty).count() == 0


def test_shingle_components_random(spark, monkeypatch):
    """Chains of edits around the threshold, many tiles and a tree of several levels."""
    monkeypatch.setattr(shingle_join, "TILE_ROWS", 40)
    rnd = random.Random(11)
    rows, i = [], 0
    for _ in range(25):
        w = [str(rnd.randrange(400)) for _ in range(rnd.randrange(5, 120))]
        for _ in range(rnd.randrange(1, 14)):
            rows.append((i, " ".join(w)))
            i += 1
            w = list(w)
            for _ in range(rnd.randrange(0, max(2, len(w) // 25))):
                w[rnd.randrange(len(w))] = str(rnd.randrange(400))
            w += [str(rnd.randrange(400))] * rnd.randrange(0, 3)
    want = brute_components(rows)
    got = shingle_join.shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len({c for _, c in want.values()}) < len(rows)


def test_document_with_several_texts_is_one_in_links(spark, texts):
    a, b, c = (t for _, t in texts[10:13])
    rows = [(5, a), (5, b), (2, b), (9, a), (7, c), (9, c)]
    got = shingle_join.shingle_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(5, 2), (2, 2), (9, 2), (7, 2)}


def test_buckets_grow_with_the_members(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(400))) for i in range(50)], "doc_id long, text string")
    sets = shingle_join._sets(docs, "doc_id", "text", 5)
    few = shingle_join._buckets(sets)
    monkeypatch.setattr(shingle_join, "BUCKET_BYTES", 1000)
    assert shingle_join._buckets(sets) > 10 * few
    got = shingle_join.shingle_components(docs).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got)


def test_near_copies_with_one_smallest_hash(spark, monkeypatch):
    """A group of near copies above the bound is more than one tile, and no link is lost."""
    monkeypatch.setattr(shingle_join, "TILE_ROWS", 40)
    rnd = random.Random(5)
    rows, w = [], [str(rnd.randrange(10 ** 6)) for _ in range(120)]
    least = min(range(116), key=lambda k: shingle_join.shingle_set(" ".join(w[k:k + 5]))[0])
    spots = [k for k in range(120) if abs(k - least - 2) > 8]
    for i in range(300):
        v = list(w)
        for _ in range(rnd.randrange(1, 7)):
            v[rnd.choice(spots)] = str(rnd.randrange(10 ** 6))
        rows.append((i, " ".join(v)))
    for i in range(300, 360):
        rows.append((i, " ".join(str(rnd.randrange(10 ** 6)) for _ in range(rnd.randrange(90, 140)))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [(i, shingle_join.shingle_set(t)) for i, t in rows]
    live = spark.createDataFrame([(i, len(x), x.tobytes()) for i, x in sets], "id long, n long, set binary").cache()
    first = shingle_join._first_tiles(live)
    assert first.groupBy("tile").count().agg(F.max("count")).first()[0] > 150
    tiled = shingle_join._bounded(first)[0]
    assert tiled.count() == len(rows) == tiled.select("id").distinct().count()
    assert tiled.groupBy("tile").count().agg(F.max("count")).first()[0] <= 40
    monkeypatch.setattr(shingle_join, "PIVOT_TURNS", 0)
    assert shingle_join._bounded(first)[0].groupBy("tile").count().agg(F.max("count")).first()[0] <= 40
    want = brute_components(rows)
    for turns in (0, 3):
        monkeypatch.setattr(shingle_join, "PIVOT_TURNS", turns)
        got = shingle_join.shingle_components(docs).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_tree_bound_keeps_every_link():
    rnd = np.random.default_rng(5)
    base = [np.unique(rnd.integers(0, 1 << 62, n).astype(np.uint64)) for n in rnd.integers(1, 300, 60)]
    sets = base + [np.unique(np.concatenate([b[len(b) // 12:], rnd.integers(0, 1 << 62, len(b) // 12).astype(np.uint64)])) for b in base]
    n = np.array([len(s) for s in sets])
    points = np.array([shingle_join._counts(s, 64) for s in sets])
    tree = shingle_join.CountTree(points, n)
    assert len(tree.levels) > 1
    for a in range(len(sets)):
        found = set(tree.candidates(points[a], int(n[a])))
        for b in range(len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 7 * both >= 3 * (n[a] + n[b]):
                assert b in found


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (5000, 4000), (5000, 4500)]
    got = {r["id"]: r["root"] for r in shingle_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 201)} == {0} and {got[k] for k in range(1001, 1100)} == {1000}
    assert got[5000] == 4000 and got[4500] == 4000


P = pytest.importorskip("public_tokenizers")
MULTI = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    import tiktoken
    ranks = bpe.parse_ranks(open(MULTI, "rb").read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(docs, empty, texts, tik):
    enc = bpe.bpe_encode(docs, MULTI, P.PATTERN, decoded_col="decoded")
    back = bpe.bpe_decode(enc, MULTI, text_col="again")
    got = {r["doc_id"]: r for r in back.collect()}
    for i, t in texts:
        ids = tik.encode_ordinary(t or "")
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == (t or "") == got[i]["again"]
    assert set(docs.columns) - {"text"} <= set(enc.columns) and enc.count() == docs.count()
    assert bpe.bpe_encode(empty, MULTI, P.PATTERN).count() == 0


def test_transducer_is_the_definition(tik):
    ranks = bpe.parse_ranks(open(MULTI, "rb").read())
    rnd = random.Random(2)
    fst, few = bpe.Transducer(ranks), bpe.Transducer(ranks, max_states=50)
    pieces = sorted({"".join(rnd.choice(["a", "b", "ing", "th", "é", "日", "!", "ß", "0", " "]) for _ in range(rnd.randrange(1, 14))).encode()
                     for _ in range(1500)} | {b"a" * 500, b"ab" * 300})
    want = [np.array(tik._core_bpe.encode_single_piece(p), "<u4").tobytes() for p in pieces]
    assert fst.encode_sorted(pieces) == want == few.encode_sorted(pieces)
    assert len(few._known) <= 50
    tiny = {b"a": 0, b"b": 1, b"ab": 2, b"ba": 3, b"aba": 4}
    for p in (b"ababa", b"abab", b"baab", b"a", b"bbaba"):
        assert np.frombuffer(bpe.Transducer(tiny).encode(p), "<u4").tolist() == (
            [tiny[p]] if p in tiny else bpe.merge_by_rank(p, tiny))


def test_utf8_stream_any_cut():
    s = "aé日\U0001F600z\u0000ß" * 3
    data = s.encode()
    for step in range(1, 9):
        u = bpe.Utf8Stream()
        assert "".join([u.feed(data[i:i + step]) for i in range(0, len(data), step)] + [u.feed(b"", end=True)]) == s
    bad = b"a\xf0\x9f\x98" + b"\xff\xc3(" + b"\xe6\x97"
    u = bpe.Utf8Stream()
    assert "".join([u.feed(bytes([b])) for b in bad] + [u.feed(b"", end=True)]) == bad.decode("utf-8", "replace")


def test_cutter_reads_newer_code_points_as_the_library(tik):
    odd = pretokens.newer_code_points()
    cut = pretokens.Cutter(P.PATTERN, odd)
    for c in odd[:: max(1, len(odd) // 50)]:
        s = f"ab{c}12 {c}x"
        ids = [i for p in cut(s) for i in tik._core_bpe.encode_single_piece(p.encode())]
        assert ids == tik.encode_ordinary(s)


def test_token_counts(docs, empty, texts, spark):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    more = spark.createDataFrame([(900, "a<|endoftext|>b <|endoftext|>", None, None, "", 0, 0, 0)], DOCS)
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs.unionByName(more), path, P.PATTERN, size=16, limit=50).collect()}
    for i, t in [*texts, (900, "a<|endoftext|>b <|endoftext|>")]:
        n = len(tok.encode(t or "", add_special_tokens=False))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 50)
    assert token_counts.token_counts(empty, path, P.PATTERN).count() == 0


def test_frequent_words_are_found(spark):
    rows = [(" ".join(["hot"] * 50 + [f"r{i}x{k}" for k in range(30)]),) for i in range(40)] + [(None,)]
    got = token_counts.frequent_words(spark.createDataFrame(rows, "text string").repartition(40), size=8)
    assert "hot" in got and len(got) <= 8


def test_lm_scores(docs, empty, texts):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    toks = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</s>"]
    rows = [*texts, texts[8], (None, "null id text")]
    uni, bi, tri = {}, {}, {}
    for i, t in rows:
        if i is None or not held(i):
            last, prev = None, "<s>"
            for w in toks(t):
                for table, gram in ((uni, w), (bi, (prev, w)), (tri, (last, prev, w))):
                    table[gram] = table.get(gram, 0) + 1
                last, prev = prev, w
    n, v, mu = sum(uni.values()), len(uni), lm_score.MU
    ctx = {**uni, "<s>": uni.get("</s>", 0)}
    got = lm_score.lm_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, shard_bytes=20_000).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i, t in rows:
        base = score = 0.0
        last, prev = None, "<s>"
        for w in toks(t):
            p = (uni.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            p = (bi.get((prev, w), 0) + mu * p) / (ctx.get(prev, 0) + mu)
            if last is not None:
                p = (tri.get((last, prev, w), 0) + mu * p) / (bi.get((last, prev), 0) + mu)
            score += math.log10(p)
            last, prev = prev, w
        r = by[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(toks(t)), sum(w in uni for w in toks(t)), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    assert lm_score.lm_scores(empty, F.lit(False)).count() == 0
    alone = lm_score.lm_scores(docs.limit(3), F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0) for r in alone)


def _automaton(texts, train=None):
    """Learned from the first ``train`` texts."""
    keys, begin = lm_score._tokens(t.encode() for t in texts)
    at = [lm_score._places(k) for k in keys]
    size = len(at[0]) if train is None else begin[train]
    n = [np.bincount(x[:size], minlength=x.max() + 1) for x in at]
    return lm_score.BackoffAutomaton(at, n, begin, len(texts) if train is None else train, size, int((n[0] > 0).sum())), at, n


def test_lm_arcs_add_up_to_one():
    """Over all words and the unknown one, the arcs of every state and what its failure arc leads to are a distribution."""
    texts = ["a b a c", "b a", "", "a b a b c a b"]
    fsa, at, n = _automaton(texts)
    toks = [w for t in texts for w in [*t.split(), None]]
    last = [None if i == 0 or toks[i - 1] is None else toks[i - 1] for i in range(len(toks))]
    types = sorted({w for w in toks if w}) + [None]
    unknown = 0.1 / (len(toks) + 0.1 * (len(types) + 1))
    word = {w: at[0][toks.index(w)] for w in types}
    pair = {(last[i], toks[i]): at[1][i] for i in range(len(toks))}
    triple = {(last[i - 1], last[i], toks[i]): at[2][i] for i in range(1, len(toks)) if last[i]}
    assert fsa.p[0].sum() + unknown == pytest.approx(1)
    one = {}
    for v, state in [(None, fsa.start), *((w, 1 + word[w]) for w in types[:-1])]:
        leave = 10 ** fsa.fail[state]
        one[v] = {w: fsa.p[1][pair[v, w]] if (v, w) in pair else leave * fsa.p[0][word[w]] for w in types}
        assert fsa.fail_to[state] == 0 and sum(one[v].values()) + leave * unknown == pytest.approx(1)
    for (u, v), j in pair.items():
        if v is None:
            continue
        state = fsa.pairs + j
        leave = 10 ** fsa.fail[state]
        assert fsa.fail_to[state] == 1 + word[v]
        rest = leave * 10 ** fsa.fail[1 + word[v]] * unknown
        assert sum(fsa.p[2][triple[u, v, w]] if (u, v, w) in triple else leave * one[v][w] for w in types) + rest == pytest.approx(1)


def test_lm_lanes_carry_the_state():
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcdefghijkl"[:k]) for _ in range(n)) for n, k in ((0, 9), (1, 9), (60, 9), (2, 12), (3, 12), (400, 12))]
    fsa, at, n = _automaton(texts, 3)                              # n-grams of all lengths are unseen in the rest
    whole = fsa.run(10_000)
    assert [bool((x[i] == 0).any()) for x, i in zip(n, at)] == [True] * 3 and (n[2][at[2][-400:]] > 0).any()
    assert all(np.allclose(fsa.run(k), whole) for k in (1, 2, 3, 7, 64))


def test_license_scan(spark, docs, empty):
    rows = [(1, "x\nLicensed under the Apache License, Version 2.0.\nmore text here"), (2, "RELEASED under the MIT license"), (3, None), (4, ""),
            (5, "Intro. This work is licensed under the GNU General Public License, version 3. Outro words follow here."),
            (6, "licensed under some other licence of no name"), (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."),
            (7, "Licensed under CC BY-NC 4.0."), (8, "word " * 50_000 + ". Released under the MIT License.")]
    got = sorted((r["doc_id"], r["license"], r["n_units"]) for r in licenses.license_scan(
        spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, unit string")).collect())
    assert [g[:2] for g in got] == [(1, "Apache-2.0"), (2, "MIT"), (5, "GPL-3.0"), (7, "CC-BY-NC-4.0"), (7, "MIT"), (8, "MIT")]
    assert licenses.license_scan(empty).count() == 0


def test_license_wrapped_notices(spark):
    rows, want = [], set()
    for name, ts in licenses.TEMPLATES.items():
        for t in ts:
            for width in (60, 68, 76, 80):
                for mark, blank in (("", ""), ("# ", "#"), (" * ", " *"), ("// ", "//")):
                    for end in ("\n", "\r\n"):
                        for gap in (True, False):
                            body = textwrap.wrap("This module reads the tables of the survey and joins them by object, night and band.", width)
                            between = [blank] if gap else []
                            lines = [mark + x for x in body] + [blank] + [mark + x for x in textwrap.wrap(t, width)] + between
                            lines += [mark + x for x in textwrap.wrap("It has been used on many nights of data, without any loss of rows so far, and "
                                                                      "its figures are given in the table below. " * 4, width)]
                            want.add((len(rows), name))
                            rows.append((len(rows), end.join(lines)))
    got = {(r["doc_id"], r["license"]) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert want <= got
    plain = [(0, "\n \n" * 50_000 + "A permission\nof no\n\nlicence notice.\n" * 100)]
    assert licenses.license_scan(spark.createDataFrame(plain, "doc_id long, text string")).count() == 0


def test_license_anchor_words_are_needed():
    w = re.compile(r"\.*[a-z0-9][a-z0-9.]*")
    grams = []
    for t in [t for ts in licenses.TEMPLATES.values() for t in ts]:
        ws = [x.rstrip(".") for x in w.findall(t.lower())]
        grams.append([f"{a} {b}" for a, b in zip(ws, ws[1:])])
    held = set(licenses.anchors(grams, 0.75))
    for g in grams:
        without = sum(not set(p.split()) & held for p in g)
        assert all(2 * without < 0.75 * (a + len(g)) for a in range(math.ceil(0.6 * len(g)), 2 * len(g)))


def test_rake_and_calibrate():
    rnd = np.random.default_rng(1)
    tokens = rnd.integers(0, 1000, (3, 4, 2)).astype(float)
    tokens[0, 1] = 0
    goals = [np.array([.5, .3, .2]), np.array([.4, .3, .2, .1]), np.array([.9, .1])]
    w = mixing.rake(tokens, goals, 400)
    assert w.sum(axis=(1, 2)) == pytest.approx(goals[0], abs=1e-4) and w.sum(axis=(0, 2)) == pytest.approx(goals[1], abs=1e-4)
    assert w.sum(axis=(0, 1)) == pytest.approx(goals[2], abs=1e-6)
    for keep in (0.1, 0.5, 0.95, 1.0):
        p = mixing.calibrate(tokens, w, keep)
        assert p.max() <= 1 and (p * tokens).sum() == pytest.approx(keep * tokens.sum())
    assert mixing.rake(np.array([[5.0, 0], [0, 0]]), [np.array([0.0, 1.0])] * 2, 5)[0, 0] == pytest.approx(1)


def test_mix(docs, empty):
    got = mixing.mix(docs.withColumn("mix_p", F.lit("clash")), mixing.TARGETS)
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r["mix_p"] <= 1 and r["mix_kept"] == (r["mix_u"] < r["mix_p"]) for r in rows)
    assert {r["mix_lang"] for r in rows} <= {"en", "*"} and {r["mix_source"] for r in rows} <= {"src0", "*"}
    assert mixing.mix(empty, mixing.TARGETS).count() == 0
    plain = mixing.mix_decisions(docs, mixing.TARGETS).select("doc_id", "mix_kept").collect()
    assert sorted(map(str, plain)) == sorted(map(str, got.select("doc_id", "mix_kept").collect()))


def test_mix_report_and_own_topics(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * rnd.randrange(0, 40)) if i % 9 else None, rnd.choice(["a", "b", "c", None]), rnd.choice(["en", "de"]),
             rnd.choice(["x", "y"])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, subject string")
    easy = mixing.Targets({"source": {"a": .3, "b": .3, "*": .4}, "lang": {"en": .7, "*": .3}, "topic": {"x": .6, "y": .4, "*": 0.0}}, keep=0.3)
    mixed = mixing.mix(docs, easy, topic=F.col("subject"))
    got = {(r["marginal"], r["category"]): r for r in mixing.mix_report(mixed, easy).collect()}
    assert len(got) == 8 and not any(r["missed"] for r in got.values())
    p = {r["doc_id"]: r for r in mixed.collect()}
    total, kept = sum(r["mix_tokens"] for r in p.values()), sum(r["mix_tokens"] for r in p.values() if r["mix_kept"])
    for c in "xy":
        mine = [r for r in p.values() if r["subject"] == c]
        r = got["topic", c]
        assert r["there"] == pytest.approx(sum(m["mix_tokens"] for m in mine) / total)
        assert r["drawn"] == pytest.approx(sum(m["mix_tokens"] for m in mine if m["mix_kept"]) / kept) and abs(r["drawn"] - r["target"]) < 0.05
        assert r["expected"] == pytest.approx(r["target"], abs=1e-6)
    # nearly all is kept, so the large category cannot be held to a tenth; one category has no rows at all
    hard = mixing.Targets({"source": {"a": .9, "zz": .1, "*": 0.0}, "lang": {"en": .1, "*": .9}, "topic": {"x": .5, "y": .5}}, keep=0.95)
    got = {(r["marginal"], r["category"]): r["missed"] for r in mixing.mix_report(mixing.mix(docs, hard, topic=F.col("subject")), hard).collect()}
    assert got["lang", "en"] and got["source", "zz"]
    none = mixing.mix_report(mixing.mix(docs.limit(0), easy, topic=F.col("subject")), easy).collect()
    assert len(none) == 8 and all(r["missed"] and r["drawn"] is None for r in none)


def test_contact_topic_is_an_address(spark):
    old = re.compile(r"[A-Za-z0-9._]+@[A-Za-z0-9.]+")
    rows = [(i, t) for i, t in enumerate(["by @name", "shop @5", "a@.x", "_@b", "x.@y", "é@z", "a@ b", "a@-b", "me.you@site.org now"])]
    got = spark.createDataFrame(rows, "id long, text string").withColumn("topic", mixing.topic_of(F.col("text"))).collect()
    assert [r["topic"] == "contact" for r in got] == [bool(old.search(t)) for _, t in rows]


def test_toxicity(spark, empty):
    rnd = random.Random(4)
    bad, rows, labels = ["vile", "Nasty!", "awfulish"], [], []
    for i in range(600):
        w = [rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(rnd.randrange(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            w[rnd.randrange(len(w))] = rnd.choice(bad)
        rows.append((i, " ".join(w), "en" if i % 2 else "de", "s", "clash", 1, 1, 1))
        if i % 3:
            labels.append((i, int(toxic)))
    extra = [(900, None, None, None, "", 0, 0, 0), (901, "", "en", "s", "", 0, 0, 0)]
    docs = spark.createDataFrame(rows + extra + rows[:1], DOCS)
    lab = spark.createDataFrame([*labels, labels[0], (5, None), (7777, 1)], "doc_id long, toxic int")
    got = toxicity.classify(docs, lab).collect()
    assert len(got) == len(rows) + 3 and set(got[0].asDict()) == {"doc_id", "p_toxic_english", "p_toxic_other", "p_toxic", "toxic"}
    held = [r for r in got if r["doc_id"] < 900 and r["doc_id"] % 3 == 0]
    assert np.mean([r["toxic"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.97
    assert not any(r["toxic"] for r in got if r["doc_id"] >= 900)
    assert not any(r["toxic"] for r in toxicity.classify(docs, lab.limit(0)).collect())
    assert toxicity.classify(empty, lab).count() == 0


def test_chain_against_dense_matrices(spark):
    """Features, chosen buckets, folds, fit, threshold and prediction written out again with one dense matrix per model."""
    rnd = random.Random(6)
    vocab = [f"{a}{b}" for a in ("red", "green,", "Blue", "heavy", "lightest", "(slow)") for b in ("", "er", "iest")]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 12))) for _ in range(200)] + [None, "", " , ; "]
    y0 = np.array([int("red" in (t or "")) for t in texts])
    y1 = np.array([int("red" in (t or "") or rnd.random() < 0.1) for t in texts])
    weight = np.array([rnd.choice([1.0, 2.5]) for _ in texts])
    models = toxicity.fit_chain([toxicity.text_features(t) for t in texts], np.column_stack([y0, y1]), weight, ["one", "two"], size=12)

    grams = []
    for t in texts:
        ws = {w.strip(".,;:!?\"'()[]{}<>|*#%&$@-_~/\\") for w in (t or "").lower().split()} - {""}
        grams.append({zlib.crc32(("w" + w).encode()) % 2 ** 18 for w in ws}
                     | {zlib.crc32(("p" + w[:k]).encode()) % 2 ** 18 for w in ws for k in (4, 5, 6) if len(w) > k})
    every = sorted(set().union(*grams))
    ones = np.array([[float(b in g) for b in every] for g in grams])
    sig = lambda z: 1 / (1 + np.exp(-z))

    def fit(x, y, w):
        w = w / w.sum()
        xx = x.T @ (w[:, None] * x)
        v = np.ones(x.shape[1])
        for _ in range(12):
            v = xx @ v
            v = v / np.sqrt(v @ v)
        step = 1 / (0.26 * (v @ xx @ v) + 1e-5)
        now = ahead = np.zeros(x.shape[1])
        for k in range(250):
            pull = 1e-5 * ahead
            pull[-1] = 0
            then = ahead - step * (x.T @ (w * (sig(x @ ahead) - y)) + pull)
            ahead, now = then + k / (k + 3) * (then - now), then
        return now

    earlier = []                                                # out-of-fold probabilities of the categories before
    for m, y in zip(models, (y0, y1)):
        total, pos = weight.sum(), (weight * y).sum()
        has = weight @ ones
        hit = (weight * y) @ ones
        chi = (hit - has * pos / total) ** 2 * (total / (has * pos) + total / ((total - has) * pos))
        chi[ones.sum(0) < 3] = 0
        best = sorted(sorted(range(len(every)), key=lambda i: (-chi[i], every[i]))[:12])
        assert [every[i] for i in best] == list(m["buckets"])
        x = np.column_stack([ones[:, best], *earlier, np.ones(len(texts))])
        assert np.allclose(m["weights"], fit(x, y, weight), atol=1e-8)
        oof = np.zeros(len(texts))
        for f in range(3):
            test = np.arange(len(texts)) % 3 == f
            oof[test] = sig(x[test] @ fit(x[~test], y[~test], weight[~test]))
        cuts = sorted(set(oof), reverse=True)
        f1 = [2 * (weight * y)[oof >= c].sum() / (weight[oof >= c].sum() + pos) for c in cuts]
        at = int(np.argmax(f1))
        after = cuts[at + 1] if at + 1 < len(cuts) else 0.0
        assert m["threshold"] == pytest.approx(min(max((cuts[at] + after) / 2, 0.1), 0.9))
        earlier.append(oof)

    got = {r["doc_id"]: r for r in toxicity.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), models).collect()}
    chained = []                                                # at prediction, the models' own probabilities
    for m in models:
        x = np.column_stack([ones[:, [every.index(b) for b in m["buckets"]]], *chained, np.ones(len(texts))])
        chained.append(sig(x @ m["weights"]))
        assert np.allclose([got[i][f"p_{m['name']}"] for i in range(len(texts))], chained[-1], atol=1e-12)


def test_chain_uses_earlier_probabilities():
    rnd = np.random.default_rng(0)
    a = rnd.random(900) < 0.5
    buckets = [np.array([1, 5 + i % 7]) if x else np.array([2, 5 + i % 7]) for i, x in enumerate(a)]
    models = toxicity.fit_chain(buckets, np.column_stack([a, a]).astype(int), np.ones(900), ["first", "second"])
    assert [m["name"] for m in models] == ["first", "second"]
    assert len(models[1]["weights"]) == len(models[1]["buckets"]) + 2 and models[1]["weights"][-2] > 0.5


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType())])


def test_nearest(spark):
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(900, 16)).astype(np.float32)
    x[100:400] = x[100]                                         # a third are copies
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(x)]
    odd = [(2000, None, ""), (2020, [0.0] * 16, ""), (2040, [float("nan")] + [1.0] * 15, ""), (2060, [float("inf")] + [1.0] * 15, ""),
           (2080, [None] + [1.0] * 15, ""), (2100, [1.0, 2.0], ""), (2101, [2.0, 1.0], ""), (2120, [], ""), rows[20]]
    df = spark.createDataFrame(rows + odd, VECTORS)
    got = ann.nearest(df, df.filter("vec_id % 20 = 0"), shards=3).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by) == {*range(0, 900, 20), 2100} and by[2100] == [(2101, 4.0)]
    hit = 0
    xd = x.astype(float)
    for q in range(0, 900, 20):
        s = ann._inner(np.repeat(xd[q:q + 1], 900, 0), xd)
        want = [i for i in np.lexsort([np.arange(900), -s]) if i != q][:20]
        assert len(by[q]) == 20 == len({i for i, _ in by[q]}) and all(sc == s[i] for i, sc in by[q])
        assert [i for i, _ in by[q]] == sorted((i for i, _ in by[q]), key=lambda i: (-s[i], i))
        hit += len(set(want) & {i for i, _ in by[q]})
    assert hit / (45 * 20) >= 0.95
    assert [i for i, _ in by[100]][:20] == [*range(101, 121)]    # ties go to the smaller ids
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def recall(x, queries, k=20):
    index = pickle.loads(ann._pack(pd.DataFrame({"id": np.arange(len(x)), "vector": list(x)}), ann.DEGREE, ann.BEAM))
    got = pd.concat(ann._ask(index, queries, x[queries], k, ann.BEAM))
    hit = 0
    for q in queries:
        s = x @ x[q]
        want = [i for i in np.argsort(-s, kind="stable") if i != q][:k]
        hit += len({*want} & {*got.loc[got["query_id"] == q, "vec_id"]})
    return hit / (k * len(queries))


def test_recall_with_large_norms():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    queries = np.arange(0, 3000, 30)
    for norm in (1, 100, 5_000, 1_000_000):
        y = x.copy()
        y[7] *= norm
        assert recall(y, queries) >= 0.95
    x[:30] *= 5_000
    assert recall(x, queries) >= 0.95


def test_graph_degree_and_reach():
    x = np.random.default_rng(2).normal(size=(700, 8))
    graph, start = ann.build_graph(x, degree=8, beam=24)
    assert graph.shape == (701, 8) and (graph[-1] == -1).all()
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() and i not in r for i, r in enumerate(graph[:-1]))
    seen, todo = {start}, [start]
    while todo:
        for j in graph[todo.pop()]:
            if j >= 0 and j not in seen:
                seen.add(int(j))
                todo.append(int(j))
    assert len(seen) > 690


@pytest.mark.parametrize("scale", [1.0, 1e19, 1e25, 1e120, 1e-30])
def test_recall_with_lengths_of_any_size(scale):
    """A tenth of the vectors is longer or shorter by ``scale``; lengths vary in all of them."""
    rnd = np.random.default_rng(3)
    x = rnd.standard_normal((1500, 32))
    x[::10] *= scale
    index = pickle.loads(ann._pack(pd.DataFrame({"vector": list(x), "id": np.arange(len(x))}), ann.DEGREE, ann.BEAM))
    asked = np.arange(0, 1500, 25)
    got = pd.concat(ann._ask(index, asked, x[asked], 20, ann.BEAM))
    hit = 0
    for i in asked:
        s = ann._inner(x, np.broadcast_to(x[i], x.shape))
        s[i] = -np.inf
        hit += len(set(np.argsort(-s, kind="stable")[:20]) & set(got[got["query_id"] == i]["vec_id"]))
    assert hit >= 0.95 * 20 * len(asked)
