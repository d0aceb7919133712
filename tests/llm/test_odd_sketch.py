"""Near duplicates by odd sketches against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

pytest.importorskip("skyflux.llm")

from skyflux.llm import odd_sketch as O  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, sig string, n long, key int, id string"


def brute(rows, width=4):
    """{(id, text): (set size, component)} by comparing all pairs."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            if i is not None and j is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets)), key=str)


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(i, t, "clash", 1, 2, "x") for i, t in rows], DOCS)
    return sorted(map(tuple, O.near_duplicates(docs, **kw).collect()), key=str)


def edited(rnd, w, share, words):
    w = list(w)
    for _ in range(int(share * len(w))):
        w[rnd.randrange(len(w))] = str(rnd.randrange(words))
    return w


@pytest.mark.parametrize("block_bits", [O.BLOCK_BITS, 2])
def test_against_all_pairs(spark, block_bits):
    """Chains of edits around the threshold, groups with several components per bucket, and edge rows."""
    rnd = random.Random(8)
    rows, i = [], 0
    for _ in range(25):
        w = [str(rnd.randrange(500)) for _ in range(rnd.randrange(4, 140))]
        for _ in range(rnd.randrange(1, 12)):
            rows.append((i, " ".join(w)))
            i += 1
            w = edited(rnd, w, rnd.choice([0, 0.01, 0.03, 0.05]), 500)
    base = [str(rnd.randrange(10 ** 6)) for _ in range(120)]
    for _ in range(60):                                      # copies of one text, many not similar to each other
        rows.append((i, " ".join(edited(rnd, base, rnd.choice([0.02, 0.04, 0.06]), 10 ** 6))))
        i += 1
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "ONE\ttwo "), (905, "Ünder ß"), (906, "ünder ß"),
             (None, rows[0][1]), rows[3], rows[3], (907, "zebra " * 30_000), (908, "zebra " * 40_000),
             (77, "first text of a document on two rows"), (50, "first text of a document on two rows"), (77, rows[120][1])]
    assert run(spark, rows, block_bits=block_bits) == brute(rows)


def test_blocks_find_links_that_leaders_miss(spark, monkeypatch):
    """Without leader pairs every link comes from the blocks."""
    rnd = random.Random(3)
    base = [str(rnd.randrange(10 ** 6)) for _ in range(100)]
    rows = [(i, " ".join(edited(rnd, base, 0.02, 10 ** 6))) for i in range(80)]
    whole = O._leader_pairs

    def none(heads, cut):
        pairs, members = whole(heads, cut)
        return pairs.limit(0), members
    monkeypatch.setattr(O, "_leader_pairs", none)
    assert run(spark, rows, block_bits=3) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (None, "a b c d e")]) == [(1, 0, 1, True), (None, 2, None, True)]


def test_sketches_estimate_high_similarities():
    rnd = np.random.default_rng(6)
    cut = O.most_ones(0.8)
    for sim in (0.8, 0.9, 0.97):
        errors, lost = [], 0
        for _ in range(60):
            n = 400
            both = int(round(2 * n * sim / (1 + sim)))
            pool = rnd.integers(0, 1 << 62, 2 * n - both).astype(np.uint64)
            a, b = O.min_hashes(pool[:n]), O.min_hashes(pool[n - both:])
            ones = int(np.bitwise_count((O.odd_sketch(a) ^ O.odd_sketch(b)).view(np.uint64)).sum())
            errors.append(O.estimate(ones) - both / (2 * n - both))
            lost += ones > cut
        assert lost == 0 and abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    apart = [int(np.bitwise_count((O.odd_sketch(O.min_hashes(rnd.integers(0, 1 << 62, 300).astype(np.uint64)))
                                   ^ O.odd_sketch(O.min_hashes(rnd.integers(0, 1 << 62, 300).astype(np.uint64)))).view(np.uint64)).sum()) for _ in range(40)]
    assert min(apart) > cut


def test_min_hashes_agree_with_similarity():
    rnd = np.random.default_rng(9)
    pool = rnd.integers(0, 1 << 62, 6000).astype(np.uint64)
    a, b = O.min_hashes(pool[:4000]), O.min_hashes(pool[2000:])
    assert abs((a == b).mean() - 1 / 3) < 0.15 and len(set(O.band_keys(a).tolist())) == O.BANDS
