"""Conversation repair against a search over all edits, and its chunks against whole runs."""

import functools
import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("skyflux.llm")

from skyflux.llm import conversations as C  # noqa: E402

ROWS = "conv_id long, turn long, role string, text string, edits string, pos int, kind string"
TEXTS = ["Fine.", "And then", "", " \t", "Why?", "né\n", "x!\n ", None, "Fine.", "\x0b.\x0c", "\xa0"]
ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "assistant ", "sys"]


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        x = "" if k == 1 else re.sub(r"[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines): least over all edits, by dynamic programming on the roles' initials from the front."""
    fault = faults(rows)

    @functools.cache
    def best(i, roles, inserts):                             # roles: "", "s", "u" or "a", the last initial so far
        ways = [(0, "", ())] if i == len(rows) and roles in ("", "a") else []
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[roles]
        name = {"u": "user", "a": "assistant"}[follow]
        options = [("I", 3, i, follow, inserts + 1, (name, ""))] if inserts < 3 else []
        if i < len(rows):
            options.append(("D", 4, i + 1, roles, 0, None))
            if fault[i] not in ("blank", "duplicate"):
                more, first = 3 if fault[i] == "truncated" else 0, rows[i][2][:1]
                options.append(("R", 3 + more, i + 1, follow, 0, (name, rows[i][3])))
                if first == follow or (roles == "" and first == "s"):
                    options.append(("K", more, i + 1, first, 0, (rows[i][2], rows[i][3])))
        for letter, cost, j, to, k, line in options:
            got = best(j, to, k)
            if got:
                ways.append((cost + got[0], letter + got[1], ((line,) if line else ()) + got[2]))
        return min(ways) if ways else None
    return best(0, "", 0)


def expected(rows, ids):
    out, convs = [], {c: [] for c in ids}
    for r in rows:
        convs[r[0]].append(r)
    for c, mine in convs.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        turns = [r[1] for r in mine if r[1] is not None]
        f = faults(mine)
        cost, audit, lines = cheapest(tuple(mine))
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(seed, convs):
    rnd = random.Random(seed)
    out = []
    for c in range(convs):
        n, plain = rnd.randrange(1, 9), rnd.random() < 0.4
        for t in range(n):
            role = ("user", "assistant")[t % 2] if plain else rnd.choice(ROLES)
            out.append((c * 7, t + (t > 3), role, rnd.choice(TEXTS) if rnd.random() < 0.5 else f"Line {rnd.randrange(60)}."))
    return out


def run(spark, rows, **kw):
    src = spark.createDataFrame([(*r, "clash", 1, "k") for r in rows], ROWS)
    got = [tuple(r) for r in C.repair(C.damage(src), src, **kw).collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r[0] or 0))


EDGES = [(None, 0, "user", "Null id."), (None, 1, "assistant", "Yes."), (2 ** 62 + 1, None, "user", "No turn."), (2 ** 62 + 1, 5, None, None),
         (5, 3, "user", "Same."), (5, 3, "user", "Same."), (5, 3, "assistant", "Tie."), (9, -4, "system", "s" * 100_000)]


@pytest.mark.parametrize("bits", [C.CHUNK_BITS, 1])
def test_repair_against_all_edits(spark, bits):
    rows = random_rows(5, 120) + EDGES
    assert run(spark, rows, bits=bits) == expected(damaged(rows), {r[0] for r in rows})


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("passes", [0, 2, 50])
def test_long_conversation_in_many_chunks(spark, passes):
    """Roles that no row may keep leave two phases apart, so that costs never converge."""
    rnd = random.Random(2)
    rows = ([(1, t, "human" if t % 2 else "gpt", f"Turn {t}.") for t in range(60)]
            + [(2, t, rnd.choice(ROLES[:5]), rnd.choice(["ok", f"T{t}.", f"T{t}"])) for t in range(90)])
    got = {r[0]: r for r in run(spark, rows, bits=2, fix_passes=passes)}
    assert got == {r[0]: r for r in run(spark, rows)}
    want = {r[0]: r for r in expected(damaged(rows), {1, 2})}
    assert got == want


def test_rerun_and_transfer_agree_with_whole_runs():
    rnd = random.Random(4)
    for _ in range(300):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 6, 7, 8, 9]) for _ in range(rnd.randrange(0, 30)))
        old, new = (tuple(rnd.randrange(9) for _ in range(4)) for _ in range(2))
        assert C.rerun(codes, old, new, C.backward(codes, old)) == C.backward(codes, new)
        assert C.apply_transfer(C.transfer(codes), new) == C.backward(codes, new)
