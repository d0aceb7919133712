"""Repair of conversations by a rank-convergence parallel Viterbi search.

A row is kept (K, 0), given another role (R, 3) or deleted (D, 4); a row with
empty text is inserted (I, 3) anywhere. Blank rows and repeats must go, a
truncated row that stays costs 3 more. The roles left must read
``(s?(ua)+)?``, which four states follow: nothing yet, after s, after u, after a.

1. All rows are ordered by (conversation, turn, role, text) over the whole
   cluster and cut into chunks of at most CHUNK rows of one conversation: one
   byte a row (role and fault). A conversation of any length is as many chunks.
2. Backward costs: every chunk runs from its end to its start at once. The last
   chunk of a conversation knows the costs at its end, the others start from a
   speculative vector. Fix-up passes give a chunk the vector that the chunk
   after it came to, and rerun it until its costs differ from the earlier ones
   only by a constant; most chunks stop after a few rows. Where costs do not
   converge (every row needs a new role, so that two phases stay apart), the
   chunks left after FIX_PASSES run from four vectors, whose answers are then
   joined per conversation, a few numbers per chunk.
3. The stitched backward costs drive the trace: at a row the ASCII-least edit
   that keeps the least cost is taken. Every chunk is traced from each state it
   can be entered in; the entered one is found from the exits of those before.
4. Texts and traces meet in order, and a conversation's rows are read as a
   stream: only its digest, its counts and its audit are in memory.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyflux.llm.common import checkpoint_table, lean

CHUNK_BITS = 13                       # chunks of 8,192 rows
FIX_PASSES = 4
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3

#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. The state that a user
#: or assistant row, new or with a changed role, leads to.
_TURN = (2, 2, 3, 2)
#: Costs from the end of the conversation: what is left open is closed by inserts.
_END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 40

# codes of a row: role class (0 other, 1 s, 2 u, 3 a) + 4 truncated; 8 blank, 9 repeat
_MUST_GO = 8
#: (state, role class) -> state, where the row may stay as it is
_KEEP = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}


def _step(code: int, after: tuple) -> tuple:
    """Costs before a row from those after it (inserts before the row included)."""
    if code >= _MUST_GO:
        return tuple(c + DELETE for c in after)
    more, role = (KEEP_TRUNCATED if code & 4 else 0), code & 3
    out = []
    for q in range(4):
        best = min(after[q] + DELETE, after[_TURN[q]] + REROLE + more)
        to = _KEEP.get((q, role))
        out.append(min(best, after[to] + more) if to is not None else best)
    u, a = min(out[2], out[3] + INSERT), min(out[3], out[2] + INSERT)
    return min(out[0], u + INSERT), min(out[1], u + INSERT), u, a


def _level(v: tuple) -> tuple:
    """The vector up to a constant: its least entry is 0."""
    low = min(v)
    return tuple(c - low for c in v)


def backward(codes: bytes, end: tuple) -> tuple:
    """Costs at the start of a chunk, up to a constant."""
    v = _level(end)
    for code in reversed(codes):
        if code < _MUST_GO:
            v = _level(_step(code, v))
    return v


def rerun(codes: bytes, old: tuple, new: tuple, start: tuple) -> tuple:
    """``backward(codes, new)``, given that ``backward(codes, old)`` is ``start``:
    stops where the costs differ from the earlier ones only by a constant."""
    a, b = _level(old), _level(new)
    for code in reversed(codes):
        if a == b:
            return start
        if code < _MUST_GO:
            a, b = _level(_step(code, a)), _level(_step(code, b))
    return b


def transfer(codes: bytes) -> tuple:
    """The chunk's answers to the four vectors that allow one end state only, row by end state."""
    out = []
    for q in range(4):
        v = tuple(0 if i == q else _FAR for i in range(4))
        for code in reversed(codes):
            if code < _MUST_GO:
                v = tuple(min(c, _FAR) for c in _step(code, v))
        out.append(v)
    return tuple(out)


def apply_transfer(answers, end: tuple) -> tuple:
    return _level(tuple(min(answers[q][i] + end[q] for q in range(4)) for i in range(4)))


def trace(codes: bytes, end: tuple, state: int, last: bool) -> tuple[str, int, int]:
    """(edits, state at the end, cost) of the ASCII-least cheapest way through a chunk."""
    costs = [tuple(end)]
    for code in reversed(codes):
        costs.append(_step(code, costs[-1]) if code < _MUST_GO else costs[-1])
    costs.reverse()
    edits, spent = [], 0
    for i, code in enumerate(codes):
        if code >= _MUST_GO:
            edits.append("D")
            spent += DELETE
            continue
        here, after, more = costs[i], costs[i + 1], KEEP_TRUNCATED if code & 4 else 0
        while True:
            if after[state] + DELETE == here[state]:
                edits.append("D")
                spent += DELETE
                break
            if here[_TURN[state]] + INSERT == here[state]:
                edits.append("I")
                spent += INSERT
                state = _TURN[state]
                continue
            to = _KEEP.get((state, code & 3))
            if to is not None and after[to] + more == here[state]:
                edits.append("K")
                spent += more
                state = to
                break
            edits.append("R")
            spent += REROLE + more
            state = _TURN[state]
            break
    while last and state in (1, 2):
        edits.append("I")
        spent += INSERT
        state = _TURN[state]
    return "".join(edits), state, spent


@functools.lru_cache(maxsize=4096)
def _short_trace(codes: bytes, end: tuple, state: int, last: bool):
    return trace(codes, end, state, last)


def _trace(codes: bytes, end: tuple, state: int, last: bool):
    return _short_trace(codes, end, state, last) if len(codes) <= 32 else trace(codes, end, state, last)


# ---------------------------------------------------------------- 1: chunks
def _coded(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(pos, conv, turn, role, text): rows in order; ``pos`` is the
    place in that order, with the number of the partition in its upper bits."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), t.alias("text"),
                     F.monotonically_increasing_id().alias("salt"))      # equal rows are dealt to several partitions too
    rows = rows.repartitionByRange("conv", "turn", "role", "text", "salt").sortWithinPartitions("conv", "turn", "role", "text", "salt")
    kept = rows.select(F.monotonically_increasing_id().alias("pos"), "conv", "turn", "role", "text")
    return checkpoint_table(kept, "turns")


def _key(conv: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("null"))


def _chunks(turns: DataFrame, bits: int) -> DataFrame:
    """(conv, chunk, first, codes, last, opens): chunks of one conversation (its key) in order."""
    bare = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))       # ASCII white space at the end is dropped
    end = F.substring(bare, -1, 1)
    role = F.substring("role", 1, 1)
    code = (F.when(role == "s", 1).when(role == "u", 2).when(role == "a", 3).otherwise(0)
            + F.when(end.isin(".", "!", "?"), 0).otherwise(4))
    narrow = turns.select("pos", _key(F.col("conv")).alias("conv"), F.when(bare == "", _MUST_GO).otherwise(code).alias("code"))
    # first row of every (conversation, role, text), found without ordering a group
    first = (turns.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos"))
             .select("pos", F.lit(True).alias("is_first")))
    narrow = narrow.join(first, "pos", "left").withColumn(
        "code", F.when(F.col("is_first").isNull() & (F.col("code") < _MUST_GO), 9).otherwise(F.col("code")))
    packed = (narrow.groupBy("conv", F.shiftright("pos", bits).alias("chunk"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows")))       # 2^bits at most
    w = Window.partitionBy("conv").orderBy("chunk")
    return checkpoint_table(packed.select(
        "conv", "chunk", F.col("rows")[0]["pos"].alias("first"), F.transform("rows", lambda r: r["code"].cast("int")).alias("codes"),
        F.lead("chunk").over(w).isNull().alias("last"), (F.row_number().over(w) == 1).alias("opens")), "chunks")


# ------------------------------------------------- 2: backward costs, stitched
_VEC = "conv string, chunk long, first long, codes array<int>, last boolean, opens boolean, end array<long>, start array<long>"


def _rows(batches: Iterator[pd.DataFrame], fn, names: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = [fn(r) for r in pdf.itertuples(index=False)]
        got = pd.DataFrame(out, columns=names) if out else pd.DataFrame({n: [] for n in names})
        with lean():
            yield pd.concat([pdf[["conv", "chunk", "first", "codes", "last", "opens"]].reset_index(drop=True), got], axis=1)


def _vec(x) -> tuple:
    return tuple(int(c) for c in x)


def _codes(x) -> bytes:
    return bytes(int(c) for c in x)


def _stitched(chunks: DataFrame, fix_passes: int) -> DataFrame:
    """Every chunk with the costs at its end, right up to a constant."""
    split = chunks.filter(~(F.col("last") & F.col("opens")))
    whole = chunks.filter(F.col("last") & F.col("opens")).withColumn("end", F.array(*[F.lit(c).cast("long") for c in _END]))
    names = ["end", "start"]

    def speculate(batches):
        return _rows(batches, lambda r: (list(_END), list(backward(_codes(r.codes), _END))), names)

    now = checkpoint_table(split.mapInPandas(speculate, _VEC), "chunk-costs")
    follow = Window.partitionBy("conv").orderBy("chunk")
    for turn in range(fix_passes + 1):
        after = now.withColumn("wanted", F.lead("start").over(follow))
        wrong = F.col("wanted").isNotNull() & (F.col("wanted") != F.col("end"))
        if after.filter(wrong).isEmpty():
            break
        if turn == fix_passes:
            return whole.select("conv", "chunk", "first", "codes", "last", "opens", "end").unionByName(_by_transfer(now))

        def fix(batches):
            def one(r):
                if r.wanted is None or _vec(r.wanted) == _vec(r.end):
                    return list(r.end), list(r.start)
                return list(r.wanted), list(rerun(_codes(r.codes), _vec(r.end), _vec(r.wanted), _vec(r.start)))
            return _rows(batches, one, names)

        now = checkpoint_table(after.mapInPandas(fix, _VEC), "chunk-costs")
    return whole.select("conv", "chunk", "first", "codes", "last", "opens", "end").unionByName(now.drop("start"))


def _by_transfer(now: DataFrame) -> DataFrame:
    """Costs at the chunks' ends from the chunks' answers to four vectors."""
    def answer(batches):
        for pdf in batches:
            flat = [[c for v in transfer(_codes(x)) for c in v] for x in pdf["codes"]]
            yield pdf[["conv", "chunk"]].assign(answers=flat)

    def join(pdf):                                            # 16 numbers per chunk of one conversation
        pdf, ends, end = pdf.sort_values("chunk", ascending=False), [], _level(_END)
        for x in pdf["answers"]:
            ends.append(list(end))
            end = apply_transfer([x[i:i + 4] for i in range(0, 16, 4)], end)
        return pdf[["conv", "chunk"]].assign(end=ends)

    told = now.select("conv", "chunk", "codes").mapInPandas(answer, "conv string, chunk long, answers array<long>")
    ends = told.groupBy("conv").applyInPandas(join, "conv string, chunk long, end array<long>")
    return now.drop("end", "start").join(ends, ["conv", "chunk"]).select("conv", "chunk", "first", "codes", "last", "opens", "end")


# ------------------------------------------------------------- 3: the trace
def _traced(chunks: DataFrame) -> DataFrame:
    """(conv, pos, codes, edits, state, cost) per chunk; ``pos`` is its first row."""
    out = "conv string, pos long, codes array<int>, edits string, state int, cost long"
    stored = checkpoint_table(chunks, "chunk-ends")
    whole, split = stored.filter("last AND opens"), stored.filter("NOT (last AND opens)")

    def exits(batches):
        for pdf in batches:
            to = [[_trace(_codes(c), _vec(e), q, bool(z))[1] for q in range(4)] for c, e, z in zip(pdf["codes"], pdf["end"], pdf["last"])]
            yield pdf[["conv", "chunk"]].assign(to=to)

    def chain(key, pdf):                                      # four numbers per chunk of one conversation
        pdf, state, entered = pdf.sort_values("chunk"), 0, []
        for to in pdf["to"]:
            entered.append(state)
            state = int(to[state])
        return pdf[["conv", "chunk"]].assign(state=entered)

    entered = (split.mapInPandas(exits, "conv string, chunk long, to array<int>")
               .groupBy("conv").applyInPandas(chain, "conv string, chunk long, state int"))
    ready = whole.withColumn("state", F.lit(0)).unionByName(split.join(entered, ["conv", "chunk"]).select(*whole.columns, "state"))

    def write(batches):
        for pdf in batches:
            done = [_trace(_codes(c), _vec(e), int(q), bool(z)) for c, e, q, z in zip(pdf["codes"], pdf["end"], pdf["state"], pdf["last"])]
            yield pd.DataFrame({"conv": pdf["conv"], "pos": pdf["first"], "codes": pdf["codes"], "edits": [d[0] for d in done],
                                "state": pdf["state"], "cost": [d[2] for d in done]})

    return ready.select("conv", "first", "codes", "end", "state", "last").mapInPandas(write, out)


# --------------------------------------------------------- 4: rows and edits
class _Reader:
    """Reads one conversation's chunks and rows in order."""

    def __init__(self):
        self.sha, self.audit, self.cost, self.lines = hashlib.sha256(), [], 0, 0
        self.counts = {8: 0, 9: 0, 4: 0}
        self.turns = self.low = self.high = self.seen = self.role = None
        self.illegal, self.edits, self.codes, self.state = 0, "", (), 0
        self.at = self.row = 0

    def line(self, role: str, text: str) -> None:
        if self.lines:
            self.sha.update(b"\n")
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.state = _TURN[self.state]
            self.line("user" if self.state == 2 else "assistant", "")
            self.at += 1

    def chunk(self, codes, edits: str, state: int, cost: int) -> None:
        self.codes, self.edits, self.state, self.at, self.row = codes, edits, state, 0, 0
        self.audit.append(edits)
        self.cost += cost

    def turn(self, turn, role: str, text: str) -> None:
        code = int(self.codes[self.row])
        kind = code if code >= _MUST_GO else code & 4
        if kind:
            self.counts[kind] += 1
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns = (self.turns or 0) + (turn != self.high)
            self.high = turn
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role
        self.row += 1
        self.inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            self.line(role, text)
        elif edit == "R":
            self.state = _TURN[self.state]
            self.line("user" if self.state == 2 else "assistant", text)
        if self.row == len(self.codes):
            self.inserts()

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.counts[8], self.counts[9], self.counts[4], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def repair(rows: DataFrame, convs: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", bits: int = CHUNK_BITS, fix_passes: int = FIX_PASSES) -> DataFrame:
    """One row per conversation of ``rows`` and of ``convs`` (a table with the
    column ``conv``, by default that of ``rows``): the id, gaps, blank,
    duplicate, truncated, illegal, cost, audit (the edits' initials) and
    repaired_sha256 (digest of the repaired ``role:text`` lines).

    Rows are read by turn, nulls first; of equal turns by role and text. A null
    role or text counts as one space, a null id as an id of its own. Repeated
    rows are repeats. A conversation without rows has zeros, no audit and the
    digest of the empty string; an empty table gives an empty result. Other
    columns are ignored. Turns are longs. The digest of one conversation can
    only be made in order, so a conversation is read by one task, as a stream;
    its audit is one cell and so limited to 2 GB.
    """
    turns = _coded(rows, conv, turn, role, text)
    chunks = _chunks(turns, bits)
    traced = _traced(_stitched(chunks, fix_passes))
    kind = turns.schema["conv"].dataType.simpleString()
    none = {"id": kind, "turn": "long", "role": "string", "text": "string", "codes": "array<int>", "edits": "string", "state": "int", "cost": "long"}
    def shaped(df: DataFrame, rank: int) -> DataFrame:
        return df.select("conv", F.col("pos") if "pos" in df.columns else F.lit(-1).cast("long").alias("pos"), F.lit(rank).alias("kind"),
                         *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in none.items()])

    ids = (rows if convs is None else convs).select(F.col(conv).alias("id")).distinct().withColumn("conv", _key(F.col("id")))
    stream = shaped(ids, 0).unionByName(shaped(traced, 1)).unionByName(shaped(turns.withColumn("conv", _key(F.col("conv"))), 2))
    stream = stream.repartition("conv").sortWithinPartitions("conv", "pos", "kind")
    id_type = to_arrow_type(turns.schema["conv"].dataType)
    names = [conv, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = f"`{conv}` {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, of, done = None, None, None, []
        target = pa.schema([pa.field(conv, id_type)] + [pa.field(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names[1:]])

        def out():
            cells = list(zip(*done))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, target)], schema=target)

        for b in batches:
            keys, ids = b.column("conv").to_pylist(), b.column("id")
            c = {n: b.column(n).to_pylist() for n in ("kind", "turn", "role", "codes", "edits", "state", "cost")}
            texts = b.column("text")
            for i, key in enumerate(keys):
                if key != at:                                 # a conversation opens with its id
                    if at is not None:
                        done.append((of, *now.result()))
                        if len(done) >= 4096:
                            yield out()
                            done = []
                    now, at, of = _Reader(), key, ids[i].as_py()
                if c["kind"][i] == 1:
                    now.chunk(c["codes"][i], c["edits"][i], c["state"][i], c["cost"][i])
                elif c["kind"][i] == 2:
                    now.turn(c["turn"][i], c["role"][i], texts[i].as_py())
        if at is not None:
            done.append((of, *now.result()))
        if done:
            yield out()

    return stream.mapInArrow(read, schema)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) after the damage that crc32(`conv:turn`) % 20
    names: 0 drops the row, 1 empties its text, 2 takes its ``[.!?]`` away, 3
    repeats it, 4 makes it a user's. Nulls of role and text, and in the
    checksum those of id and turn, count as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    t, r = F.coalesce(F.col(text), space), F.coalesce(F.col(role), space)
    out = rows.select(F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(r).alias(role),
                      F.when(kind == 1, "").when(kind == 2, F.translate(t, ".!?", "")).otherwise(t).alias(text), kind.alias("_kind"))
    return (out.filter("_kind <> 0").withColumn("_kind", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("_kind"))
