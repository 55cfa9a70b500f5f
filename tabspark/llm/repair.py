"""Repair of the structure of conversations: the cheapest edits that make the roles alternate.

The rows of a conversation, each one symbol (role initial and fault), are read by an automaton of four
states for ``(s?(ua)+)?``.  The cost of the cheapest way on from each state is a vector; less its last
entry there are only a few dozen vectors, whatever the conversation.  So the vectors' transitions over every
block of ``BLOCK`` symbols fit a table, computed once a worker (the four-Russians method).  A conversation is
solved from its end, a lookup a block, keeping one vector number a block; then forward, each block
expanded backward from the vector at its right into the costs at its symbols, which show all
optimal edits.  Taking the least letter of these at each place gives the least audit of all cheapest ones.

Rows are numbered by an ordered scan over range partitions, and symbols meet as strings of ``CHUNK`` rows,
then as one string a conversation: a byte a row, as long as the audit that it gets.  Texts stay in
chunks; only their hash, which cannot be split, reads a conversation's chunks one after the other.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.scan import Spec, ordered_scan

from . import common as C

BLOCK = 4
CHUNK = 1024
assert CHUNK % BLOCK == 0

# Costs, and the automaton of (s?(ua)+)? with states start, after s, after u, after a.
RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
GROW = (2, 2, 3, 2)  # the state after a user or assistant row, whichever is due
KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
DUE = ("user", "user", "assistant", "user")
END = (0, 10, 5, 0)  # from each state: the rows missing for an end in start or after a

INITIALS = "suax"  # x: any other
FAULTS = ("", "blank", "duplicate", "truncated")
GONE, PAD = 8, 9  # symbols: initial, plus 4 if truncated; a row that must go; nothing
SYMBOLS = 10


def symbol(code: str) -> int:
    """The symbol of a row's code, a letter of initial and fault (see ``_codes``)."""
    initial, fault = divmod(ord(code) - 65, 4)
    return GONE if fault in (1, 2) else initial + 4 * (fault == 3)


def step(after: tuple, sym: int) -> tuple:
    """Costs before a symbol from the costs after it."""
    if sym == PAD:
        return after
    g = [DELETE + c for c in after]
    if sym != GONE:
        extra = TRUNCATED * (sym >= 4)
        for q in range(4):
            to = KEEP.get((INITIALS[sym % 4], q))
            g[q] = min(g[q], extra + RETAG + after[GROW[q]], *([] if to is None else [extra + after[to]]))
    for _ in range(2):  # rows inserted before it
        g = [min(c, INSERT + g[GROW[q]]) for q, c in enumerate(g)]
    return tuple(g)


@functools.cache
def tables():
    """(vectors, next and offset by vector and symbol, next and offset by vector and block)."""
    vectors, number, one = [END], {END: 0}, []
    for v in vectors:  # grows as it goes
        row = []
        for sym in range(SYMBOLS):
            g = step(v, sym)
            norm = tuple(c - g[3] for c in g)
            if norm not in number:
                number[norm] = len(vectors)
                vectors.append(norm)
            row.append((number[norm], g[3]))
        one.append(row)
    nxt, off = np.array(one).transpose(2, 0, 1)
    block = np.arange(SYMBOLS**BLOCK)
    to = np.repeat(np.arange(len(vectors))[:, None], len(block), axis=1)
    add = np.zeros_like(to)
    for k in range(BLOCK):  # the last symbol is the lowest digit
        sym = block // SYMBOLS**k % SYMBOLS
        add += off[to, sym]
        to = nxt[to, sym]
    return vectors, one, to.astype(np.int16), add.astype(np.int32)


@functools.lru_cache(maxsize=1 << 17)
def trace(right: int, block: tuple, q: int) -> tuple:
    """Edits of a block from state ``q``, when its right end has costs ``right``: for each symbol (letters,
    state at its start), and the state at the end."""
    vectors, one, *_ = tables()
    costs, base = [vectors[right]], 0
    v = right
    for sym in reversed(block):
        v, add = one[v][sym]
        base += add
        costs.append(tuple(c + base for c in vectors[v]))
    costs.reverse()
    out = []
    for k, sym in enumerate(block):
        if sym == PAD:
            break
        letters, start = "", q
        while True:
            cost, after = costs[k][q], costs[k + 1]
            to = KEEP.get((INITIALS[sym % 4], q)) if sym != GONE else None
            extra = TRUNCATED * (4 <= sym < GONE)
            if DELETE + after[q] == cost:
                letters += "D"
            elif INSERT + costs[k][GROW[q]] == cost:
                letters, q = letters + "I", GROW[q]
                continue
            elif to is not None and extra + after[to] == cost:
                letters, q = letters + "K", to
            else:
                letters, q = letters + "R", GROW[q]
            break
        out.append((letters, start))
    return tuple(out), q


def blocks_of(codes: str) -> list[tuple]:
    syms = [symbol(c) for c in codes]
    syms += [PAD] * (-len(syms) % BLOCK)
    return list(zip(*[iter(syms)] * BLOCK))


def rights_of(blocks: list[tuple], right: int = 0) -> tuple[list[int], int, int]:
    """The vector at the right of each block, the one at the left of all, and the cost between."""
    _, _, nxt, off = tables()
    rights, cost = [], 0
    for b in reversed(blocks):
        rights.append(right)
        k = functools.reduce(lambda x, s: x * SYMBOLS + s, b, 0)
        right, cost = int(nxt[right, k]), cost + int(off[right, k])
    return rights[::-1], right, cost


def missing(q: int) -> int:
    """Rows to insert at the end in state ``q``."""
    return END[q] // INSERT


def solve(codes: str) -> tuple[int, str, list[tuple[int, int]]]:
    """Cost, audit, and for each ``CHUNK`` rows the vector at their right and the state at their left."""
    blocks = blocks_of(codes)
    rights, left, cost = rights_of(blocks)
    audit, chunks, q = [], [], 0
    for k, (b, right) in enumerate(zip(blocks, rights)):
        if k % (CHUNK // BLOCK) == 0:
            chunks.append((rights[min(k + CHUNK // BLOCK, len(blocks)) - 1], q))
        edits, q = trace(right, b, q)
        audit += [letters for letters, _ in edits]
    return cost + tables()[0][left][0], "".join(audit) + "I" * missing(q), chunks


def edits_of(codes: str, right: int, q: int, last: bool) -> list[tuple]:
    """For each row of a chunk (roles of rows to insert before it, letter, role if it is changed), and one
    more for the rows to insert at the very end."""
    out = []
    blocks = blocks_of(codes)
    for b, at in zip(blocks, rights_of(blocks, right)[0]):
        edits, q = trace(at, b, q)
        for letters, state in edits:
            before = []
            for _ in letters[:-1]:
                before.append(DUE[state])
                state = GROW[state]
            out.append((before, letters[-1], DUE[state] if letters[-1] == "R" else None))
    if last:
        before = [DUE[q], DUE[GROW[q]]][: missing(q)]
        out.append((before, "", None))
    return out


LEGAL = {"su", "ua", "au"}
EMPTY = hashlib.sha256().hexdigest()


def _solution(codes: pa.Array) -> pa.Array:
    rows = []
    for s in codes.to_pylist():
        cost, audit, chunks = solve(s)
        faults = [s.count(c) for c in ALPHABET]
        count = lambda f: sum(faults[i * 4 + f] for i in range(4))
        initials = s.translate(TO_INITIAL)
        illegal = sum(a + b not in LEGAL for a, b in itertools.pairwise(initials))
        rows.append({"blank": count(1), "duplicate": count(2), "truncated": count(3), "illegal": illegal, "cost": cost,
                     "audit": audit, "chunks": [{"right": r, "state": q} for r, q in chunks]})
    return pa.array(rows, _SOLUTION)


ALPHABET = "".join(chr(65 + k) for k in range(16))
TO_INITIAL = {65 + k: INITIALS[k // 4] for k in range(16)}
_I = pa.int64()
_SOLUTION = pa.struct([("blank", _I), ("duplicate", _I), ("truncated", _I), ("illegal", _I), ("cost", _I), ("audit", pa.string()),
                       ("chunks", pa.list_(pa.struct([("right", pa.int32()), ("state", pa.int32())])))])
_EDITS = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("op", pa.string()), ("role", pa.string())]))


def _solver():
    return F.arrow_udf(_solution, "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
                                  " chunks array<struct<right: int, state: int>>")


def _editor():
    def edits(codes: pa.Array, right: pa.Array, state: pa.Array, last: pa.Array) -> pa.Array:
        rows = zip(*(x.to_pylist() for x in (codes, right, state, last)))
        return pa.array([[dict(zip(("before", "op", "role"), e)) for e in edits_of(*r)] for r in rows], _EDITS)
    return F.arrow_udf(edits, "array<struct<before: array<string>, op: string, role: string>>")


def _digest(batches):
    """SHA-256 of each conversation's chunks, which come sorted, joined by newlines; one chunk in memory."""
    names = ["conv", "sha"]
    conv, h = None, None
    for batch in batches:
        out = []
        for c, text in zip(batch.column(0).to_pylist(), batch.column(2)):
            if h is None or c != conv:
                if h is not None:
                    out.append((conv, h.hexdigest()))
                conv, h = c, hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(text.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*out) if out else ([], []))], names)
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([h.hexdigest()], pa.string())], names)


SPACE = r"[\\x20\\x09-\\x0D]"


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
           ) -> tuple[DataFrame, DataFrame]:
    """(conversations, rows): ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256`` of every conversation, and its repaired rows ``conv``, ``pos``, ``role``, ``text``.

    Rows are in order of turn (null first); equal turns by role, first 100 characters of the text, hash of the text, and rows
    that are alike by any.  A null role or text counts as one space; null conversations are one
    conversation.  A role whose first character is not s, u or a (also an empty one) fits nowhere as it is.
    A very long text is held once a task; a long conversation spans tasks but for its string of symbols and its hash.
    Empty tables give empty results; other columns are not read.
    """
    d = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                     F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"))
    d = C.written(d.withColumn("uid", F.monotonically_increasing_id()), "repair-rows")

    rows = d.select("conv", "turn", "role", F.expr("left(text, 100)").alias("head"), F.sha2("text", 256).alias("hash"), "uid",
                    F.expr("text NOT RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'").alias("blank"),
                    F.expr(f"text NOT RLIKE '[.!?]{SPACE}*\\\\z'").alias("cut"),
                    F.expr("CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END").alias("i"))
    rows = ordered_scan(rows, ["conv"], ["turn", "role", "head", "hash", "uid"], [Spec("pos", "row_number")])
    first = rows.groupBy("conv", "role", "hash").agg(F.min("pos").alias("p1")).select(F.col("conv").alias("c1"), "p1", F.lit(True).alias("new"))
    rows = rows.join(first, F.col("conv").eqNullSafe(F.col("c1")) & (F.col("pos") == F.col("p1")), "left")
    fault = "CASE WHEN blank THEN 1 WHEN new IS NULL THEN 2 WHEN cut THEN 3 ELSE 0 END"
    rows = C.written(rows.select("conv", "turn", "uid", "pos", F.expr(f"(pos - 1) div {CHUNK}").alias("chunk"),
                                 F.expr(f"char(65 + 4 * i + {fault})").alias("code")), "repair-codes")

    # one string of codes a chunk, then one a conversation
    ordered = "array_join(transform(array_sort(collect_list(struct({0}, {1}))), x -> x.{1}), '')"
    parts = C.written(rows.groupBy("conv", "chunk").agg(F.expr(ordered.format("pos", "code")).alias("codes")), "repair-chunks")
    whole = parts.groupBy("conv").agg(F.expr(ordered.format("chunk", "codes")).alias("codes"))
    solved = C.written(whole.select("conv", _solver()("codes").alias("s")), "repair-solved")
    gaps = (rows.groupBy("conv", "turn").agg(F.lit(1).alias("n")).groupBy("conv")
            .agg(F.expr("coalesce(max(turn) - min(turn) + 1 - count(turn), 0)").alias("gaps")).withColumnRenamed("conv", "cg"))

    # the edits of every row
    state = solved.select(F.col("conv").alias("cs"), F.expr("size(s.chunks)").alias("n_chunks"), F.posexplode("s.chunks").alias("k", "c"))
    edits = parts.join(state, F.col("conv").eqNullSafe(F.col("cs")) & (F.col("chunk") == F.col("k")))
    edits = edits.select("conv", "chunk", F.posexplode(_editor()("codes", "c.right", "c.state", F.expr("k = n_chunks - 1"))).alias("at", "e"))
    edits = edits.select(F.col("conv").alias("ce"), F.col("chunk").alias("ke"), (F.col("chunk") * CHUNK + F.col("at") + 1).alias("pe"), "e")
    texts = rows.join(d.select(F.col("uid").alias("u"), "role", "text"), F.col("uid") == F.col("u"))
    texts = edits.join(texts, F.col("ce").eqNullSafe(F.col("conv")) & (F.col("pe") == F.col("pos")), "left")
    lines = texts.select(F.col("ce").alias("conv"), F.col("ke").alias("chunk"), F.col("pe").alias("pos"), F.expr(
        "concat(transform(e.before, r -> struct(r AS role, '' AS text)),"
        " CASE WHEN e.op IN ('K', 'R') THEN array(struct(coalesce(e.role, role) AS role, text)) ELSE array() END)").alias("lines"))
    lines = C.written(lines.where("size(lines) > 0"), "repair-lines")

    joined = lines.groupBy("conv", "chunk").agg(F.expr(
        "array_join(transform(flatten(transform(array_sort(collect_list(struct(pos, lines))), x -> x.lines)), l -> concat(l.role, ':', l.text)), '\\n')").alias("text"))
    joined = joined.select(F.col("conv").cast("string"), "chunk", "text")
    sha = (joined.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(_digest, "conv string, sha string")
           .select(F.col("conv").alias("ch"), "sha"))

    out = (solved.join(gaps, F.col("conv").eqNullSafe(F.col("cg"))).join(sha, F.col("conv").cast("string").eqNullSafe(F.col("ch")), "left")
           .select("conv", "gaps", "s.blank", "s.duplicate", "s.truncated", "s.illegal", "s.cost", "s.audit",
                   F.coalesce("sha", F.lit(EMPTY)).alias("repaired_sha256")))
    fixed = lines.select("conv", "pos", F.posexplode("lines").alias("at", "l")).select("conv", "pos", "at", "l.role", "l.text")
    return out, fixed


def all_of(ids: DataFrame, repaired: DataFrame) -> DataFrame:
    """``repaired``, whose first column is that of ``ids``, plus the conversations of ``ids`` that it lacks: zeros, an empty audit and
    the hash of nothing."""
    conv, *rest = repaired.columns
    r = repaired.withColumnRenamed(conv, "__conv")
    empty = [F.lit({"audit": "", "repaired_sha256": EMPTY}.get(c, 0)) for c in rest]
    d = ids.distinct().join(r, F.col(conv).eqNullSafe(F.col("__conv")), "left")
    return d.select(conv, *[F.coalesce(c, e.cast(t)).alias(c) for c, e, (_, t) in zip(rest, empty, repaired.dtypes[1:])])


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` of conversations, damaged by the checksum of conversation and turn modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user.  Nulls count as one space."""
    k = "crc32(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))) % 20"
    d = turns.select("conv_id", "turn", F.expr("coalesce(role, ' ')").alias("role"), F.expr("coalesce(text, ' ')").alias("text"), F.expr(k).alias("k"))
    return d.where("k != 0").select(
        "conv_id", "turn", F.expr("if(k = 4, 'user', role)").alias("role"),
        F.expr("CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END").alias("text"),
        F.explode(F.expr("if(k = 3, array(0, 1), array(0))")).alias("copy")).drop("copy")
