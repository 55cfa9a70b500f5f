"""Exact substring dedup: bytes covered by a ``span``-byte string that starts anywhere else are removed.

A depth-limited radix sort in digit passes, deepest last, each over what the pass before left undecided:

1. A window (``span`` bytes from some place) is dealt by its smallest ``GRAM``-byte hash.  Equal windows
   have equal minima, and neighbours mostly share theirs, so a run of windows is one row.
2. Runs of one minimum are compared by the hash of all bytes that their windows span.  If all are equal,
   or one has an equal, all its windows repeat, without looking at any of them.
3. Runs whose minimum repeats in other surroundings are cut, by the distance from the minimum's place, into
   blocks of ``BLOCK`` windows.  Blocks are dealt by the hash of the bytes that all their windows share, so those with
   an unmatched core drop out, and are compared by the bytes that they span, as in pass 2.
4. What is left are blocks close to where two texts part: one hash per window, and equal windows
   are the groups of the last pass.  (So are whole runs whose windows may repeat within themselves.)

Groups are never gathered: each pass is an aggregate (pre-aggregated before its shuffle) and a join.
Comparisons are by 64-bit hashes of whole strings.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .hashing import Sums, mix

SPAN = 200
GRAM = 32
BLOCK = 32  # windows of a block
WHOLE = 7  # block number that stands for all windows of a run
assert (SPAN - GRAM) // BLOCK < WHOLE

def slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """The best of every ``width`` neighbours, by doubling."""
    w = 1
    while 2 * w <= width:
        x = best(x[:-w], x[w:])
        w *= 2
    return best(x[: len(x) - (width - w)], x[width - w:]) if w < width else x


class Windows(Sums):
    """The windows of one text: ``lo``..``hi`` are the first and last windows of its runs."""

    def __init__(self, text: bytes, span: int = SPAN, gram: int = GRAM):
        super().__init__(text)
        n, self.span = len(text), span
        h = self.hashes(np.arange(n - gram + 1), gram)
        width = span - gram + 1
        low = slide(h, width, np.minimum)  # one value per window
        cut = np.flatnonzero(low[1:] != low[:-1]) + 1
        self.lo = np.concatenate([[0], cut])
        self.hi = np.concatenate([cut, [len(low)]]) - 1
        self.group = low[self.lo]
        pad = np.zeros(width - 1, dtype=np.uint64)
        top = slide(np.concatenate([pad, low, pad]), width, np.maximum)
        at = np.flatnonzero(h == top)  # places that are the minimum of some window
        # of one window, or of neighbours (width apart), whose windows are one run
        twin = np.flatnonzero((h[at[1:]] == h[at[:-1]]) & (at[1:] - at[:-1] <= width))
        first = np.searchsorted(self.lo, np.maximum(at[twin + 1] - width + 1, 0), "right") - 1
        last = np.searchsorted(self.lo, np.minimum(at[twin], len(low) - 1), "right") - 1
        mark = np.zeros(len(self.lo) + 1, dtype=np.int64)
        np.add.at(mark, first, 1)
        np.add.at(mark, last + 1, -1)
        self.tied = np.cumsum(mark[:-1]) > 0  # a window of the run may equal another one of it
        k = np.searchsorted(at, self.hi)
        while (off := h[at[k]] != self.group).any():
            k[off] += 1
        self.place = at[k]  # of the run's minimum

    def runs(self) -> np.ndarray:
        """The hash of all bytes that the windows of a run span."""
        size = self.hi - self.lo + self.span
        return mix(self.hashes(self.lo, size) + size.astype(np.uint64))

    def windows(self, run: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of the given blocks of runs."""
        whole = block == WHOLE
        first = np.where(whole, self.lo[run], np.maximum(self.lo[run], self.place[run] - BLOCK * block - BLOCK + 1))
        return first, np.where(whole, self.hi[run], np.minimum(self.hi[run], self.place[run] - BLOCK * block))

    def blocks(self, run: np.ndarray, full: np.ndarray):
        """(run, block, core hash, span hash) of the blocks of the given runs; full ones are not cut."""
        n = len(self.sums) - 1
        near, far = (self.place[run] - self.hi[run]) // BLOCK, (self.place[run] - self.lo[run]) // BLOCK
        assert (full | (far < WHOLE)).all()  # all windows of a run that is not tied hold its minimum
        near, far = np.where(full, WHOLE, near), np.where(full, WHOLE, far)
        count = far - near + 1
        r = np.repeat(run, count)
        b = np.repeat(near - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        whole = b == WHOLE
        high = np.where(whole, self.place[r], self.place[r] - BLOCK * b)  # start of the nearest window, if there
        core = np.where(whole, GRAM, self.span - BLOCK + 1)
        left = np.maximum(np.where(whole, self.lo[r], high - BLOCK + 1), 0)
        right = np.minimum(np.where(whole, self.hi[r], high) + self.span, n)
        core_hash = mix(self.hashes(high, core) ^ self.group[r] + b.astype(np.uint64))
        size = right - left
        span_hash = mix(self.hashes(left, size) + size.astype(np.uint64) + (high - left).astype(np.uint64) * np.uint64(1 << 32))
        return r, b, core_hash, span_hash

    def spelled(self, run: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every window of the given blocks."""
        first, last = self.windows(run, block)
        size = np.maximum(last - first + 1, 0)
        start = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        return start, self.hashes(start, self.span)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# tr packs a text's hash (31 bits), run number (28 bits), block number (3 bits) and whether it is tied.
_ROWS = "g bigint, u bigint, id bigint, tr bigint"


def _unpack(codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run, block and tie of the lower half of tr."""
    c = np.sort(np.array(codes or [], dtype=np.int64))
    return c >> 4, (c >> 1) & 7, (c & 1).astype(bool)


def _rows(i, th, run, block, tied, g, u):
    tr = (np.int64(th) << 32) | (run.astype(np.int64) << 4) | (np.int64(1) * block << 1) | tied
    n = len(run)
    return pa.RecordBatch.from_arrays([_signed(g), _signed(u), pa.array(np.full(n, i, dtype=np.int64)), pa.array(tr)], ["g", "u", "id", "tr"])


def _emit_runs(batches):
    """(g, u, id, tr): minimum and span hash of each run."""
    for batch in batches:
        for i, th, text in zip(*(batch.column(k) for k in range(3))):
            w = Windows(text.as_py())
            run = np.arange(len(w.lo))
            yield _rows(i.as_py(), th.as_py(), run, np.full(len(run), WHOLE), w.tied, w.group, w.runs())


def _emit_blocks(batches):
    """(g, u, id, tr): core and span hash of the blocks of undecided runs."""
    for batch in batches:
        for i, th, text, undecided in zip(*(batch.column(k) for k in range(4))):
            w = Windows(text.as_py())
            run, _, full = _unpack(undecided.as_py())
            r, b, g, u = w.blocks(run, full)
            yield _rows(i.as_py(), th.as_py(), r, b, b == WHOLE, g, u)


def _emit_windows(batches):
    """(w, id, th, n): the windows of undecided blocks, once per text, with their count."""
    for batch in batches:
        for i, th, text, undecided in zip(*(batch.column(k) for k in range(4))):
            _, h = Windows(text.as_py()).spelled(*_unpack(undecided.as_py())[:2])
            h, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [_signed(h), pa.array(np.full(len(h), i.as_py(), dtype=np.int64)),
                 pa.array(np.full(len(h), th.as_py(), dtype=np.int64)), pa.array(n.astype(np.int64))], ["w", "id", "th", "n"])


def removed(text: bytes, whole, spelled, repeated) -> np.ndarray:
    """True for each byte that a repeated window covers."""
    w = Windows(text)
    mark = np.zeros(len(text) + 1, dtype=np.int64)
    first, last = w.windows(*_unpack(whole)[:2])
    there = last >= first
    np.add.at(mark, first[there], 1)
    np.add.at(mark, last[there] + SPAN, -1)
    if spelled and repeated:
        start, h = w.spelled(*_unpack(spelled)[:2])
        start = start[np.isin(h.view(np.int64), np.array(repeated, dtype=np.int64))]
        np.add.at(mark, start, 1)
        np.add.at(mark, start + SPAN, -1)
    return np.cumsum(mark[:-1]) > 0


def _emit_kept(batches):
    for batch in batches:
        rows = []
        for orig, text, whole, spelled, repeated in zip(*(batch.column(k) for k in range(5))):
            text = text.as_py()
            gone = removed(text, whole.as_py(), spelled.as_py(), repeated.as_py())
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
            rows.append((orig.as_py(), len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (batch.schema.types[0], pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
            ["orig", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _decide(rows: DataFrame, name: str) -> DataFrame:
    """(id, th, whole, open) by text: which rows (g, u, id, tr) repeat as a whole, and which need a look at the
    next digit.  A group g of one string u is decided by its count; in a group of several, a u with an
    equal repeats and sends one stand-in on, and others go on themselves.  A group with a tied row goes on."""
    rows = C.written(rows, f"{name}-rows")  # read twice; made in one pass over the texts
    first = (rows.groupBy("g").agg(F.count("*").alias("n"), F.min("u").alias("a"), F.max("u").alias("b"), F.max(F.expr("tr & 1")).alias("tie"))
             .where("n > 1 OR tie = 1").select("g", "n", F.expr("a != b").alias("several"), "tie"))
    first = C.written(first, f"{name}-groups")  # so that the join's sides are plain shuffles, which Spark splits where a group is hot
    cand = C.written(rows.join(first, "g"), name)
    twice = (cand.where("several").groupBy("g", "u").agg(F.count("*").alias("c"), F.min(F.struct("id", "tr")).alias("rep"))
             .where("c > 1").select("g", "u", "rep"))
    twice = C.written(twice, f"{name}-twice")
    plain = cand.where("NOT several").select("id", "tr", "tie", F.expr("n > 1").alias("whole"), F.expr("tie = 1").alias("open"))
    mixed = (cand.where("several").join(twice, ["g", "u"], "left")
             .select("id", "tr", "tie", F.expr("rep IS NOT NULL").alias("whole"),
                     F.expr("tie = 1 OR rep IS NULL OR rep = struct(id, tr)").alias("open")))
    code = F.expr("tr & 4294967294 | tie")
    return (plain.unionByName(mixed).select("id", F.expr("tr >> 32").alias("th"), code.alias("code"), "whole", "open")
            .groupBy("id", "th").agg(F.expr("collect_set(code) FILTER (WHERE whole)").alias("whole"),
                                     F.expr("collect_set(code) FILTER (WHERE open)").alias("open")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``
    and, with ``keep_bytes``, ``kept`` (the bytes that are left).

    ``id_col`` is an integer.  A null text counts as empty; texts of fewer than ``SPAN`` bytes lose
    nothing.  Repeated rows (one id, one text) count as separate texts and so remove each other if
    they are long enough; a null id is as good as any.  Empty tables give empty results.  Other columns
    are not read.
    """
    d = docs.select(F.col(id_col).cast("bigint").alias("orig"), F.expr(f"cast(coalesce({text_col}, '') as binary)").alias("text"))
    d = d.withColumn("th", F.expr("xxhash64(text) & 2147483647")).withColumn("id", F.expr("coalesce(orig, xxhash64(text))"))
    long = d.where(f"octet_length(text) >= {SPAN}").select("id", "th", "text")
    key = ["id", "th"]

    def undecided(state):
        rest = state.where("size(open) > 0").select(*key, "open")
        return long.join(C.small_side(rest.select(*key), 500_000), key, "left_semi").join(rest, key).select(*key, "text", "open")

    runs = C.written(_decide(long.mapInArrow(_emit_runs, _ROWS), "dedup-runs"), "dedup-run-state")
    blocks = C.written(_decide(undecided(runs).mapInArrow(_emit_blocks, _ROWS), "dedup-blocks"), "dedup-block-state")
    wins = C.written(undecided(blocks).mapInArrow(_emit_windows, "w bigint, id bigint, th bigint, n bigint"), "dedup-windows")
    again = wins.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
    lists = wins.join(again, "w").groupBy(*key).agg(F.collect_set("w").alias("repeated"))

    # the texts that lose something
    state = (runs.select(*key, "whole").join(blocks.select(*key, F.col("whole").alias("more"), "open"), key, "left").join(lists, key, "left")
             .select(*key, F.expr("array_union(whole, coalesce(more, array()))").alias("whole"), "open", "repeated")
             .where("size(whole) > 0 OR size(repeated) > 0"))
    state = C.written(state, "dedup-state")
    touched = C.small_side(state.select(*key), 500_000)
    done = (d.join(touched, key, "left_semi").join(state, key).select("orig", "text", "whole", "open", "repeated")
            .mapInArrow(_emit_kept, "orig bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"))
    rest = d.join(touched, key, "left_anti").select(
        "orig", F.expr("cast(octet_length(text) as bigint)").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"))
    out = done.unionByName(rest).withColumnRenamed("orig", id_col)
    return out if keep_bytes else out.drop("kept")
