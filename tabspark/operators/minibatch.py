"""Mini-batches of a whole table (T5), and sums of model-sized vectors.

Every epoch has its own order of all rows: a bijection of the rows' dense
numbers 0..n-1, computed per row, so no row is moved to find its place. It is an
unbalanced Feistel network on pairs of numbers below a and b with a * b just above
n; numbers that fall outside 0..n-1 go through it again. Batch i holds the
places i * size .. (i + 1) * size - 1.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.scan import Spec, ordered_scan
from tabspark.session import local_frame

ROUNDS = 4
PRIME = 2_147_483_647  # a round squares below this, so products stay below 2 ** 63
WALK = 64              # passes for a number outside the table: at most a, if a is no larger; else odds of a ** -16
MIXER = 48_271


def round_keys(seed: int, epoch: int) -> list[int]:
    return [int(hashlib.sha256(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:8], 16) % PRIME for i in range(ROUNDS)]


def sides(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def walks(n: int) -> int:
    return WALK if sides(n)[0] <= WALK else 16


def place_sql(x: str, n: int, keys: str) -> str:
    """SQL: the place of row number ``x`` of ``n`` under an array of round keys."""
    a, b = sides(n)

    def mix(v, k):
        t = f"(({v} + {k}) % {PRIME})"
        return f"(({t} * {t} % {PRIME} * {MIXER} + {k}) % {PRIME})"

    def folded(values, start, body, args):
        return f"aggregate({values}, CAST({start} AS BIGINT), ({args}) -> {body})"
    left = f"((p div {b} + {mix(f'(p % {b})', 'k')}) % {a})"
    body = f"({left} * {b} + (p % {b} + {mix(left, 'k')}) % {b})"
    once = lambda v: folded(keys, v, body, "p, k")
    return folded(f"sequence(1, {walks(n)})", once(x), f"CASE WHEN y < {n} THEN y ELSE {once('y')} END", "y, i")


def places(n: int, keys: list[int]) -> np.ndarray:
    """NumPy form of ``place_sql`` for the rows 0..n-1."""
    a, b = sides(n)

    def once(p):
        for k in keys:
            left, right = p // b, p % b
            t = (right + k) % PRIME
            left = (left + (t * t % PRIME * MIXER + k) % PRIME) % a
            t = (left + k) % PRIME
            p = left * b + (right + (t * t % PRIME * MIXER + k) % PRIME) % b
        return p
    x = once(np.arange(n, dtype=np.int64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x


def batch_count(n: int, size: int, drop_last: bool) -> int:
    """Batches of n rows. Without ``drop_last`` a last row of its own joins the batch before it (batch statistics
    need two); with it, a table smaller than one batch is one batch."""
    if n <= size:
        return int(n > 0)
    whole, rest = divmod(n, size)
    return whole + int(not drop_last and rest > 1)


def batch_sql(place: str, n: int, size: int, drop_last: bool) -> str:
    """SQL: the batch of a place, null if it is dropped."""
    last = batch_count(n, size, drop_last) - 1
    if drop_last and n > size:
        return f"CASE WHEN {place} div {size} <= {last} THEN {place} div {size} END"
    return f"least({place} div {size}, {last})"


def minibatch_plan(df: DataFrame, id_col: str, epochs: int, batch_size: int = 32, seed: int = 42, drop_last: bool = True) -> DataFrame:
    """(epoch, batch, place, id): a seeded global shuffle of the rows for each epoch, cut into batches.

    Rows are numbered by ``id_col``, which is unique. With ``drop_last`` fewer than ``batch_size`` rows of the
    whole table are left out of an epoch; a table smaller than one batch is one batch."""
    d = ordered_scan(df.select(F.col(id_col).alias("id")), [], ["id"], [Spec("__n", "row_number")])
    n = d.count()
    per = F.expr("explode(array(" + ", ".join(
        f"struct({e} AS epoch, array({', '.join(f'{k}L' for k in round_keys(seed, e))}) AS ks)" for e in range(epochs)) + "))")
    d = d.select("id", (F.col("__n") - 1).alias("__n"), per.alias("e"))
    d = placed(d, place_sql("__n", n, "e.ks"), "place").select("id", "e.epoch", "place")
    return d.select("epoch", F.expr(batch_sql("place", n, batch_size, drop_last)).alias("batch"), "place", "id").where("batch IS NOT NULL")


def numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """``df``, a checkpointed table, with dense row numbers ``__n``, and the number of its rows; any order."""
    d = df.withColumn("__m", F.monotonically_increasing_id())
    part = F.expr("shiftright(__m, 33)").cast("int")
    counts = {r[0]: r[1] for r in d.groupBy(part.alias("p")).count().collect()}  # a row a partition
    offsets, n = [], 0
    for p, c in sorted(counts.items()):
        offsets.append((p, n))
        n += c
    of = local_frame(df.sparkSession, offsets, "__o int, __from bigint")  # a row a partition
    d = d.join(F.broadcast(of), part == F.col("__o")).withColumn("__n", F.expr("__from + (__m & 8589934591)"))
    return d.drop("__m", "__o", "__from").checkpoint(eager=True), n


def placed(df: DataFrame, sql: str, name: str) -> DataFrame:
    """``df`` with the place ``sql`` as ``name``, computed once a row: as the output of a generator it is not copied into
    the conditions and columns made of it, as a projected expression is."""
    return df.select("*", F.expr(f"explode(array({sql})) AS {name}"))


def in_batches(df: DataFrame, n: int, size: int, seed: int, epoch: int, drop_last: bool, parts: int) -> DataFrame:
    """The ``n`` rows of ``df`` (numbered ``__n``) in the batches ``__b`` of an epoch: batch i in partition i % ``parts``, by
    place. A batch is never split, and a task streams its batches one by one."""
    d = placed(df, place_sql("__n", n, f"array({', '.join(f'{k}L' for k in round_keys(seed, epoch))})"), "__p")
    d = d.withColumn("__b", F.expr(batch_sql("__p", n, size, drop_last))).where("__b IS NOT NULL")
    return d.repartitionById(parts, F.expr(f"CAST(__b % {parts} AS INT)")).sortWithinPartitions("__p").drop("__n", "__p")


# ------------------------------------------------------------------ sums of vectors
VECTORS = "run int, part int, vec array<double>"


def _adder(same: str):
    """mapInArrow function: one row for each stretch of rows of one run and ``same`` value (run, part, vec)."""
    def run(batches):
        import pyarrow as pa
        key, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                               pa.array([total], pa.list_(pa.float64()))], names=["run", "part", "vec"])
        for b in batches:
            at = b.schema.get_field_index(same) if same else None
            for i in range(b.num_rows):
                k = (b.column(0)[i].as_py(), b.column(at)[i].as_py() if same else 0)
                vec = b.column(2)[i].values.to_numpy(zero_copy_only=False)
                if k != key:
                    if key is not None:
                        yield out()
                    key, total = k, np.array(vec)
                else:
                    total += vec
        if key is not None:
            yield out()
    return run


def vector_sums(parts: DataFrame, n_parts: int) -> dict[int, np.ndarray]:
    """The sum of the vectors of each run, by a tree of two levels: square root of ``n_parts`` tasks add up as many
    vectors each, and one task their sums. Added in order of part, so a repeated task gives the same bits."""
    s = math.isqrt(max(n_parts - 1, 0)) + 1
    if s > 2:
        d = parts.withColumn("s", F.col("part") % s)
        parts = d.repartitionById(s, F.col("s")).sortWithinPartitions("run", "s", "part").mapInArrow(_adder("s"), VECTORS)
    one = parts.coalesce(1) if n_parts == 1 else parts.repartition(1)
    rows = one.sortWithinPartitions("run", "part").mapInArrow(_adder(""), VECTORS).collect()  # a model a run
    return {r["run"]: np.array(r["vec"]) for r in rows}
