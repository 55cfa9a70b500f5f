"""Mixing sources to target weights by Pfair scheduling.

A source's rows are put in a repeatable random order and cut into blocks.  A source with the share
w of a period of P slots has its j-th block released at slot floor(j * P / w) and due by slot
ceil((j + 1) * P / w).  Earliest-deadline-first over the released blocks meets every deadline (unit
blocks, whole-number windows, shares that sum to P), so after any number of slots every source is less
than one block from its target, as long as it has rows.  The schedule repeats after P slots; one period is
worked out once and each block finds its slot by a join on (source, block number in the period).

Native: DataFrame and SQL functions only.  A source is never gathered in one task: rows are ranked
within (source, hash range) and the ranges are joined to running counts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C


def shares(counts: DataFrame, weights: dict | None = None, alpha: float = 0.5, period: int = 1000) -> DataFrame:
    """(src, n, share, period) from (src, n).  Without ``weights`` the target of a source is n ** alpha.
    A share is the rounded target of ``period`` slots, 1 at least; the period is the sum of the shares."""
    if weights:
        pairs = ", ".join("'{}', {!r}D".format(str(k).replace("\\", "\\\\").replace("'", "\\'"), float(v))
                          for k, v in weights.items())
        w = f"coalesce(try_element_at(map({pairs}), src), 0D)"
    else:
        w = f"pow(n, {float(alpha)}D)"
    everything = Window.partitionBy()
    d = counts.withColumn("w", F.expr(w))
    d = d.withColumn("share", F.greatest(F.lit(1), F.round(
        F.col("w") * F.greatest(F.lit(period), 4 * F.count("*").over(everything)) / F.nullif(F.sum("w").over(everything), F.lit(0.0)))))
    d = d.withColumn("share", F.expr("cast(coalesce(share, 1) as bigint)"))
    return d.select("src", "n", "share", F.sum("share").over(everything).alias("period"))


def slots(share: DataFrame) -> DataFrame:
    """(src, j, slot): the slot of every block of one period, earliest deadline first.  The fold's state
    is the next block of each source; its size is bounded by the number of sources, the result by the period."""
    one = share.groupBy().agg(F.sort_array(F.collect_list(F.struct("src", "share"))).alias("s"), F.max("period").alias("p"))
    due = "(((x.j + 1) * p + x.share - 1) div x.share)"
    pick = ("array_min(filter(transform(acc.next, (x, i) -> CASE WHEN x.j < x.share AND (x.j * p) div x.share <= t "
            f"THEN struct({due} as due, i as i) END), x -> x IS NOT NULL)).i")
    step = (f"element_at(transform(array({pick}), k -> struct("
            "transform(acc.next, (x, i) -> CASE WHEN i = k THEN struct(x.src as src, x.share as share, x.j + 1 as j) ELSE x END) as next, "
            "concat(acc.out, array(struct(acc.next[k].src as src, acc.next[k].j as j, t as slot))) as out)), 1)")
    run = ("aggregate(sequence(0L, p - 1), struct(transform(s, x -> struct(x.src as src, x.share as share, 0L as j)) as next, "
           f"cast(array() as array<struct<src:string,j:bigint,slot:bigint>>) as out), (acc, t) -> {step}, acc -> acc.out)")
    return one.where("size(s) > 0").select(F.expr(f"inline({run})"))


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source",
        alpha: float = 0.5, period: int = 1000, block_rows: int = 16, range_rows: int = 1000, seed: int = 7) -> DataFrame:
    """``docs`` plus ``block`` (number in its source), ``slot``, ``in_block``, ``release``, ``due``
    (slots).  Ordered by (slot, in_block) the rows are the mix.

    Every row is returned once; a source that has run out leaves its later slots empty, which nobody
    fills.  A null source counts as the source ''.  Rows of one id (null too) get one place in the random
    order and split a tie by all other columns' hash; equal rows are interchangeable.  An empty table
    gives an empty result.  Columns of ``docs`` with the names of added ones are replaced.
    """
    add = ("block", "slot", "in_block", "release", "due")
    rest = [F.col(f"`{c}`") for c, kind in docs.dtypes if c not in add and c != id_col and not kind.startswith("map")]
    tie = F.xxhash64(*rest) if rest else F.lit(0)
    # the row goes along whole, so that no inner name can meet one of its columns
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"), tie.alias("_tie"),
                    F.expr(f"coalesce(cast(`{source_col}` as string), '')").alias("_src"))
    d = d.withColumn("_h", F.expr(f"md5(concat('{seed}:', coalesce(cast(_id as string), '')))"))
    counts = C.written(d.groupBy(F.col("_src").alias("src")).agg(F.count("*").alias("n")), "mix-counts")
    share = C.written(shares(counts, weights, alpha, period), "mix-shares")  # one row a source
    plan = C.written(slots(share), "mix-slots")  # one row a slot of the period
    total = counts.agg(F.sum("n")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(1, total / range_rows), 16)))
    d = d.withColumn("_r", F.expr(f"substring(_h, 1, {digits})"))
    sizes = d.groupBy("_src", "_r").agg(F.count("*").alias("_n"))
    before = sizes.select("_src", "_r", (F.sum("_n").over(Window.partitionBy("_src").orderBy("_r")) - F.col("_n")).alias("_before"))
    d = d.join(before, ["_src", "_r"]).withColumn(
        "_k", F.col("_before") + F.row_number().over(Window.partitionBy("_src", "_r").orderBy("_h", "_id", "_tie")) - 1)
    d = d.withColumn("block", F.expr(f"_k div {block_rows}")).withColumn("in_block", F.expr(f"_k % {block_rows}"))
    d = d.join(C.small_side(share.select(F.col("src").alias("_src"), F.col("share").alias("_share"), F.col("period").alias("_p"))), "_src")
    d = d.withColumn("_j", F.expr("block % _share"))
    d = d.join(C.small_side(plan.select(F.col("src").alias("_src"), F.col("j").alias("_j"), F.col("slot").alias("_slot"))), ["_src", "_j"])
    d = d.withColumns({"slot": F.expr("block div _share * _p + _slot"), "release": F.expr("block * _p div _share"),
                       "due": F.expr("((block + 1) * _p + _share - 1) div _share")})
    return d.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in add], *add)
