"""Ordered prefix scans (row number, running sum/max, first arg-max) per group
without putting a group into one task.

A window ``partitionBy(g).orderBy(o)`` sends every row of a group to one task;
one hot group (a third of the table) would then run serially. Here the window
has two levels, both of built-in functions:

1. rows are range-partitioned on (group, order) and carry the number of their
   partition; a window over (group, partition) gives the running values inside
   it, and the result is written once with ``checkpoint()``. A hot group spans
   many consecutive partitions;
2. one aggregate row per (group, partition), and a window over those rows, give
   what the earlier partitions of a group add. Only the first group of a
   partition can have earlier ones, so at most one row a partition is left,
   which is broadcast and joined to the rows.

Order keys must be unique within a group (a total order), as for a window
with ``row_number``. Null and NaN values take part in nothing but the row
number: running sums and maxima go on over them (0.0 and null before the first
value), and they never are a new maximum.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPS = ("row_number", "cumsum", "cumsum_excl", "cummax", "cummax_excl", "argmax_first")


@dataclass
class Spec:
    out: str
    op: str
    col: str | None = None      # input value column (not for row_number)
    at: str | None = None       # for argmax_first: column reported at the first maximum
                                # (None: the row number of the first maximum)


def ordered_scan(df: DataFrame, group_cols: list[str], order_cols: list[str], specs: list[Spec],
                 num_partitions: int | None = None) -> DataFrame:
    """Adds the ``specs`` columns to ``df`` (one value column per call for the
    running sum/max/arg-max family)."""
    for s in specs:
        if s.op not in OPS:
            raise ValueError(s.op)
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    value = next((s.col for s in specs if s.col), None)
    at = next((s.at for s in specs if s.at), None)
    keys = [*group_cols, *order_cols]

    # level 1: inside (group, partition)
    inside = Window.partitionBy(*group_cols, "__pid").orderBy(*order_cols)
    upto, before = (inside.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    d = df.repartitionByRange(n_parts, *keys).withColumn("__pid", F.spark_partition_id())
    x = F.col(value).cast("double") if value else F.lit(None).cast("double")
    d = d.withColumn("__x", F.when(~F.isnan(x), x))
    d = d.select("*", F.row_number().over(inside).cast("bigint").alias("__n"), F.sum("__x").over(upto).alias("__s"),
                 F.max("__x").over(upto).alias("__m"), F.max("__x").over(before).alias("__mx"))
    record = F.col("__x").isNotNull() & (F.col("__mx").isNull() | (F.col("__x") > F.col("__mx")))
    place = F.struct((F.col(at) if at else F.col("__n")).alias("a"))
    d = d.withColumn("__a", F.last(F.when(record, place), ignorenulls=True).over(upto)["a"])
    d = d.checkpoint(eager=True)

    # level 2: what earlier partitions of the group add; at most one row per partition is left
    per = d.groupBy(*group_cols, "__pid").agg(F.max("__n").alias("n"), F.sum("__x").alias("s"), F.max("__x").alias("m"),
                                              F.max_by("__a", "__n").alias("a"))
    earlier = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__n0", F.sum("n").over(earlier))
    if not at:
        per = per.withColumn("a", F.col("a") + F.coalesce("__n0", F.lit(0)))
    first = F.when(F.col("m").isNotNull(), F.struct("m", -F.col("__pid")))  # the earliest of equal maxima
    per = per.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_cols)], F.col("__pid").alias("__p"), "__n0",
                     F.sum("s").over(earlier).alias("__s0"), F.max("m").over(earlier).alias("__m0"),
                     F.max_by("a", first).over(earlier).alias("__a0")).where("__n0 > 0")
    same = [F.col("__pid") == F.col("__p")] + [d[g].eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group_cols)]
    j = d.join(F.broadcast(per), same, "left")

    n0 = F.coalesce("__n0", F.lit(0))
    total = F.coalesce("__s", F.lit(0.0)) + F.coalesce("__s0", F.lit(0.0))
    newer = F.col("__m0").isNull() | (F.col("__m") > F.col("__m0"))
    out = {
        "row_number": F.col("__n") + n0,
        "cumsum": total,
        "cumsum_excl": total - F.coalesce("__x", F.lit(0.0)),
        "cummax": F.greatest("__m", "__m0"),
        "cummax_excl": F.greatest("__mx", "__m0"),
        "argmax_first": F.when(newer, F.col("__a") if at else F.col("__a") + n0).otherwise(F.col("__a0")),
    }
    return j.select(*[d[c] for c in df.columns], *[out[s.op].alias(s.out) for s in specs])
