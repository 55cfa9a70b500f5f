"""Joining a row per key to a table in which a key may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of at most this many (counted) rows is broadcast.
MAX_BROADCAST_ROWS = 200_000
#: A key with more than one part in ``PARTS`` of a partition's even share is dealt out in as many parts as it needs.
PARTS = 8


def attach(df: DataFrame, table: DataFrame, keys: list[str], rows_col: str, salt_by: list[str],
           max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` inner-joined with ``table``, which has one row per value of ``keys`` (null is a value like any other)
    and in ``rows_col`` about how many rows of ``df`` have it; the columns of ``df``, then the others of ``table``.

    A small table is broadcast, and no row of ``df`` moves. Else rows and table are shuffled by (keys, part): a key is cut into parts
    of equal size by a hash of ``salt_by``, its row of ``table`` goes to each of them, and only the keys that are cut (fewer than
    ``PARTS`` a partition, whatever the data) are broadcast, with their number of parts. ``table`` is read three times:
    pass a checkpointed one."""
    spark = df.sparkSession
    n, total = table.agg(F.count(F.lit(1)), F.sum(rows_col)).first()
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    t = table.select(*[F.col(k).alias(v) for k, v in names.items()], *[c for c in table.columns if c not in keys])
    extra = [c for c in table.columns if c not in keys and c != rows_col]
    same = [df[k].eqNullSafe(t[v]) for k, v in names.items()]
    if n <= max_broadcast_rows:
        return df.join(F.broadcast(t), same).select(*[df[c] for c in df.columns], *extra)
    size = max(1, int(total or 0) // (PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    t = t.withColumn("__of", F.expr(f"CAST(ceil({rows_col} / {size}) AS INT)"))
    hot = t.where("__of > 1").select(*names.values(), "__of")
    d = df.join(F.broadcast(hot), [df[k].eqNullSafe(hot[v]) for k, v in names.items()], "left")
    d = d.select(*[df[c] for c in df.columns], F.expr(f"pmod(xxhash64({', '.join(salt_by)}), coalesce(__of, 1))").cast("int").alias("__part"))
    t = t.withColumn("__p", F.explode(F.expr("sequence(0, greatest(__of, 1) - 1)")))
    j = d.join(t, [d[k].eqNullSafe(t[v]) for k, v in names.items()] + [F.col("__part") == F.col("__p")])
    return j.select(*[d[c] for c in df.columns], *extra)
