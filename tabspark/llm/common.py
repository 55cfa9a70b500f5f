"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.session import scratch_path, table_path

# Separators of the word rule (every character that is not 0-9, a-z or beyond ASCII),
# and the white space of the plain-token rule.
NON_WORD = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
NON_WORD_ANY_CASE = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A side is broadcast only when it was counted and has at most this many rows.
MAX_BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lower_az(text: str) -> str:
    """SQL: ``text`` with A-Z (and nothing else) in lower case.  ``lower`` does just that on ASCII."""
    return (f"CASE WHEN octet_length({text}) = char_length({text}) THEN lower({text}) "
            f"ELSE translate({text}, '{UPPER}', '{LOWER}') END")


def words(text: str) -> str:
    """SQL: the lower-cased words of ``text`` in order (null: none)."""
    return f"array_remove(split({lower_az(f'coalesce({text}, {chr(39)*2})')}, '{NON_WORD}'), '')"


def n_words(text: str) -> str:
    """SQL: how many words ``text`` has; case does not matter for that."""
    return f"CAST(size(array_remove(split(coalesce({text}, ''), '{NON_WORD_ANY_CASE}'), '')) AS BIGINT)"


def let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, which is evaluated once a row also where the
    optimizer copies the whole expression (as it does when it moves a filter through a projection)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for inner columns that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while f"_{name}" in taken:
            name = f"_{name}"
        taken.add(f"_{name}")
        out.append(f"_{name}")
    return out


PREFIX_BLOCK = 32
PREFIX_LEVELS = 4


def prefix(values: str, op: str, zero: str, kind: str = "int", level: int = PREFIX_LEVELS) -> str:
    """SQL: for each element of an array ``op(a, b)`` over all that come before it, from ``zero``.

    A fold that appends to an array copies it at every step, so it runs over blocks of ``PREFIX_BLOCK`` only: the results
    of the blocks are taken as an array again, whose prefixes start the blocks.  Work is in proportion to the array up to
    ``PREFIX_BLOCK ** (level + 1)`` elements, and goes on beyond."""
    fold = (f"aggregate({{0}}, struct({{1}} AS at, CAST(array() AS array<{kind}>) AS out), "
            f"(s, x) -> struct({op.format('s.at', 'x')} AS at, concat(s.out, array(s.at)) AS out), s -> s.out)")
    if not level:
        return fold.format(values, zero)
    blocks = (f"transform(array({values}), v -> transform(CASE WHEN size(v) > 0 THEN sequence(0, (size(v) - 1) div {PREFIX_BLOCK}) ELSE array() END, "
              f"b -> slice(v, b * {PREFIX_BLOCK} + 1, {PREFIX_BLOCK})))[0]")
    heads = prefix(f"transform(bs, v -> aggregate(v, {zero}, (s, x) -> {op.format('s', 'x')}))", op, zero, kind, level - 1)
    return let("bs", blocks, f"flatten(zip_with(bs, {heads}, (v, h) -> {fold.format('v', 'h')}))")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder of ``spark.checkpoint.dir``: cuts the lineage, and a
    lost executor costs no recomputation of what is behind it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows that it has at most ``limit`` rows (as many as are
    read to see that are counted, no more); else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
