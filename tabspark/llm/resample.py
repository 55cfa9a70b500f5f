"""Target-distribution importance resampling on hashed word n-grams.

Two passes over the texts.  The first counts n-grams by bucket (tasks add up what they have read, then
one grouped sum); the difference to the target's counts gives each bucket a gain.  The second averages
the gains of a text's n-grams.  In both, the n-grams of a batch are interned in an open-addressed table
(``interning``), whose slots hold bucket and count; occurrences gather gains through their slots.
Rows with the highest weight plus Gumbel noise are drawn, which samples without replacement in
proportion to exp(weight / 1000).

No row is ranked that is not drawn: integer scores are counted, the count gives the least score that is
drawn, and the rows from there on are numbered by an ordered scan over range partitions.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators.scan import Spec, ordered_scan

from . import common as C
from .interning import Grams, Table

CHUNK = 1 << 22  # bytes of texts that are interned together; a longer text goes alone
MAX_BUCKETS = 1 << 20  # the gains go to every task


def chunks(texts: pa.Array):
    """(data, offsets) of runs of texts, as bytes, of about ``CHUNK`` bytes each."""
    texts = texts.fill_null(b"")
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        yield data[bounds[at]: bounds[to]], bounds[at: to + 1] - bounds[at]
        at = to


def _counter(n: int, buckets: int):
    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for data, offsets in chunks(batch.column(0)):
                t = Table(Grams(data, offsets, n), buckets)
                np.add.at(total, t.bucket[t.used], t.count[t.used])
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["bucket", "n"])
    return count


def bucket_counts(docs: DataFrame, text_col: str = "text", n: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall into each bucket that has any."""
    raw = docs.select(F.col(text_col).cast("binary"))
    return raw.mapInArrow(_counter(n, buckets), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of every bucket, from the (bucket, n) of the source and of the target."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    s, t = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for counts, into in ((source, s), (target, t)):
        for r in counts.collect():  # a row a bucket at most
            into[r.bucket] = r.n
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (all_s + buckets) / ((float(a) + 1) * (all_t + buckets))))
                     for a, b in zip(s.tolist(), t.tolist())], dtype=np.int64)


def _weigher(gain: np.ndarray, n: int):
    @F.arrow_udf("n_features bigint, n_words bigint, weight bigint")
    def weigh(texts: pa.Array) -> pa.Array:
        parts = []
        for data, offsets in chunks(texts):
            g = Grams(data, offsets, n)
            t = Table(g, len(gain))
            total, features = np.zeros(g.n_texts, dtype=np.int64), np.bincount(g.doc, minlength=g.n_texts)
            np.add.at(total, g.doc, gain[t.bucket][t.slot])
            parts.append((features, g.n_words, total // np.maximum(features, 1)))
        cols = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * 3
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["n_features", "n_words", "weight"])
    return weigh


NOISE = ("floor(-1000D * ln(-ln((CAST(conv(substr(sha2(concat('{seed}:', coalesce(CAST(row.`{id}` AS STRING), '')), 256), 1, 8), 16, 10) AS BIGINT)"
         " + 0.5D) / 4294967296D)))")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             n: int = 1, buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: int = 2024,
             columns: list[str] | None = None) -> DataFrame:
    """``row`` (the row of ``docs`` as a struct, so no name can clash; of ``columns``, the id among them, if they are given), ``n_features``, ``weight``,
    ``score`` and ``rank`` of every row; the rows with a rank are the resample.

    Features are all runs of 1 to ``n`` consecutive words, with repeats.  Of the rows with at least
    ``min_words`` words, ``percent`` in a hundred (rounded down) are drawn by highest score; ties go to
    the smaller id (null first), then to fewer features, and last to any.  A null or empty text has no
    features, weight 0 and no rank, unless ``min_words`` is 0.  A null id has the noise of an empty one;
    repeated ids have the same noise, and repeated rows are drawn each for itself.  An empty target
    gives gains from the source alone; empty ``docs`` give an empty result.
    """
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets), buckets)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    d = d.withColumn("w", _weigher(gain, n)("text"))
    noise = F.expr(NOISE.format(seed=int(seed), id=id_col))
    d = d.select("row", "w.n_features", "w.weight", (F.col("w.weight") + noise).alias("score"), (F.col("w.n_words") >= min_words).alias("may"))
    d = C.written(d, "resample-scored")

    # integer scores are few: the noise spans 26 000 values and gains are logarithms of counts
    counts = d.where("may").groupBy("score").count().collect()
    quota = sum(r["count"] for r in counts) * percent // 100
    least, above = None, 0
    for r in sorted(counts, key=lambda r: -r.score):
        if above >= quota:
            break
        least, above = r.score, above + r["count"]
    if least is None:
        return d.select("row", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    drawn = (d.where(F.col("may") & (F.col("score") >= least))
             .select("row", "n_features", "weight", "score", (-F.col("score")).alias("o0"), F.col(f"row.`{id_col}`").alias("o1"),
                     F.monotonically_increasing_id().alias("o2")))  # the table is written: every attempt numbers its rows alike
    drawn = ordered_scan(drawn, [], ["o0", "o1", "n_features", "o2"], [Spec("rank", "row_number")])
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    rest = d.where(~F.col("may") | (F.col("score") < least)).withColumn("rank", F.lit(None).cast("bigint"))
    cols = ["row", "n_features", "weight", "score", "rank"]
    return drawn.select(*cols).unionByName(rest.select(*cols))
