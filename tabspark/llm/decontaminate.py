"""Benchmark decontamination by winnowing.

Every text gives its minimum k-gram hash in each run of ``span - k + 1`` consecutive k-grams, so two
texts with ``span`` words in common share a fingerprint.  Documents that share one with an item are
read again and the hits are extended to all exact occurrences of the item's windows.

Native: DataFrame and SQL functions only.  The k-gram hashes and sliding minima are array functions
in the scan; what is shuffled are fingerprints that also occur in the benchmark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SPAN = 13  # words of a window
GRAM = 8  # words of a k-gram; 6 k-grams in a window
assert SPAN == GRAM + 5


def fingerprints(words: str) -> str:
    """SQL: the distinct winnowing fingerprints of an array of ``SPAN`` words or more.

    The hash of 2, 4 and 8 words comes from two hashes of half as many, and the minimum of 2, 4 and 6
    neighbours from two minima, so each word costs a handful of array steps.
    """
    g = f"transform({words}, x -> xxhash64(x))"
    for step, both in ((1, "xxhash64(a, b)"), (2, "xxhash64(a, b)"), (4, "xxhash64(a, b)"),
                       (1, "least(a, b)"), (2, "least(a, b)"), (2, "least(a, b)")):
        n = f"size(g) - {step}"  # element i with element i + step, as long as both exist
        g = C.let("g", g, f"zip_with(slice(g, 1, {n}), slice(g, {1 + step}, {n}), (a, b) -> {both})")
    return f"array_distinct({g})"


def windows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, m, window): the windows of each item as text; one of m < SPAN words if it has only those."""
    w = items.select(F.expr(f"coalesce(cast({item_col} as string), '')").alias("item"),
                     F.expr(C.words(text_col)).alias("words")).where("size(words) > 0")
    w = w.withColumn("m", F.expr(f"least(size(words), {SPAN})"))
    return (w.select("item", "m", "words", F.expr("explode(sequence(1, size(words) - m + 1))").alias("i"))
            .select("item", "m", F.expr("array_join(slice(words, i, m), ' ')").alias("window")).distinct())


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``, and ``_text_hash`` (the text's hash, to join decisions back to repeated ids).

    Null and empty texts have no words and no hits; null item ids count as the id ''.  Items without
    words give no windows.  Repeated rows give repeated rows, also when one id has several texts.
    An empty ``items`` gives clean rows.  Columns other than those named are neither read nor returned.
    """
    key = docs.select(F.col(id_col).alias("id"), F.expr(f"xxhash64({text_col})").alias("th"), F.col(text_col).alias("tx"))
    wins = C.written(windows(items, item_col, item_text), "decontam-windows")
    sizes = sorted(r.m for r in wins.select("m").distinct().collect())  # at most SPAN values

    # fingerprints that documents share with items of a full window
    each = F.expr(f"explode({fingerprints('words')})").alias("f")
    fps = (items.select(F.expr(C.words(item_text)).alias("words")).where(f"size(words) >= {SPAN}")
           .select(each).distinct())
    dw = key.select("id", "th", F.expr(C.words("tx")).alias("words"))
    found = (dw.where(f"size(words) >= {SPAN}").select("id", "th", each)
             .join(C.small_side(fps), "f").select("id", "th"))
    for m in (s for s in sizes if s < SPAN):  # items too short for a fingerprint: their whole text
        short = wins.where(f"m = {m}").select(F.expr("xxhash64(window)").alias("f")).distinct()
        grams = dw.where(f"size(words) >= {m}").select("id", "th", F.expr(
            f"explode(array_distinct(transform(sequence(1, size(words) - {m - 1}), "
            f"i -> xxhash64(array_join(slice(words, i, {m}), ' ')))))").alias("f"))
        found = found.unionByName(grams.join(C.small_side(short), "f").select("id", "th"))
    found = C.written(found.distinct(), "decontam-found")

    # extend: every exact occurrence of a window in the documents found
    near = C.small_side(found).alias("n")
    cand = (key.alias("k").join(near, F.expr("k.id <=> n.id AND k.th <=> n.th"), "left_semi")
            .select("id", "th", F.expr(C.words("tx")).alias("words")).distinct())
    wins = C.small_side(wins)
    hits = None
    for m in sizes:
        at = (cand.where(f"size(words) >= {m}")
              .select("id", "th", "words", F.expr(f"explode(sequence(0, size(words) - {m}))").alias("at"))
              .select("id", "th", "at", F.expr(f"array_join(slice(words, at + 1, {m}), ' ')").alias("window"))
              .join(wins.where(f"m = {m}").select("window", "item"), "window")
              .select("id", "th", "item", F.struct("at", F.expr(f"at + {m}").alias("to")).alias("span")))
        hits = at if hits is None else hits.unionByName(at)
    out = key.select("id", "th", F.expr(C.n_words("tx")).alias("n_words"))
    if hits is None:
        hits = key.select("id", "th", F.lit("").alias("item"), F.expr("struct(0 as at, 0 as to)").alias("span")).where("false")
    per = (hits.groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("item_list"),
                                        F.sort_array(F.collect_set("span")).alias("spans"))
           .select(F.col("id").alias("hid"), F.col("th").alias("hth"), "item_list", F.expr(
               "aggregate(spans, struct(0L as n, 0 as upto), (s, x) -> struct("
               "s.n + greatest(x.to - greatest(s.upto, x.at), 0) as n, greatest(s.upto, x.to) as upto), s -> s.n)").alias("n_hit")))
    out = out.join(per, F.expr("id <=> hid AND th <=> hth"), "left").select(
        F.col("id").alias(id_col), "n_words", F.expr("coalesce(n_hit, 0L)").alias("n_hit"),
        F.expr("CAST(coalesce(size(item_list), 0) AS BIGINT)").alias("n_items"),
        F.expr("sha2(coalesce(array_join(item_list, ','), ''), 256)").alias("items_sha256"),
        F.col("th").alias("_text_hash"))
    return out.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    i, h = C.fresh(docs, "bid", "bth")
    bad = (decontaminate(docs, items, id_col, text_col).where("contaminated")
           .select(F.col(id_col).alias(i), F.col("_text_hash").alias(h)).distinct())
    bad = C.small_side(C.written(bad, "decontam-drop"))
    return docs.join(bad, F.expr(f"`{id_col}` <=> `{i}` AND xxhash64(`{text_col}`) <=> `{h}`"), "left_anti")
