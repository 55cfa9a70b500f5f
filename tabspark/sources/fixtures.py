"""Stand-in metric table ``F``: 21 code-style metrics derived from ``documents``
joined to ``labels`` (``defects`` = 'TRUE' when quality = 0; F has the labelled
documents, and work that needs no label takes all). Pure column expressions: the work is one broadcast/shuffle join
plus per-row string functions, all inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.sources.tables import read_table


def _occurrences(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal substring."""
    return (F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / F.lit(len(needle))


def _has(text: Column, needle: str) -> Column:
    return F.when(F.instr(text, needle) > 0, 1).otherwise(0)


# The six "operator" characters counted by the stand-in metrics.
OPERATOR_CHARS = [",", ".", ";", ":", "|", "-"]
# Every character that is counted; as a class of a pattern, so the hyphen comes last.
COUNTED = "\n?,.;:|-"


def metric_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents and their labels → id, 21 metrics, defects (null without a label)."""
    d = docs.select("doc_id", "text")
    lab = labels.select("doc_id", "quality", F.lit(True).alias("labelled"))
    t = d.join(lab, "doc_id", "left")
    m = t.select(
        F.col("doc_id").alias("id"),
        F.col("quality"), F.col("labelled"),
        # each text is gone through once: every run of other characters as one x, so that neighbours stay neighbours
        F.regexp_replace("text", f"[^{COUNTED}]+", "x").alias("marks"),
        F.filter(F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " "), lambda x: x != "").alias("words"),
    )
    text, words = F.col("marks"), F.col("words")
    m = m.select(
        "id", "quality", "labelled",
        (_occurrences(text, "\n") + 1).cast("double").alias("loc"),
        (_occurrences(text, ".") + 1).cast("double").alias("vg"),
        (_occurrences(text, "?") + 1).cast("double").alias("evg"),
        (_occurrences(text, ":") + 1).cast("double").alias("ivg"),
        # integer halves of the doubled-needle counts, as (len diff)/2 truncated
        F.floor(_occurrences(text, "\n\n")).cast("bigint").alias("lOBlank"),
        F.floor(_occurrences(text, "\n-")).cast("bigint").alias("lOComment"),
        _occurrences(text, "|").cast("bigint").alias("locCodeAndComment"),
        sum((_has(text, c) for c in OPERATOR_CHARS), F.lit(0)).cast("double").alias("uniq_Op"),
        F.size(F.array_distinct(words)).cast("double").alias("uniq_Opnd"),
        sum((_occurrences(text, c) for c in OPERATOR_CHARS), F.lit(0)).cast("double").alias("total_Op"),
        F.size(words).cast("double").alias("total_Opnd"),
        _occurrences(text, ",").cast("double").alias("branchCount"),
    )
    n = F.col("total_Op") + F.col("total_Opnd")
    h = m.select(
        "*",
        n.alias("n"),
        (n * F.log2(F.greatest(F.col("uniq_Op") + F.col("uniq_Opnd"), F.lit(2.0)))).alias("v"),
        (F.greatest(F.col("uniq_Op"), F.lit(1.0)) / 2
         * (F.greatest(F.col("total_Opnd"), F.lit(1.0)) / F.greatest(F.col("uniq_Opnd"), F.lit(1.0)))).alias("d"),
    )
    v, dd = F.col("v"), F.col("d")
    return h.select(
        "id", "loc",
        F.col("vg").alias("v(g)"), F.col("evg").alias("ev(g)"), F.col("ivg").alias("iv(g)"),
        "n", "v", (1 / dd).alias("l"), "d", (v / dd).alias("i"), (dd * v).alias("e"),
        (v / 3000).alias("b"), (dd * v / 18).alias("t"),
        (F.col("loc").cast("bigint") - F.col("lOBlank") - F.col("lOComment")).alias("lOCode"),
        "lOComment", "lOBlank", "locCodeAndComment",
        "uniq_Op", "uniq_Opnd", "total_Op", "total_Opnd", "branchCount",
        F.when(F.col("quality") == 0, "TRUE").when(F.col("labelled"), "FALSE").alias("defects"),
    )


def read_all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; ``defects`` is null where it has no label."""
    return metric_table(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def read_metrics_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per labelled document."""
    return read_all_metrics(spark, sf_dir).where("defects IS NOT NULL")
