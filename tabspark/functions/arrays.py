"""Array functions over logits/probability vectors (F1-F3), as higher-order
SQL expressions so they stay on the JVM.

``with_softmax`` computes the shift (max) and the normaliser (sum) once per row
as columns and only then maps the elements: a lambda that refers to
``array_max(arr)`` or to the sum would re-evaluate it for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_softmax(df: DataFrame, arr: str | Column, out: str = "probabilities") -> DataFrame:
    """Adds the max-shifted softmax of a numeric array column (F1)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return (df.withColumn("__sm_m", F.array_max(a).cast("double"))
            .withColumn("__sm_e", F.transform(a, lambda x: F.exp(x.cast("double") - F.col("__sm_m"))))
            .withColumn("__sm_t", F.aggregate("__sm_e", F.lit(0.0), lambda acc, x: acc + x))
            .withColumn(out, F.transform("__sm_e", lambda x: x / F.col("__sm_t")))
            .drop("__sm_m", "__sm_e", "__sm_t"))


def with_log_sum_exp(df: DataFrame, arr: str, out: str = "lse") -> DataFrame:
    """Adds log(sum(exp(arr))) computed stably (max shift once per row)."""
    return (df.withColumn("__lse_m", F.array_max(arr).cast("double"))
            .withColumn(out, F.col("__lse_m") + F.log(F.aggregate(
                arr, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - F.col("__lse_m")))))
            .drop("__lse_m"))


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum (F2); ties go to the lowest index."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def confidence(probs: Column) -> Column:
    """Largest probability."""
    return F.array_max(probs)
