"""Target normalisation, audits, feature alignment and width checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.schema import FEATURES, ID, LABEL, TARGET, col, rename_aliases

# Accepted target spellings (string forms; booleans are cast to
# 'true'/'false' first).
TRUE_SPELLINGS = ["TRUE", "true", "True"]
FALSE_SPELLINGS = ["FALSE", "false", "False"]


def normalize_target(c: Column) -> Column:
    """Map the six accepted spellings (and booleans) to 1/0, anything else to null.

    Matching is exact: no trimming or lower-casing beyond the listed forms.
    """
    s = c.cast("string")
    return (F.when(s.isin(TRUE_SPELLINGS), F.lit(1))
            .when(s.isin(FALSE_SPELLINGS), F.lit(0))
            .otherwise(F.lit(None)).cast("int"))


def with_label(df: DataFrame, target: str = TARGET, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, normalize_target(F.col(target)))


def target_audit(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows whose target does not map, with the distinct bad values.

    One aggregate; the distinct set is built by a grouped pre-aggregation so no
    task holds more than the distinct bad values.
    """
    bad = (df.select(F.col(target).cast("string").alias("bad_value"))
           .where(normalize_target(F.col("bad_value")).isNull()))
    return (bad.groupBy("bad_value").agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.coalesce(F.col("bad_value"), F.lit("<null>")).alias("bad_value"),
                    F.col("n_rows").cast("bigint").alias("n_rows")))


def rejected_targets(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The rows of ``df`` that ``prepare`` cannot label: a target that is null or no accepted spelling."""
    return df.where(normalize_target(F.col(target)).isNull())


def prepare(df: DataFrame, features=FEATURES, target: str = TARGET, id_col: str = ID) -> DataFrame:
    """End-to-end preparation (T1): keep the id as key, normalise the target,
    project features. Without a target column, features only (S7)."""
    df = rename_aliases(df)
    keep = [col(id_col)] if id_col in df.columns else []
    feats = [col(f) for f in features]
    if target in df.columns:
        return df.select(*keep, *feats, normalize_target(F.col(target)).alias(LABEL))
    return df.select(*keep, *feats)


def align_features(df: DataFrame, features=FEATURES) -> DataFrame:
    """Features by name in fixed order; absent or null features become 0.0."""
    df = rename_aliases(df)
    present = set(df.columns)
    cols = [
        (F.coalesce(col(f).cast("double"), F.lit(0.0)) if f in present else F.lit(0.0)).alias(f)
        for f in features
    ]
    others = [col(c) for c in df.columns if c not in set(features)]
    return df.select(*others, *cols)


def features_array(features=FEATURES, dtype: str = "float") -> Column:
    """Feature vector at the model edge (P9): array<float> in fixed order."""
    return F.array(*[col(f).cast(dtype) for f in features])


def width_check(df: DataFrame, arr: str, width: int = len(FEATURES)) -> DataFrame:
    """Flag rows whose vector width differs from the model width."""
    return df.withColumn("width_ok", F.coalesce(F.size(F.col(arr)) == width, F.lit(False)))


def assert_width(schema: T.StructType, features=FEATURES) -> None:
    missing = [f for f in features if f not in schema.fieldNames()]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
