"""Schema of the metric table: 21 code metrics, optional id, target."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Feature names and their order, as used by the model input.
FEATURES: list[str] = [
    "loc", "v(g)", "ev(g)", "iv(g)", "n", "v", "l", "d", "i", "e", "b", "t",
    "lOCode", "lOComment", "lOBlank", "locCodeAndComment",
    "uniq_Op", "uniq_Opnd", "total_Op", "total_Opnd", "branchCount",
]
# The four integer-typed metrics of the request model.
INT_FEATURES: frozenset[str] = frozenset({"lOCode", "lOComment", "lOBlank", "locCodeAndComment"})
# Request aliases for the names with parentheses.
ALIASES: dict[str, str] = {"v_g": "v(g)", "ev_g": "ev(g)", "iv_g": "iv(g)"}

TARGET = "defects"
ID = "id"
LABEL = "label"

DEFECT_SCHEMA = T.StructType(
    [T.StructField(ID, T.LongType(), True)]
    + [
        T.StructField(f, T.LongType() if f in INT_FEATURES else T.DoubleType(), True)
        for f in FEATURES
    ]
    + [T.StructField(TARGET, T.StringType(), True)]
)


def col(name: str):
    """Column reference that tolerates parentheses/dots in the name.

    ``F.expr`` of the back-quoted name: the same unresolved attribute as
    ``F.col``, in a quarter of the driver-to-JVM calls.
    """
    return F.expr("`" + name.replace("`", "``") + "`")


def infer_features(schema: T.StructType, exclude=(TARGET, ID, LABEL)) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns by type, minus target/id (P5)."""
    numeric, categorical = [], []
    for field in schema.fields:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, T.StringType):
            categorical.append(field.name)
    return numeric, categorical


def rename_aliases(df):
    """Accept both ``v_g`` and ``v(g)`` spellings."""
    present = {a: c for a, c in ALIASES.items() if a in df.columns and c not in df.columns}
    return df.withColumnsRenamed(present) if present else df
