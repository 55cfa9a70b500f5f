"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.schema import DEFECT_SCHEMA, FEATURES, ID, TARGET, col
from tabspark.session import path_exists, path_glob

CORRUPT = "_corrupt_record"


def read_metrics(spark: SparkSession, path: str, schema=DEFECT_SCHEMA, fallback_glob: str | None = None,
                 keep_corrupt: bool = False) -> DataFrame:
    """CSV scan of a metric table with explicit types.

    Columns are typed BY NAME from the header: Spark applies a user schema to
    CSV columns by position, so the header is read first and the schema is
    built for exactly those names (known metrics get their type, aliases such
    as ``v_g`` the type of ``v(g)``, anything else stays a string).
    ``path`` may be a file or folder; if it does not exist, the first match of
    ``fallback_glob`` is used (S2); no match raises ``FileNotFoundError``.
    With ``keep_corrupt`` (as the prepare job reads) a row with a cell that its type cannot hold, or with too few
    or too many cells, keeps its text in ``_corrupt_record``, null for the others; else such cells are null.
    """
    from pyspark.sql import types as T

    from tabspark.schema import ALIASES
    target = path
    if not path_exists(spark, path):
        matches = path_glob(spark, fallback_glob) if fallback_glob else []
        if not matches:
            raise FileNotFoundError(f"no metric data at {path}")
        target = matches[0]
    known = {f.name: f.dataType for f in schema.fields}
    for alias, name in ALIASES.items():
        if name in known:
            known[alias] = known[name]
    header = spark.read.option("header", True).option("inferSchema", False).csv(target).columns
    fields = [T.StructField(h, known.get(h, T.StringType()), True) for h in header]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    sch = T.StructType(fields)
    reader = (spark.read.schema(sch).option("header", True).option("nanValue", "nan")
              .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.csv(target)
    # NaN is not a missing marker in Spark; make it one at ingest
    fixes = {f.name: F.when(F.isnan(col(f.name)), None).otherwise(col(f.name))
             for f in fields if f.dataType.typeName() in ("double", "float")}
    return df.withColumns(fixes) if fixes else df


def write_metrics_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


#: Where a row of a raw table goes: kept, or set aside as corrupt or with a target that does not map.
KEPT, CORRUPTED, UNMAPPED = "kept", "corrupt", "unmapped"
STATUS = "status"


def write_counted(df: DataFrame, path: str, target: str = TARGET) -> dict[str, int]:
    """Raw copy sink (S4) that sorts rows by what can be done with them, and counts them in the same write: parquet
    partitioned by ``STATUS``. Returns ``read`` and the rows of each status; read = kept + corrupt + unmapped.

    The counts are observed metrics of the writing tasks, so no second scan is needed. Without a target column every
    row that is not corrupt is kept."""
    from pyspark.sql import Observation

    from tabspark.operators.prepare import normalize_target
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    status = F.when(bad, CORRUPTED)
    if target in df.columns:
        status = status.when(normalize_target(F.col(target)).isNull(), UNMAPPED)
    d = df.withColumn(STATUS, status.otherwise(KEPT))
    seen = Observation()
    every = [F.count(F.lit(1)).alias("read"), *[F.count_if(F.col(STATUS) == s).alias(s) for s in (KEPT, CORRUPTED, UNMAPPED)]]
    d.observe(seen, *every).write.mode("overwrite").partitionBy(STATUS).parquet(path)
    return {k: int(v) for k, v in seen.get.items()}


def read_status(spark: SparkSession, path: str, *statuses: str) -> DataFrame:
    """The rows of these statuses of a table that ``write_counted`` wrote (other folders are pruned), without the status."""
    return spark.read.parquet(path).where(F.col(STATUS).isin(list(statuses))).drop(STATUS)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw copy sink."""
    df.write.mode(mode).parquet(path)


def write_splits(split_df: DataFrame, path: str, split_col: str = "split") -> None:
    """Split sink partitioned by split (S3): later reads prune to one split."""
    split_df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split_col) == name)


def write_split_metadata(split_df: DataFrame, path: str, features=FEATURES, split_col: str = "split") -> DataFrame:
    """Split metadata (S6): names, sample counts, feature list, scaler kind."""
    meta = (split_df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_samples"))
            .select(split_col, "n_samples", F.lit(len(features)).alias("n_features"),
                    F.array(*[F.lit(f) for f in features]).alias("feature_names"),
                    F.lit("StandardScaler").alias("scaler")))
    meta.coalesce(1).write.mode("overwrite").json(path)
    return meta


def unlabelled_features(df: DataFrame, features=FEATURES, target: str = TARGET) -> DataFrame:
    """Features only when the target is absent."""
    keep = [col(ID)] if ID in df.columns else []
    if target in df.columns:
        return df
    return df.select(*keep, *[col(f) for f in features])


def write_predictions(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Input columns + predictions (S8); array columns are dropped for CSV."""
    out = scored
    if fmt == "csv":
        out = scored.drop(*[f.name for f in scored.schema.fields if f.dataType.typeName() == "array"])
        out.write.mode("overwrite").option("header", True).csv(path)
    else:
        out.write.mode("overwrite").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One-row metrics JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
