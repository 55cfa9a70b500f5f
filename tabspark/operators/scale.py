"""Standard scaler (T3/T4): population std (ddof=0), constant features scale 1.

The fitted model is a handful of numbers per feature; ``transform`` inlines
them as literals, so scaling is a projection inside whole-stage codegen.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.functions import sqltext as Q


@dataclass
class ScalerModel:
    features: list[str]
    mean: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        exprs = {f + suffix: f"({Q.as_double(f)} - {Q.dbl(self.mean[f])}) / {Q.dbl(self.scale[f])}"
                 for f in self.features}
        # untouched columns first, scaled ones after (replaced in place of nothing)
        rest = [Q.ident(c) for c in df.columns if c not in exprs]
        return df.selectExpr(*rest, *[f"{e} AS {Q.ident(f)}" for f, e in exprs.items()])

    def params(self, spark: SparkSession) -> DataFrame:
        from tabspark.session import local_frame
        return local_frame(spark, [(f, self.mean[f], self.scale[f]) for f in self.features],
                           "feature string, mean double, scale double")

    def write(self, spark: SparkSession, path: str) -> None:
        """Parameter table as parquet (S10) — no pickles."""
        self.params(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, path: str, features: list[str] | None = None) -> "ScalerModel":
        rows = {r["feature"]: r for r in spark.read.parquet(path).collect()}  # one row per feature
        feats = features or sorted(rows)
        return cls(feats, {f: rows[f]["mean"] for f in feats}, {f: rows[f]["scale"] for f in feats})

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "mean": self.mean, "scale": self.scale})


class IdentityScaler(ScalerModel):
    """Pass-through stage when no scaler is configured."""

    def __init__(self, features):
        super().__init__(features, {f: 0.0 for f in features}, {f: 1.0 for f in features})

    def transform(self, df, suffix=""):
        return df


def fit_scaler(train: DataFrame, features: list[str]) -> ScalerModel:
    """Mean and population std per feature in one aggregate, nulls and NaN left out."""
    aggs = []
    for i, f in enumerate(features):
        c = Q.num(f)
        aggs += [f"avg({c}) AS m{i}", f"stddev_pop({c}) AS s{i}"]
    r = train.selectExpr(*aggs).first()
    mean, scale = {}, {}
    for i, f in enumerate(features):
        mean[f] = r[f"m{i}"] if r[f"m{i}"] is not None else 0.0
        s = r[f"s{i}"]
        scale[f] = 1.0 if (s is None or s == 0.0) else s
    return ScalerModel(list(features), mean, scale)
