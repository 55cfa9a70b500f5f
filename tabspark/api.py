"""Object API over the operators, one method per step of the reference's
analysis and prediction classes, so existing scripts map one-to-one.

``EdaAnalyzer``: statistics → target distribution → correlations → feature
distributions → outliers → report, every result a DataFrame.
``BatchPredictor``: optional scaler + model; predict / predict per frame /
evaluate with metrics and ROC-AUC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.operators import profiling as P
from tabspark.operators.mlp import MlpModel, PreprocessScorer, evaluate
from tabspark.operators.prepare import align_features, normalize_target
from tabspark.operators.scale import ScalerModel
from tabspark.schema import FEATURES, LABEL, TARGET, infer_features


class EdaAnalyzer:
    def __init__(self, df: DataFrame, target: str = TARGET):
        self.target = target
        self.df = df.withColumn(LABEL, normalize_target(F.col(target))) if target in df.columns else df
        self.features, _ = infer_features(df.schema)

    def basic_statistics(self) -> DataFrame:
        """describe + missing count/percent per numeric feature."""
        d = P.describe_numeric(self.df, self.features)
        mp = P.missing_profile(self.df.select(*[f"`{f}`" for f in self.features]))
        return d.join(mp.withColumnRenamed("column_name", "feature"), "feature")

    def target_distribution(self) -> DataFrame:
        return P.target_distribution(self.df, self.target)

    def correlation_analysis(self) -> DataFrame:
        cols = self.features + ([LABEL] if LABEL in self.df.columns else [])
        return P.correlation_matrix(self.df, cols)

    def top_correlations(self, n: int = 10) -> DataFrame:
        return P.top_correlations(self.df, self.features, LABEL, n)

    def feature_distributions(self, top_n: int = 10):
        """(histograms with mean/std, KDE curves, box numbers by target) of the
        top-n variance features."""
        m = P.moments(self.df, self.features)
        cols = P.top_variance_features(self.df, self.features, top_n, m)
        boxes = P.box_stats(self.df, cols[:5], by=self.target) if self.target in self.df.columns else None
        return P.histograms(self.df, cols, 30, m), P.kdes(self.df, cols, 200, 30, m), boxes

    def outlier_analysis(self) -> DataFrame:
        return P.outlier_profile(self.df, self.features)

    def generate_report(self) -> DataFrame:
        return P.eda_report(self.df, self.features, LABEL if LABEL in self.df.columns else None)


class BatchPredictor:
    def __init__(self, model: MlpModel, scaler: ScalerModel | None = None):
        self.scorer = PreprocessScorer(scaler, model)

    @classmethod
    def load(cls, spark, model_path: str, scaler_path: str | None = None) -> "BatchPredictor":
        model = MlpModel.read(spark, model_path)
        scaler = ScalerModel.read(spark, scaler_path, model.features) if scaler_path else None
        return cls(model, scaler)

    def predict(self, df: DataFrame) -> DataFrame:
        """prediction, is_defect, defect_probability, confidence per row."""
        return self.scorer.transform(align_features(df))

    def predict_batch(self, frames: list[DataFrame]) -> DataFrame:
        """Several frames scored in one pass; ``batch_id`` keeps their identity."""
        tagged = None
        for i, f in enumerate(frames):
            t = f.withColumn("batch_id", F.lit(i))
            tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
        return self.predict(tagged)

    def evaluate(self, df: DataFrame) -> DataFrame:
        """accuracy, precision, recall, f1, roc_auc when the target is present;
        otherwise the predictions."""
        if TARGET not in df.columns and LABEL not in df.columns:
            return self.predict(df)
        lab = F.col(LABEL) if LABEL in df.columns else normalize_target(F.col(TARGET))
        labelled = align_features(df.withColumn("__y", lab).where(F.col("__y").isNotNull()))
        return evaluate(self.scorer, labelled, "__y")


__all__ = ["EdaAnalyzer", "BatchPredictor", "FEATURES"]
