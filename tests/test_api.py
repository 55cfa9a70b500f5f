"""Object API: analyzer and predictor over the metric table."""

from conftest import SF01
from tabspark.api import BatchPredictor, EdaAnalyzer
from tabspark.operators.mlp import fixed_model
from tabspark.schema import FEATURES
from tabspark.sources.fixtures import read_metrics_fixture


def test_analyzer(spark):
    a = EdaAnalyzer(read_metrics_fixture(spark, SF01))
    assert a.features == FEATURES
    assert a.basic_statistics().count() == 21
    assert {r["defects"] for r in a.target_distribution().collect()} == {"TRUE", "FALSE"}
    assert a.correlation_analysis().count() == 22 * 22
    hist, kde, boxes = a.feature_distributions()
    assert hist.select("feature").distinct().count() == 10 and boxes.count() == 10
    assert a.outlier_analysis().count() > 0
    assert a.generate_report().where("section = 'shape'").count() == 2


def test_predictor(spark, tmp_out):
    f = read_metrics_fixture(spark, SF01)
    m = fixed_model(FEATURES)
    m.write(spark, f"{tmp_out}/m")
    p = BatchPredictor.load(spark, f"{tmp_out}/m")
    out = p.predict(f.drop("defects"))
    assert out.count() == 399 and "defect_probability" in out.columns
    b = p.predict_batch([f.limit(3), f.limit(4)])
    assert {r["batch_id"]: r["count"] for r in b.groupBy("batch_id").count().collect()} == {0: 3, 1: 4}
    ev = p.evaluate(f).first()
    assert 0.0 <= ev["roc_auc"] <= 1.0
