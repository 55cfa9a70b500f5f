"""The pipeline on small tables: stage by stage against plain versions, and awkward rows."""

import __spark_entry__ as E
import corpus_pipeline
from test_operators import brute_classes, prose, words

from tabspark.llm import quality


def test_pipeline_against_brute_force(spark, tmp_path):
    copies = prose(1, 80, 10**6)
    docs = [(k, prose(k, 60 + k, 10**6), "en", f"s{k % 3}") for k in range(1, 40)] + [
        (50, copies, "en", "s0"), (51, copies, "en", None), (52, copies + " x", "en", "s1"), (53, None, None, None), (54, "short", "en", "s1"),
        (55, prose(55, 40, 10**6) + " " + prose(900, 20, 10**6), "en", "s2"), (56, prose(56, 60, 10**6) + " password=hunter2222", "en", "s2"), (57, prose(57, 60, 10**6), None, None)]
    rows = [(i, t, g, s, len(t) if t else None) for i, t, g, s in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, prose(900, 20, 10**6))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns[: len(df.columns)] == df.columns
    good = {r.doc_id for r in quality.quality(df).collect() if r.kept}
    left = [(i, t) for i, t, *_ in docs if i in good]
    one = {c for _, c, _, _ in brute_classes(left)}
    item = words(prose(900, 20, 10**6))
    bad = {i for i, t in left if any(words(t)[k:k + 13] == item[j:j + 13] for k in range(len(words(t)) - 12) for j in range(8))}
    out = {r.doc_id: r for r in got.collect()}
    assert set(out) == one - bad and 55 in bad and 54 not in out and 53 not in out and {1, 51, 52, 50} & set(out) == {1, 50} & set(out)
    assert out[56].text.endswith(" [SECRET]") and out[56].n_chars == len(out[56].text)
    assert all(out[i].text == t for i, t in left if i in out and i != 56)
    assert len({(r.slot, r.in_block) for r in out.values()}) == len(out)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "mixing sources"]
    names = E.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
