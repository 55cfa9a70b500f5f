"""Columns of a caller stay as they are, whatever they are called."""

import pytest
from test_operators import prose

from tabspark.llm import chat, decontaminate, jaccard_join, language, licenses, mixing, quality, repair, resample, secrets, urls

INNER = ["_t", "__t", "_w", "_l", "_h", "_text", "_row", "row", "text_", "_b", "_e", "_m", "_s", "found", "_found", "_rest", "rest", "head", "_head", "_host", "_src",
         "_r", "_n", "_k", "_j", "_p", "_id", "_tie", "_before", "_share", "_slot", "_spans", "_ends", "_pieces", "_done", "w", "may", "o0", "o1", "o2", "got", "u", "y"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, prose(k, 60, 10**6) + (" password=hunter2222" if k % 3 == 0 else ""), f"s{k % 2}", "en", "http://a.org/es/1", *[f"{n}{k}" for n in INNER]) for k in range(12)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, url string, " + ", ".join(f"`{n}` string" for n in INNER))


def kept(df, changed=()):
    assert [c for c in df.columns if c in INNER] == INNER
    rows = df.collect()
    for r in rows:
        assert all(r[n] == f"{n}{r.doc_id}" for n in INNER if n not in changed)
    return rows


def test_callers_columns_stay(spark, docs):
    assert len(kept(quality.quality(docs))) == len(kept(quality.keep_good(docs))) == 12
    assert len(kept(secrets.scan(docs))) == 12 and sum("[SECRET]" in r.text for r in kept(secrets.mask(docs))) == 4
    assert len(kept(licenses.scan(docs))) == 12
    assert len(kept(mixing.mix(docs))) == 12
    assert {r.verdict for r in kept(urls.judge(docs, urls.rule_table(spark)))} == {"allow"}
    assert len(kept(jaccard_join.keep_one(docs))) == 12
    bench = docs.selectExpr("doc_id AS item_id", "text").where("doc_id = 3")
    assert {r.doc_id for r in kept(decontaminate.drop_contaminated(docs, bench))} == set(range(12)) - {3}
    assert len(kept(language.predict(docs, language.fit(docs)))) == 12
    out = resample.resample(docs, bench, percent=50).collect()
    assert len(out) == 12 and all(r.row[n] == f"{n}{r.row.doc_id}" for r in out for n in INNER)


def test_conversations_with_inner_names(spark):
    names = "conv_id long, turn long, role string, text string, conv string, pos string, uid string, code string, codes string, chunk string, head string, hash string"
    df = spark.createDataFrame([(1, k, ["user", "assistant"][k % 2], f"t{k}.", *"abcdefgh") for k in range(4)], names)
    assert [r.audit for r in repair.repair(df)[0].collect()] == ["KKKK"]
    assert chat.link(*chat.from_turns(df)).count() >= 0
