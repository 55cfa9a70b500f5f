"""The stand-in metric table against plain Python, and the work of its plan."""

import math
import random

from tabspark.schema import FEATURES
from tabspark.sources.fixtures import metric_table

PARTS = ["\n", "\n\n", "\n-", "-", "--", "?", ".", ",", ";", ":", "|", "a", "b a", "é", "\U0001F600", " ", "  ", "\r", "\t", "\\", "^", "]", "[", "$1",
         " ", "\u0085", "x"]


def _tables(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 60))) for _ in range(300)] + ["", "\n", "x", "\n\n\n-\n-", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, len(texts), 3)], "doc_id long, quality int")
    return texts, docs, labels


def _plain(s):
    words = [w for w in s.replace("\n", " ").split(" ") if w]
    ops = [s.count(c) for c in ",.;:|-"]
    uniq_op, uniq, op, opnd = sum(c > 0 for c in ops), len(set(words)), sum(ops), len(words)
    n = op + opnd
    v, d = n * math.log2(max(uniq_op + uniq, 2)), max(uniq_op, 1) / 2 * (max(opnd, 1) / max(uniq, 1))
    loc, blank, comment = s.count("\n") + 1, s.count("\n\n"), s.count("\n-")
    return {"loc": loc, "v(g)": s.count(".") + 1, "ev(g)": s.count("?") + 1, "iv(g)": s.count(":") + 1, "n": n, "v": v, "l": 1 / d, "d": d, "i": v / d,
            "e": d * v, "b": v / 3000, "t": d * v / 18, "lOCode": loc - blank - comment, "lOComment": comment, "lOBlank": blank,
            "locCodeAndComment": s.count("|"), "uniq_Op": uniq_op, "uniq_Opnd": uniq, "total_Op": op, "total_Opnd": opnd, "branchCount": s.count(",")}


def test_metrics_equal_plain_python(spark):
    texts, docs, labels = _tables(spark)
    rows = {r["id"]: r for r in metric_table(docs, labels).collect()}
    assert sorted(rows) == list(range(len(texts)))
    for i, s in enumerate(texts):
        assert rows[i]["defects"] == (None if i % 3 else "FALSE" if i % 2 else "TRUE")
        if s is not None:
            want = _plain(s)
            assert all(math.isclose(rows[i][f], want[f], rel_tol=1e-12) for f in FEATURES), (i, s)
    assert rows[len(texts) - 1]["loc"] is None


def test_each_text_is_gone_through_once(spark):
    """Characters are counted in the short text of marks, not by a pass over the whole text for each of them."""
    _, docs, labels = _tables(spark)
    plan = metric_table(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(text") <= 2  # the marks, and the words
    assert "length(text" not in plan and "instr(text" not in plan
