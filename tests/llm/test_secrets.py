"""Keys glued to dividers and samples, texts full of matches, and masks against a plain version."""

import random
import string
import time

from tabspark.llm import common, secrets

KEY = "Zk8fQ2nR7vXw3LmT9pYs5BdGh1JcA4e"  # 31 characters


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(x.at, secrets.KINDS[x.kind], x.to) for x in r.secret_spans] for r in secrets.scan(df).collect()}


def test_glued_keys_are_found_and_masked(spark):
    glued = ["==========" + KEY, "----------" + KEY, "example/" + KEY, KEY + "______________", "a" * 12 + KEY, "xxxxx-" + KEY + "-placeholder"]
    clean = ["=" * 40, "-" * 30 + "heading" + "-" * 30, "example/of/a/path/in/a/library", "x" * 50, "snake_case_name_of_a_function",
             "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"]
    got = spans(spark, glued + clean)
    assert all(any(k == "entropy" for _, k, _ in got[i]) for i in range(len(glued))), got
    assert all(not got[len(glued) + i] for i in range(len(clean))), got
    out = secrets.mask(spark.createDataFrame(list(enumerate(glued)), "doc_id long, text string")).collect()
    assert all(KEY not in r.text for r in out)


def test_a_span_that_reaches_beyond_a_base_span_stays(spark):
    whole = "Q9zX" + "0123456789abcdef01234567" + "Wv8RkT2LpN7mYc"
    got = spans(spark, [f"a {whole} b", "0123456789abcdef01234567", "token=" + KEY])
    assert [k for _, k, _ in got[0]] == ["entropy", "hex"] and [k for _, k, _ in got[1]] == ["hex"]
    assert [k for _, k, _ in got[2]] in (["assign"], ["assign", "entropy"])
    masked = secrets.mask(spark.createDataFrame([(0, f"a {whole} b")], "doc_id long, text string")).first().text
    assert masked == "a [SECRET] b"


def test_mask_against_a_plain_version(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice(string.ascii_letters + string.digits) for _ in range(r.choice([3, 8, 26])))
    texts = [" ".join(r.choice([word(), "password=" + word(), "deadbeef" * 4, "𝄞é", "secret:" + "0123456789abcdef" * 3]) for _ in range(n)) for n in (0, 1, 5, 80, 900)]
    df = spark.createDataFrame([(i, t, "t", "f") for i, t in enumerate(texts)], "doc_id long, text string, `_t` string, `_found` string")
    found = {x.doc_id: x.secret_spans for x in secrets.scan(df).collect()}
    for x in secrets.mask(df).collect():
        out, at = "", 0
        for s in found[x.doc_id]:
            if s.at >= at:
                out += texts[x.doc_id][at:s.at] + "[SECRET]"
            at = max(at, s.to)
        assert x.text == out + texts[x.doc_id][at:] and (x["_t"], x["_found"]) == ("t", "f")


def test_prefixes_of_long_arrays(spark):
    for n in (0, 1, 31, 32, 33, 1024, 1025, 40_000):
        v = f"transform(CASE WHEN {n} > 0 THEN sequence(1, {n}) ELSE array() END, x -> CAST(x % 97 AS INT))"
        got = spark.range(1).selectExpr(common.prefix(v, "{0} + {1}", "0") + " AS s", common.prefix(v, "greatest({0}, {1})", "0") + " AS m").first()
        total, top, sums, tops = 0, 0, [], []
        for k in range(1, n + 1):
            sums.append(total)
            tops.append(top)
            total, top = total + k % 97, max(top, k % 97)
        assert got.s == sums and got.m == tops


def test_a_text_full_of_matches_takes_time_in_proportion(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, " ".join(f"{k:08x}" * 4 for k in range(n)))], "doc_id long, text string")
        start = time.time()
        got = secrets.scan(df).selectExpr("size(secret_spans) AS n").first().n
        assert got == n
        return time.time() - start
    seconds(100)
    assert seconds(16_000) < 8 * max(seconds(2_000), 0.5)
