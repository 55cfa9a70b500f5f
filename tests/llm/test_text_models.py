"""Conversation repair, language identification and importance resampling against plain Python versions."""

import hashlib
import heapq
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from test_operators import WORD, prose, words

from tabspark.llm import interning, language, repair, resample
from tabspark.llm import queries as Q


# ---------------------------------------------------------------- repair
def cheapest(rows):
    """(cost, audit, repaired) of (role, text, fault) rows: paths popped by cost, then audit."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit, out
        role, to = ("assistant", 3) if q == 2 else ("user", 2)
        heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*out, f"{role}:")))
        if i == len(rows):
            continue
        own, text, fault = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, out))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 if fault == "truncated" else 0
        heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*out, f"{role}:{text}")))
        keep = {"s": 1 if q == 0 else None, "u": 2 if q != 2 else None, "a": 3 if q == 2 else None}.get(own[:1])
        if keep:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, keep, (*out, f"{own}:{text}")))


def brute_repair(rows):
    """Result per conversation of (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv))
        seen, faults = set(), []
        for _, _, r, x in own:
            plain = x.strip(" \t\n\v\f\r")
            fault = "blank" if not plain else "duplicate" if (r, x) in seen else "truncated" if plain[-1] not in ".!?" else ""
            seen.add((r, x))
            faults.append((r, x, fault))
        cost, audit, text = cheapest(faults)
        turns = [t for has, t, _, _ in own if has]
        count = [sum(f == name for *_, f in faults) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())
    return out


def test_block_tables_against_all_paths():
    r = random.Random(3)
    for n in range(1500):
        codes = "".join(r.choice(repair.ALPHABET if n % 2 else "AEIHLMIE") for _ in range(r.randrange(14)))
        rows = [({"s": "s", "u": "u", "a": "a", "x": "x"}[repair.INITIALS[(ord(c) - 65) // 4]], "", repair.FAULTS[(ord(c) - 65) % 4]) for c in codes]
        assert repair.solve(codes)[:2] == cheapest(rows)[:2], codes


def test_chunks_give_the_edits_of_the_whole():
    r = random.Random(4)
    codes = "".join(r.choice(repair.ALPHABET) for _ in range(3 * repair.CHUNK + 5))
    _, audit, chunks = repair.solve(codes)
    edits = []
    for k, (right, state) in enumerate(chunks):
        part = codes[k * repair.CHUNK: (k + 1) * repair.CHUNK]
        edits += repair.edits_of(part, right, state, k == len(chunks) - 1)
    assert "".join("I" * len(b) + op for b, op, _ in edits) == audit


TURNS = "conv_id long, turn long, role string, text string, chunk string, `pos` string"


def test_repair_against_all_paths(spark):
    r, rows = random.Random(5), []
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["a b.", "a b.", "c?", "no end", "", " \t\n", None, "é! ", "x" * 300 + "."]
    for conv in [None, *range(40)]:
        rows += [(conv, r.choice([None, 0, 1, 2, 3, 9]) if conv != 3 else None, r.choice(roles), r.choice(texts)) for _ in range(r.randrange(1, 12))]
    rows += [(99, k, "user" if k % 2 == 0 else "assistant", f"t{k % 900}.") for k in range(2500)]  # longer than a chunk
    df = spark.createDataFrame([(*x, "y", "z") for x in rows], TURNS)
    out, fixed = repair.repair(df)
    got = {x[0]: tuple(x[1:]) for x in out.collect()}
    want = brute_repair(rows)
    short = {c for c in want if c != 99}
    assert set(got) == set(want)
    for c in short:  # equal turns are in order of role and text here too
        assert got[c] == want[c], c
    assert got[99] == want[99] and got[99][2] == 1600
    lines = {}
    for x in sorted(fixed.collect(), key=lambda x: (x.pos, x.at)):
        lines.setdefault(x.conv, []).append(f"{x.role}:{x.text}")
    for c, w in want.items():
        assert hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == w[-1]


def test_query_of_damaged_conversations(spark, tmp_path):
    r = random.Random(6)
    rows = [(c, t, ["user", "assistant"][(t or 0) % 2] if r.random() < .9 else None, prose((c or 0) * 50 + (t or 0), 4) + r.choice([".", "!", " "]) if r.random() < .9 else None)
            for c in [None, *range(60)] for t in [None, *range(7)]] + [(77, 4, "user", "x.")]
    spark.createDataFrame([(*x, "y", "z") for x in rows], TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    hurt = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            row = (c, t, "user" if k == 4 else role, "" if k == 1 else text.translate(str.maketrans("", "", ".!?")) if k == 2 else text)
            hurt += [row] * (2 if k == 3 else 1)
    want = brute_repair(hurt)
    got = {x.conv_id: tuple(x)[1:] for x in Q.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {c for c, *_ in rows}
    for c, x in got.items():
        assert x == want.get(c, (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())), c


def test_repair_of_nothing(spark):
    out, fixed = repair.repair(spark.createDataFrame([], TURNS))
    assert out.collect() == [] and fixed.collect() == []
    ids = spark.createDataFrame([(1, 0, "user", "a.", "", "")], TURNS).select("conv_id")
    assert [tuple(x) for x in repair.all_of(ids, out.withColumnRenamed("conv", "conv_id")).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", repair.EMPTY)]


# ---------------------------------------------------------------- resampling
def test_interning_against_a_dictionary():
    r = random.Random(1)
    texts = ["", "Hello world hello", None, "Étion dans, çouelle", "a" * 40 + " " + "b" * 300 + " " + "a" * 40, "--"]
    texts += [" ".join(r.choice(["a", "bb", "ccc", "x" * 31, "x" * 32, "x" * 33, "É" * 9, "yy" * 150]) + r.choice([" ", ",", "\n"]) for _ in range(r.randrange(60))) for _ in range(30)]
    raw = [(t or "").encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0] + [len(x) for x in raw])
    for n in (1, 3):
        g = interning.Grams(data, offsets, n)
        t = interning.Table(g, 97, room=8)
        want = sorted((i, " ".join(w[k:k + m])) for i, w in enumerate(map(words, texts)) for m in range(1, n + 1) for k in range(len(w) - m + 1))
        spelled = [g.bytes_of(k) for k in range(len(g.start))]
        assert sorted((int(d), s.decode()) for d, s in zip(g.doc, spelled)) == want
        assert g.hashes().tolist() == [xxhash.xxh64_intdigest(s) for s in spelled]
        assert len(t.used) == len({s for _, s in want}) and t.count[t.used].sum() == len(want)
        for k, s in enumerate(spelled):
            assert t.bucket[t.slot[k]] == zlib.crc32(s) % 97 and g.bytes_of(t.owner[t.slot[k]]) == s
        assert g.n_words.tolist() == [len(words(x)) for x in texts]


def test_equal_hashes_of_different_bytes_stay_apart():
    data = np.frombuffer(b"aa bb aa cc", dtype=np.uint8)
    g = interning.Grams(data, np.array([0, len(data)]))
    g.hashes = lambda: np.zeros(4, dtype=np.uint64)
    t = interning.Table(g, 1000)
    assert t.slot[0] == t.slot[2] and len(set(t.slot.tolist())) == 3


def brute_resample(docs, target, n, buckets, min_words, percent, seed=2024):
    def grams(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[k:k + m]).encode()) % buckets for m in range(1, n + 1) for k in range(len(w) - m + 1)]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for texts, into in ((docs, s), (target, t)):
        for _, x in texts:
            np.add.at(into, grams(x), 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        g = grams(x)
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(x)) >= min_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    ranks = [(*r[:4], k + 1) for k, r in enumerate(order[: len(order) * percent // 100])]
    return ranks, rows


@pytest.mark.parametrize("n,percent,min_words", [(1, 10, 20), (2, 50, 3), (1, 0, 0), (3, 100, 0)])
def test_resample_against_brute_force(spark, n, percent, min_words):
    docs = [(k, prose(k, k % 70, 50)) for k in range(150)] + [(None, prose(3, 40)), (None, prose(3, 40)), (7, prose(7, 25, 9)), (7, None), (8, ""), (9, "--- ..."), (-5, "É" * 40 + prose(2, 3000, 60))]
    target = [(0, prose(900, 400, 30)), (1, None), (2, "")]
    names = "doc_id long, text string, `row` string, weight string, rank string"
    df = spark.createDataFrame([(*d, "a", "b", "c") for d in docs], names)
    out = resample.resample(df, spark.createDataFrame(target, "item_id long, text string"), n=n, buckets=97, min_words=min_words, percent=percent)
    got = [(r.row.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()]
    ranks, rows = brute_resample(docs, target, n, 97, min_words, percent)
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((g[:4] for g in got), key=key) == sorted((r[:4] for r in rows), key=key)
    assert sorted((g for g in got if g[4]), key=lambda g: g[4]) == ranks
    assert all(r.row.weight == "b" and r.row["rank"] == "c" for r in out.collect())


def test_resample_of_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    full = spark.createDataFrame([(k, prose(k, 30)) for k in range(20)], "doc_id long, text string")
    assert resample.resample(empty, full).collect() == []
    got = resample.resample(full, empty).collect()
    assert len(got) == 20 and sum(r["rank"] is not None for r in got) == 2


# ---------------------------------------------------------------- language
def test_grams_against_plain_python():
    p = language.Params()
    for text in ("Hello, wörld 42!", "a", "", "--", "ÀÉ\nb", "x" * 9000):
        plain = " " + " ".join(WORD.sub(lambda m: m[0], "".join(c if c.isalpha() else " " for c in text.lower())).split()) + " "
        want = {}
        for n in (1, 2, 3):
            for k in range(len(plain) - n + 1):
                g = plain[k: k + n]
                if " " in g[1:-1] or not g.strip():
                    continue
                h = n
                for c, m in zip(g, language._MULTIPLY.tolist()):
                    h = (h ^ ord(c)) * m % 2**32
                    h ^= h >> 15
                want[h % p.buckets] = want.get(h % p.buckets, 0) + 1
        bucket, count = language.grams(text, p)
        assert dict(zip(bucket.tolist(), count.tolist())) == want


def test_ftrl_step_by_step():
    p = language.Params(alpha=0.7, beta=0.5, l1=0.05, l2=0.1)
    m, r = language.Ftrl(5, 3, p), np.random.default_rng(0)
    z, n = np.zeros((6, 3)), np.zeros((6, 3))
    for _ in range(60):
        rows, y = np.append(np.sort(r.choice(5, 2, replace=False)), 5), int(r.integers(3))
        x = np.append(r.random(2), 1.0)
        w = [[0.0 if abs(z[i, k]) <= p.l1 else -(z[i, k] - math.copysign(p.l1, z[i, k])) / ((p.beta + math.sqrt(n[i, k])) / p.alpha + p.l2) for k in range(3)] for i in rows]
        e = [math.exp(sum(x[i] * w[i][k] for i in range(3))) for k in range(3)]
        for i, row in enumerate(rows):
            for k in range(3):
                g = x[i] * (e[k] / sum(e) - (k == y))
                z[row, k] += g - (math.sqrt(n[row, k] + g * g) - math.sqrt(n[row, k])) / p.alpha * w[i][k]
                n[row, k] += g * g
        m.learn(rows, x, y)
    np.testing.assert_allclose(m.z, z, atol=1e-9)
    assert (np.abs(m.z) <= p.l1).any() == (m.weights() == 0).any()


def test_temperature_undoes_a_scale():
    r = np.random.default_rng(2)
    z = r.normal(size=(6000, 3)) * 2
    y = np.array([r.choice(3, p=row) for row in language.softmax(z)])
    assert language.temperature(z * 5, y) == pytest.approx(5, rel=0.1)
    assert language.temperature(np.zeros((0, 3)), np.zeros(0, dtype=int)) == 1.0
    assert 0.02 < language.temperature(np.eye(3)[[0, 1, 2] * 50], np.array([0, 1, 2] * 50)) < 1


def test_language_by_held_out_rows(spark):
    from tabspark.llm import common
    docs = common.read(spark, "/root/testdata/sf0.01", "documents")
    odd = spark.createDataFrame([(None, None, None, "s", 0), (1, "", "en", "s", 0), (2, "12 34 --", "de", "s", 0), (10**9, "die und der ist nicht ein", None, None, 0)], docs.schema)
    got = language.identify(docs.unionByName(odd)).collect()
    assert len(got) == docs.count() + 4
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert sum(r.lang_pred == "und" for r in got) == 3 and all(r.score == 0 for r in got if r.lang_pred == "und")
    real = [r for r in got if r.lang_pred != "und" and r.doc_id in truth]
    held = [r for r in real if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got) and {r.lang_pred for r in real} == set(truth.values())


def test_language_without_labels_and_of_copies(spark):
    names = "doc_id long, text string, lang string, label string, u double"
    empty = spark.createDataFrame([], names)
    assert language.identify(empty).collect() == []
    none = spark.createDataFrame([(1, "abc", None, "x", 0.5)], names)
    assert [tuple(r)[2:] for r in language.identify(none).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(k, "abc def", "en", "x", 0.5) for k in range(40)], names)
    assert {r.lang_pred for r in language.identify(one).collect()} == {"en"}
    hot = spark.createDataFrame([(k, "abc def", "en", "x", 0.5) for k in range(60)] + [(k, prose(k, 20), "ww", "x", 0.5) for k in range(60, 90)], names)
    p = language.Params(per_language=10)
    got = language.identify(hot, params=p).collect()
    assert all(r.lang_pred == ("en" if r.doc_id < 60 else "ww") for r in got)
    kept = language.predict(hot, language.fit(hot, params=p)).columns
    assert kept == ["doc_id", "text", "lang", "label", "u", "lang_pred", "score"]
