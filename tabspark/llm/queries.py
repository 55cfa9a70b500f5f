"""Registered queries of the operators of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import common as C
from . import (chat, decontaminate, html_extract, jaccard_join, language, licenses, mixing, quality, repair, resample,
               secrets, suffix_dedup, urls)

# SQL of the word rule: A-Z lowered, separators dropped.
_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def op1_html_extract(spark, sf_dir):
    return html_extract.extract(C.read(spark, sf_dir, "pages"))


def op2_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark")).drop("_text_hash")


OP2_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
sizes AS (SELECT DISTINCT m FROM wins),
spots AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, sizes WHERE len(w) >= m)),
hits AS (SELECT s.doc_id, s.m, s.i, x.item FROM spots s JOIN wins x ON s.m = x.m AND s.win = x.win),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n.n, 0) AS BIGINT) AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
  coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN cover c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""


def op3_chat_format(spark, sf_dir):
    return chat.link(*chat.from_turns(C.read(spark, sf_dir, "conversations")))


def op4_license_scan(spark, sf_dir):
    return licenses.scan(C.read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.join(C.read(spark, sf_dir, "documents")).drop("_text_hash")


def op6_quality(spark, sf_dir):
    return quality.quality(C.read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
  FROM g JOIN (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR (n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines)
    OR (100 * n_symbols > 60 * n_words AND 100 * n_symbols > 10 * word_chars)
    OR 2 * word_chars < 3 * n_words OR word_chars > 40 * n_words) AS kept FROM b
"""


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(C.read(spark, sf_dir, "documents"))


def op8_mix_sources(spark, sf_dir):
    return mixing.mix(C.read(spark, sf_dir, "documents").select("doc_id", "source"))


OP8_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, '') AS src,
    row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5('7:' || doc_id), doc_id) - 1 AS k FROM documents),
c AS (SELECT src, count(*) AS n FROM d GROUP BY src),
w AS (SELECT src, n, CAST(greatest(1, round(pow(n, 0.5) * greatest(1000, 4 * count(*) OVER ()) / sum(pow(n, 0.5)) OVER ())) AS BIGINT) AS share FROM c),
s AS (SELECT list(src ORDER BY src) AS src, list(share ORDER BY src) AS share, CAST(sum(share) AS BIGINT) AS p FROM w),
run AS (SELECT 0 AS t, list_transform(src, lambda x: CAST(0 AS BIGINT)) AS nxt, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS j FROM s
  UNION ALL
  SELECT t + 1, list_transform(nxt, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END), pick, nxt[pick]
  FROM (SELECT t, nxt, list_sort(list_filter(list_transform(nxt, lambda x, i: CASE WHEN x < share[i] AND (x * p) // share[i] <= t
      THEN {'due': ((x + 1) * p + share[i] - 1) // share[i], 'i': i} END), lambda x: x IS NOT NULL))[1].i AS pick
    FROM run, s WHERE t < p)),
slots AS (SELECT s.src[k] AS src, j, t - 1 AS slot FROM run, s WHERE k > 0)
SELECT d.doc_id, d.source, CAST(d.k // 16 AS BIGINT) AS block,
  CAST((d.k // 16) // w.share * s.p + slots.slot AS BIGINT) AS slot, CAST(d.k % 16 AS BIGINT) AS in_block,
  CAST((d.k // 16) * s.p // w.share AS BIGINT) AS release, CAST(((d.k // 16 + 1) * s.p + w.share - 1) // w.share AS BIGINT) AS due
FROM d JOIN w USING (src) CROSS JOIN s JOIN slots ON slots.src = d.src AND slots.j = (d.k // 16) % w.share
"""


def op9_url_filter(spark, sf_dir):
    return urls.judge(C.read(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark)).drop("url")


OP9_SQL = r"""
WITH rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
f AS (SELECT page_id, arg_max({'rule': h || p, 'verdict': verdict}, length(h || p)) AS best
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM u LEFT JOIN f USING (page_id)
"""


def op10_secret_scan(spark, sf_dir):
    d = secrets.scan(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    n = "CAST(size(filter(secret_spans, x -> x.kind = {})) AS BIGINT)"
    return d.select("doc_id", F.expr(n.format(0)).alias("n_assign"), F.expr(n.format(1)).alias("n_access"),
                    F.expr(n.format(2)).alias("n_hex"),
                    F.expr(f"sha2({secrets.joined('filter(secret_spans, x -> x.kind < 3)')}, 256)").alias("base_sha256"),
                    F.expr(secrets.joined("secret_spans")).alias("spans"))


def _op10_sql():
    lit = lambda p: "'" + p.replace("'", "''") + "'"

    def found(kind, pattern, group=0, where="true"):
        p = lit(pattern)
        g = f"regexp_extract_all(t, {p}, {group})[i]"
        return f"""SELECT doc_id, {kind} AS kind, s, pos, pos + length(s) AS "to" FROM (SELECT doc_id, m[i] AS s, {g} AS g,
  CAST(list_sum(list_transform(a[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS pos
  FROM (SELECT doc_id, t, a, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, t, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS a FROM t)))
  WHERE {where}"""
    allowed = " OR ".join(f"regexp_matches(seg, {lit(p)})" for p in secrets.ALLOW)
    least = "CASE " + " ".join(f"WHEN regexp_matches(seg, {lit(p)}) THEN {e}" for _, p, e in secrets.CLASSES) + " END"
    name = "CASE kind " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(secrets.KINDS)) + " END"
    line = f"""string_agg({name} || ':' || pos || ':' || "to", ',' ORDER BY pos, kind, "to")"""
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS ({found(0, secrets.ASSIGN, 2, f"length(g) >= {secrets.ASSIGN_LEAST}")} UNION ALL {found(1, secrets.ACCESS)} UNION ALL {found(2, secrets.HEX)}),
cand AS ({found(3, secrets.CANDIDATE)}),
segs AS (SELECT DISTINCT s, seg FROM (SELECT s, unnest(string_split_regex(s, {lit(secrets.DIVIDER)})) AS seg FROM (SELECT DISTINCT s FROM cand))
  WHERE length(seg) >= {secrets.WINDOW} AND NOT ({allowed})),
bits AS (SELECT s, seg, max(list_aggregate(string_split(seg[i:i + {secrets.WINDOW - 1}], ''), 'entropy')) AS bits
  FROM (SELECT s, seg, unnest(range(1, length(seg) - {secrets.WINDOW - 2})) AS i FROM segs) GROUP BY s, seg),
more AS (SELECT * FROM cand c WHERE s IN (SELECT s FROM bits WHERE bits >= {least})
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.pos <= c.pos AND b."to" >= c."to")),
n AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2, {line} AS line FROM base GROUP BY doc_id),
e AS (SELECT doc_id, {line} AS line FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(n.line, '')) AS base_sha256, coalesce(e.line, '') AS spans
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)
"""


def op11_conversation_repair(spark, sf_dir):
    turns = C.read(spark, sf_dir, "conversations")
    out = repair.repair(repair.damaged(turns))[0].withColumnRenamed("conv", "conv_id")
    return repair.all_of(turns.select("conv_id"), out)


# The checksum of a text, bit by bit from its polynomial, as DuckDB has none.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(length({h}) // 2), lambda j: CAST('0x' || substr({h}, CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT))),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT))"""


def _op11_sql():
    def edit(state, cost, letter, line):
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {line}}}"

    def least(*options):  # a struct of nulls is an option that is not there
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x.c IS NOT NULL))[1]"

    none = "{'c': CAST(NULL AS BIGINT), 'a': CAST(NULL AS VARCHAR), 'r': CAST(NULL AS VARCHAR)}"
    given = "chr(10) || f.role || ':' || f.text"
    insert = lambda q, role: edit(q, 5, "I", f"chr(10) || '{role}:'")
    gone = lambda q: edit(f"x.{q}", 2, "D", "''")
    fits = lambda q, i: f"CASE WHEN f.fault NOT IN ('blank', 'duplicate') AND f.i = '{i}' THEN {edit('x.' + q, 'f.extra', 'K', given)} ELSE {none} END"
    moved = lambda q, role: f"CASE WHEN f.fault NOT IN ('blank', 'duplicate') THEN {edit('x.' + q, '1 + f.extra', 'R', f'chr(10) || {chr(39)}{role}:{chr(39)} || f.text')} ELSE {none} END"
    raw = f"""{gone('q0')} AS b0, {least(gone('q1'), fits('q0', 's'))} AS b1,
      {least(gone('q2'), *[fits(q, 'u') for q in ('q0', 'q1', 'q3')], *[moved(q, 'user') for q in ('q0', 'q1', 'q3')])} AS b2,
      {least(gone('q3'), fits('q2', 'a'), moved('q2', 'assistant'))} AS b3"""
    q2 = least("b2", insert("b0", "user"), insert("b1", "user"), insert("b3", "user"))
    q3 = least("b3", insert("u", "assistant"))
    start = "{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
keys AS (SELECT *, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h FROM conversations),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x, {_CRC.format(h='h')} % 20 AS k FROM keys, crc),
e AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE r END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(x, '.!?', '') ELSE x END AS text,
  unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE k <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
  CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS i FROM e),
f AS (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
  lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM p)),
run AS (SELECT conv_id, CAST(0 AS BIGINT) AS n, {start} AS q0, {none} AS q1, {insert(start, 'user').replace(start + '.c', '0').replace(start + '.a', "''").replace(start + '.r', "''")} AS q2,
    {{'c': CAST(10 AS BIGINT), 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS q3 FROM (SELECT DISTINCT conv_id FROM p)
  UNION ALL
  SELECT conv_id, n, b0, b1, {least('u', insert('w', 'user'))}, w FROM (SELECT *, {q3} AS w FROM (SELECT *, {q2} AS u FROM (
    SELECT f.conv_id, f.n, {raw} FROM run x JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.n = x.n + 1)))),
best AS (SELECT conv_id, {least('q0', 'q3')} AS s FROM run QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s.c, 0) AS BIGINT) AS cost,
  coalesce(s.a, '') AS audit, sha256(coalesce(substr(s.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN facts g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def op12_language_id(spark, sf_dir):
    return language.identify(C.read(spark, sf_dir, "documents"))


def op13_importance_resampling(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, C.read(spark, sf_dir, "benchmark"), columns=["doc_id"]).select("row.doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = f"""
WITH {_CRC_TABLE},
docs AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
bench AS (SELECT {_WORDS.format('text')} AS w FROM benchmark),
voc AS (SELECT g, hex(encode(g)) AS h FROM (SELECT unnest(w) AS g FROM docs UNION SELECT unnest(w) AS g FROM bench)),
buckets AS (SELECT g, {_CRC.format(h='h')} % 10000 AS b FROM voc, crc),
s AS (SELECT b, count(*) AS n FROM (SELECT unnest(w) AS g FROM docs) JOIN buckets USING (g) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM (SELECT unnest(w) AS g FROM bench) JOIN buckets USING (g) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * ((SELECT sum(n) FROM s) + 10000)
  / ((CAST(s.n AS DOUBLE) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b)),
mean AS (SELECT doc_id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(w) AS g FROM docs)
  JOIN buckets USING (g) JOIN gain USING (b) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN mean USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n >= 20)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN CAST(rank AS BIGINT) END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


QUERIES = {f.__name__: f for f in (
    op1_html_extract, op2_decontaminate, op3_chat_format, op4_license_scan, op5_jaccard_join, op6_quality,
    op7_suffix_dedup, op8_mix_sources, op9_url_filter, op10_secret_scan, op11_conversation_repair,
    op12_language_id, op13_importance_resampling)}
ORACLE_SQL = {
    "op2_decontaminate": OP2_SQL,
    "op6_quality": OP6_SQL,
    "op8_mix_sources": OP8_SQL,
    "op9_url_filter": OP9_SQL,
    "op10_secret_scan": _op10_sql(),
    "op11_conversation_repair": _op11_sql(),
    "op13_importance_resampling": OP13_SQL,
}
