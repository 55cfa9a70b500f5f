"""Secret scan: three base patterns, and candidate strings of high windowed entropy.

Native: DataFrame and SQL functions only, no shuffle.  ``split`` and ``regexp_extract_all`` scan a text
alike, so the pieces between the matches and the matches themselves give each match's place as a
running sum of lengths (in code points).  Running sums are taken block by block (``common.prefix``), so a
text full of matches costs no more for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base patterns in the order of their kinds, and the least lengths.
ASSIGN = ("(" + "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key"))) +
          r")[\"\']?\x20*[:=]\x20*[\"\']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # the greedy run of AKIA[A-Z0-9]+, 20 characters or more
HEX = "[0-9a-f]{24,}"  # the greedy run of [0-9a-f]+, 24 characters or more

#: The method: candidates, window, and the least entropy (bits a character) by character class.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASSES = (("hex", "^[0-9a-fA-F]+$", 3.0), ("base64", "", 3.9))
#: Where a candidate is cut into segments, which are tested one by one: a sample word that is a part of its own, a run of
#: six or more equal characters, and three or more dividing ones.
_JOINT = "[/_=+-]"
DIVIDER = (f"(?:^|{_JOINT})(?:[eE][xX][aA][mM][pP][lL][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD][eE][rR]|[xX]{{4,}})(?:{_JOINT}|$)|"
           + "|".join(f"{c}{{6,}}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") + f"|{_JOINT}{{3,}}")
#: A segment is no secret if it matches one of these: letters only (words), digits only, path or snake
#: case of plain words, and samples that say so.
ALLOW = (r"^[A-Za-z]+$", r"^[0-9]+$", r"^[A-Za-z]*([/_=+-]+[A-Za-z]*)*$", r"(?i)example|placeholder|xxxx")
KINDS = ("assign", "access", "hex", "entropy")


def _lit(pattern: str) -> str:
    """A pattern as an SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(text: str, pattern: str, kind: int, measure: str | None = None, group: int = 0) -> str:
    """SQL: an array of structs (at, kind, to, s) of all matches of ``pattern``; s is ``group``."""
    p = _lit(pattern)
    found = f"zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1), (m, a) -> struct(m AS m, char_length(a) AS gap, coalesce(char_length(m), 0) AS len))"
    starts = C.let("f", found, f"zip_with(filter(f, x -> x.m IS NOT NULL), {C.prefix('transform(f, x -> x.gap + x.len)', '{0} + {1}', '0')}, "
                   f"(x, at) -> struct(at + x.gap AS at, {kind} AS kind, at + x.gap + x.len AS to, x.m AS s))")
    starts = f"filter({starts}, x -> x.s IS NOT NULL)"  # the last piece has no match behind it
    if group:
        starts = f"zip_with({starts}, regexp_extract_all({text}, {p}, {group}), (x, g) -> struct(x.at as at, x.kind as kind, x.to as to, g as s))"
    return starts if measure is None else f"filter({starts}, x -> {measure})"


def _entropy(s: str, width: int) -> str:
    """SQL: the largest Shannon entropy (bits a character) of the windows of ``width`` characters in
    ``s``.  The fold keeps the counts of the characters in the window and the sum of c * log2(c); a
    character that enters or leaves changes one count and that one term of the sum."""
    chars = f"split({s}, '')"
    f = "(CASE WHEN {0} > 0 THEN {0} * log2({0}) ELSE 0D END)"
    up = f"({f.format('(c + 1)')} - {f.format('c')})"
    down = f"({f.format('(d - 1)')} - {f.format('d')})"
    count = "coalesce(try_element_at({m}, {k}), 0D)"
    add = "map_concat(map_filter({m}, (k, v) -> k != {k}), map({k}, {v}))"
    # s.m: counts; s.t: sum of c * log2(c); s.e: largest entropy so far
    enter = (f"element_at(transform(array({count.format(m='s.m', k='x.i')}), c -> struct("
             f"{add.format(m='s.m', k='x.i', v='c + 1D')} as m, s.t + {up} as t, s.e as e)), 1)")
    leave = (f"element_at(transform(array({count.format(m='s.m', k='x.o')}), d -> struct("
             f"{add.format(m='s.m', k='x.o', v='d - 1D')} as m, s.t + {down} as t, s.e as e)), 1)")
    step = (f"element_at(transform(array(CASE WHEN x.o IS NULL THEN s ELSE {leave} END), s -> {enter}), 1)")
    final = f"(log2({width}D) - s.t / {width}D)"
    return (f"aggregate(zip_with({chars}, concat(array_repeat(cast(null as string), {width}), "
            f"slice({chars}, 1, greatest(char_length({s}) - {width}, 0))), (i, o) -> struct(i as i, o as o)), "
            "struct(cast(map() as map<string,double>) as m, 0D as t, 0D as e), "
            f"(s, x) -> element_at(transform(array({step}), s -> struct(s.m as m, s.t as t, "
            f"greatest(s.e, CASE WHEN aggregate(map_values(s.m), 0D, (a, v) -> a + v) >= {width}D THEN {final} ELSE 0D END) as e)), 1), "
            "s -> s.e)")


def _is_secret(s: str) -> str:
    """SQL: whether a segment of ``s`` is a secret."""
    return f"exists(split({s}, {_lit(DIVIDER)}, -1), s -> char_length(s) >= {WINDOW} AND {_segment('s')})"


def _segment(s: str) -> str:
    allowed = " OR ".join(f"{s} RLIKE {_lit(p)}" for p in ALLOW)
    rule = "CASE " + " ".join(f"WHEN {s} RLIKE {_lit(p)} THEN {e}" for _, p, e in CLASSES) + " END"
    return f"CASE WHEN {allowed} THEN false ELSE {_entropy(s, WINDOW)} >= {rule} END"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``secret_spans``: an array of (at, kind, to), sorted; ``kind`` indexes ``KINDS``,
    ``at`` and ``to`` count code points, ``to`` exclusive.

    A null or empty text has no spans.  Base spans may overlap those of other kinds; an entropy span is
    left out where one base span holds all of it.  Rows are independent, so repeated rows, ties and empty
    tables need no care.  A column ``secret_spans`` of ``docs`` is replaced, all others stay as they are.
    Time and memory are in proportion to a text's length and its number of spans.
    """
    none = "cast(array() as array<struct<at:int,kind:int,to:int,s:string>>)"
    t, found, spans = C.fresh(docs, "t", "found", "spans")

    def if_any(pattern, spans):
        return f"CASE WHEN `{t}` RLIKE {_lit(pattern)} THEN {spans} ELSE {none} END"

    d = docs.withColumn(t, F.expr(f"coalesce(`{text_col}`, '')"))
    every = (f"concat({if_any(ASSIGN, _spans(t, ASSIGN, 0, f'char_length(x.s) >= {ASSIGN_LEAST}', 2))}, "
             f"{if_any(ACCESS, _spans(t, ACCESS, 1))}, {if_any(HEX, _spans(t, HEX, 2))}, "
             f"{if_any(CANDIDATE, _spans(t, CANDIDATE, 3, _is_secret('x.s')))})")
    d = d.withColumn(found, F.expr(f"sort_array(transform({every}, x -> struct(x.at as at, x.kind as kind, x.to as to)))"))
    # the furthest end of the base spans that start no later: base kinds sort before entropy
    ends = C.prefix(f"transform(`{found}`, x -> if(x.kind < 3, x.to, 0))", "greatest({0}, {1})", "0")
    d = d.withColumn(spans, F.expr(f"transform(filter(zip_with(`{found}`, {ends}, (x, m) -> struct(x AS x, m AS m)), "
                                   "s -> s.x.kind < 3 OR s.x.to > s.m), s -> s.x)"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != "secret_spans"]
    return d.select(*keep, F.col(spans).alias("secret_spans"))


def joined(spans: str) -> str:
    """SQL: spans as kind:start:end, comma-joined."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({kinds}), x.kind + 1), x.at, x.to)), ',')"


PIECE = 1024  # code points


def mask(docs: DataFrame, text_col: str = "text", by: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``by``; other columns as they
    were, ``n_chars`` (if there) counted anew for changed texts."""
    row, text, spans, ends, pieces, done = C.fresh(docs, "row", "text", "spans", "ends", "pieces", "done")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{text_col}`").alias(text))
    d = scan(d, text).withColumnRenamed("secret_spans", spans)
    some = f"size(`{spans}`) > 0"
    d = d.withColumn(ends, F.expr(C.prefix(f"transform(`{spans}`, x -> x.to)", "greatest({0}, {1})", "0")))
    # the text in pieces of equal length, so that no cut walks over all that is before it
    d = d.withColumn(pieces, F.expr(f"CASE WHEN {some} THEN regexp_extract_all(`{text}`, '(?s).{{1,{PIECE}}}', 0) END"))

    def part(start, end):
        inside = f"array_join(slice(`{pieces}`, {start} div {PIECE} + 1, {end} div {PIECE} - {start} div {PIECE} + 1), '')"
        return f"substring({inside}, {start} % {PIECE} + 1, {end} - {start})"
    cut = f"transform(zip_with(`{spans}`, `{ends}`, (x, m) -> struct(x AS x, m AS m)), s -> if(s.x.at >= s.m, concat({part('s.m', 's.x.at')}, '{by}'), ''))"
    last = f"aggregate(`{spans}`, 0, (m, x) -> greatest(m, x.to))"
    tail = C.let("z", last, part("z", f"char_length(`{text}`)"))
    d = d.withColumn(done, F.expr(f"CASE WHEN {some} THEN concat(array_join({cut}, ''), {tail}) ELSE `{text}` END"))
    cols = []
    for c in docs.columns:
        own = F.col(f"`{row}`.`{c}`")
        if c == text_col:
            own = F.col(done)
        elif c == "n_chars":
            own = F.expr(f"CASE WHEN {some} THEN CAST(char_length(`{done}`) AS BIGINT) ELSE `{row}`.n_chars END")
        cols.append(own.alias(c))
    return d.select(*cols)
