"""Licence scan: Aho-Corasick over notice phrases and identifier tags, and a shunting-yard parser for
``and`` / ``or`` / ``with`` expressions behind the tags.  Each row is scanned on its own, in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: The method's own phrases.
MORE = {"gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
        "mozilla public license": "mpl", "bsd license": "bsd", "eclipse public license": "epl",
        "creative commons attribution": "cc-by", "creative commons zero": "cc0", "all rights reserved": "proprietary",
        "public domain": "public-domain"}
TAG = "spdx license identifier"
#: How freely a text under a licence may be used, by the start of its name; else ``OTHER``.
FREEDOM = {"mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "unlicense": 1.0, "public-domain": 1.0, "cc-by-nc": 0.2,
           "cc-by-sa": 0.6, "cc-by": 0.9, "mpl": 0.7, "epl": 0.7, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.2, "proprietary": 0.0}
OTHER = 0.4
RANK = {"or": 1, "and": 2, "with": 3}

#: Bytes of words in lower case, all others as blanks.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_EXPR = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")


def freedom(name: str) -> float:
    starts = [k for k in FREEDOM if name.startswith(k)]
    return FREEDOM[max(starts, key=len)] if starts else OTHER


def parse(text: str) -> tuple[list[str], float] | None:
    """Licence names and freedom of the expression that ``text`` (lower case) starts with.  ``or`` leaves
    the choice (maximum), ``and`` binds to both (minimum), ``with`` adds an exception (half way to 1).
    Reading stops at the first token that cannot go on; a dangling operator or bracket is dropped.
    None if there is no licence name at the start."""
    ops: list[str] = []
    vals: list[float] = []
    names: list[str] = []

    def reduce() -> None:
        op, b, a = ops.pop(), vals.pop(), vals.pop()
        vals.append(max(a, b) if op == "or" else min(a, b) if op == "and" else a + (1 - a) / 2)

    want, at = True, 0  # want: an operand comes next
    for m in _TOKEN.finditer(text):
        if text[at:m.start()].strip():
            break
        tok, at = m.group(), m.end()
        if want and tok == "(":
            ops.append(tok)
        elif want and tok not in RANK and tok != ")":
            if not (ops and ops[-1] == "with"):
                names.append(tok)
            vals.append(freedom(tok))
            want = False
        elif not want and tok in RANK:
            while ops and ops[-1] != "(" and RANK[ops[-1]] >= RANK[tok]:
                reduce()
            ops.append(tok)
            want = True
        elif not want and tok == ")" and "(" in ops:
            while ops[-1] != "(":
                reduce()
            ops.pop()
        else:
            break
    if not vals:
        return None
    while want and ops and ops[-1] != "(":  # operators without a right side
        ops.pop()
        want = False
    ops[:] = [o for o in ops if o != "("]
    while ops and len(vals) > 1:
        reduce()
    return names, vals[-1]


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for p, label in MORE.items():
        a.add_word(f" {p} ", ("more", label, len(p) + 1))
    for p, label in BASE.items():
        a.add_word(f" {p} ", ("base", label, len(p) + 1))
    a.add_word(f" {TAG} ", ("tag", "", len(TAG) + 1))
    a.make_automaton()
    return a


def scan_one(raw: bytes | None, a) -> tuple:
    ws = (raw or b"").translate(WORD_BYTES).split()
    line = b" " + b" ".join(ws) + b" "
    n_base, first, last, base, labels, values, tag = 0, None, None, set(), set(), [], False
    for end, (kind, label, back) in a.iter(line.decode("latin-1")):
        if kind == "tag":
            tag = True
            continue
        labels.add(label)
        if kind == "base":
            base.add(label)
            n_base += 1
            start = end - back
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
    values += [freedom(x) for x in labels]
    if tag:
        for m in _EXPR.finditer(raw.lower()):
            if got := parse(m.group(1).decode("utf-8", "replace")):
                labels.update(got[0])
                values.append(got[1])
    word = lambda at: None if at is None else line.count(b" ", 0, at)
    return (len(ws), n_base, word(first), word(last), ",".join(sorted(base)), ",".join(sorted(labels)),
            min(values) if values else 0.0)


_LONG, _STR = T.LongType(), T.StringType()
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("n_words", _LONG), ("n_base", _LONG), ("first_word", _LONG), ("last_word", _LONG),
    ("base_labels", _STR), ("labels", _STR), ("score", T.DoubleType()))])
FIELDS = SCHEMA.fieldNames()


_AUTOMATON: list = []  # one a worker


@F.pandas_udf(SCHEMA)
def _scan(text: pd.Series) -> pd.DataFrame:
    a = _AUTOMATON[0] if _AUTOMATON else _AUTOMATON.append(automaton()) or _AUTOMATON[0]
    out = pd.DataFrame([scan_one(x, a) for x in text], columns=FIELDS)
    return out.astype({"first_word": "Int64", "last_word": "Int64"})


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``
    and ``score``: the least freedom of all that is found (every licence binds), 0 if nothing is.

    A null or empty text has no words, no places (null first and last) and empty labels.  Overlapping
    places all count.  Rows are independent; repeated rows and empty tables need no care.  Columns of
    ``docs`` with these names are replaced.
    """
    (found,) = C.fresh(docs, "found")
    d = docs.withColumn(found, _scan(F.col(f"`{text_col}`").cast("binary")))
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in FIELDS]
    return d.select(*keep, *[F.col(f"`{found}`.{c}").alias(c) for c in FIELDS])
