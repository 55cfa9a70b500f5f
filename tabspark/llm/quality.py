"""Quality rules as a short-circuit cascade.

Every rule is run on a bounded sample, which gives its cost (seconds) and its share of rejected rows.  Rules are tried
in the order of rejection per cost, so a row stops at its first failing rule.  The order changes the cost,
never the verdict.

Native: DataFrame and SQL functions only; no shuffle, everything happens in the row.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

# Fixed values of the base rules.
SPACE = " \\t\\n\\u000B\\u000C\\r"
SPACES = r"[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL condition over the measures

    def measures(self) -> list[str]:
        return [m for m in NAMES if re.search(rf"\b{m}\b", self.fails)]


#: The two base rules, and limits far from clean prose.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 60 * n_lines"),
    Rule("symbols", "100 * n_symbols > 60 * n_words AND 100 * n_symbols > 10 * word_chars"),
    Rule("word_length", "2 * word_chars < 3 * n_words OR word_chars > 40 * n_words"),
)
NAMES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text_col: str = "text", only=NAMES) -> DataFrame:
    """``docs`` plus the measures named in ``only``, computed over the whole text: ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines``, ``n_repeat_words``.

    A repeated 3-word window is found within the row: its (hash, position) pairs are sorted, equal
    neighbours are the repeats, and their positions, sorted again, are measured as a union of spans.
    Rows without a repeated hash skip the sorting.
    """
    t, w, l = C.fresh(docs, "t", "w", "l")
    d = docs.withColumn(t, F.expr(f"coalesce(`{text_col}`, '')"))
    if {"n_words", "n_repeat_words"} & set(only):
        d = d.withColumn(w, F.expr(f"array_remove(split(`{t}`, '{SPACES}'), '')"))
    if {"n_lines", "n_dup_lines"} & set(only):
        d = d.withColumn(l, F.expr(rf"filter(split(`{t}`, '\\n', -1), x -> translate(x, '{SPACE}', '') != '')"))
    hashes = f"transform(`{w}`, x -> xxhash64(x))"
    for _ in range(2):  # hashes of two, then of three words: two pairs that overlap
        m = "greatest(size(h) - 1, 0)"
        hashes = C.let("h", hashes, f"zip_with(slice(h, 1, {m}), slice(h, 2, {m}), (a, b) -> xxhash64(a, b))")
    pairs = "sort_array(transform(h, (x, i) -> struct(x as h, i as i)))"
    # equal neighbours in hash order; both positions of each such pair
    at = ("array_sort(array_distinct(flatten(filter(zip_with(slice(s, 1, size(s) - 1), slice(s, 2, size(s)), "
          "(a, b) -> CASE WHEN a.h = b.h THEN array(a.i, b.i) END), x -> x IS NOT NULL))))")
    union = (f"aggregate({at}, struct(0L as n, 0 as upto), (u, x) -> struct("
             "u.n + (x + 3 - greatest(u.upto, x)) as n, x + 3 as upto), u -> u.n)")
    exprs = {
        "n_repeat_words": C.let("h", hashes, "CASE WHEN size(array_distinct(h)) = size(h) THEN 0L "
                                f"ELSE {C.let('s', pairs, union)} END"),
        "n_words": f"CAST(size(`{w}`) AS BIGINT)",
        "word_chars": f"CAST(char_length(translate(`{t}`, '{SPACE}', '')) AS BIGINT)",
        "n_symbols": f"CAST(char_length(`{t}`) - char_length(translate(`{t}`, '{SYMBOLS}', '')) AS BIGINT)",
        "n_lines": f"CAST(size(`{l}`) AS BIGINT)",
        "n_dup_lines": f"CAST(size(`{l}`) - size(array_distinct(`{l}`)) AS BIGINT)",
    }
    return d.withColumns({k: F.expr(v) for k, v in exprs.items() if k in only}).drop(t, w, l)


def ordered_rules(docs: DataFrame, rules=RULES, sample_rows: int = 2000, text_col: str = "text") -> list[Rule]:
    """``rules`` by rejection per cost, both taken from at most ``sample_rows`` rows, which are picked by a hash of
    their place and written before any rule sees them.  The sample steers only the order; ties keep the given order, and an
    empty table keeps it whole."""
    n = docs.count()
    share = min(1.0, 1.2 * sample_rows / max(n, 1) + 1e-9)
    picked = docs.select(F.col(f"`{text_col}`").alias("text"), F.monotonically_increasing_id().alias("at"))
    picked = picked.where(f"pmod(xxhash64(at), 1000000007) < {share!r}D * 1000000007").select("text").limit(sample_rows)
    sample = C.written(picked.coalesce(1), "quality-sample")

    def tried(rule: Rule) -> tuple[float, float]:
        start = time.monotonic()
        got = measures(sample, only=rule.measures()).agg(F.expr(f"coalesce(avg(CAST({rule.fails} AS DOUBLE)), 0.0)")).first()[0]
        return got, time.monotonic() - start
    tried(rules[0])  # so that the first rule does not pay for the start of the first job
    worth = [share / (seconds + 1e-3) for share, seconds in map(tried, rules)]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-worth[i], i))]


def quality(docs: DataFrame, rules=RULES, sample_rows: int = 2000, text_col: str = "text") -> DataFrame:
    """``docs`` plus the measures, ``base_failed``, ``first_failed`` (the rule that stopped the cascade,
    or null) and ``kept``.  All measures are wanted here, so only conditions are skipped, behind the base rules; ``keep_good`` skips
    measures too.  A null or blank text has no words and fails ``few_words``.  Rows are judged
    one by one: repeated rows get equal verdicts, ties and empty tables need no care.  Columns of
    ``docs`` with the names of measures are replaced, all others stay."""
    cascade = "CASE " + " ".join(f"WHEN {r.fails} THEN '{r.name}'"
                                 for r in ordered_rules(docs, rules, sample_rows, text_col)) + " END"
    return (measures(docs, text_col)
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .withColumn("first_failed", F.expr(cascade))
            .withColumn("kept", F.expr("CASE WHEN base_failed THEN false ELSE first_failed IS NULL END")))


def keep_good(docs: DataFrame, rules=RULES, sample_rows: int = 2000, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, columns as they were.  Each rule is a filter of its
    own and reads only its own measures, so a rejected row costs nothing in the rules behind."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    for r in ordered_rules(docs, rules, sample_rows, text_col):
        d = measures(d, "text", r.measures()).where(f"NOT ({r.fails})").select("row", "text")
    return d.select("row.*")
