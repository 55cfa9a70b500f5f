"""Main text of web pages: markup first, then a suffix array per host for what markup cannot tell.

Pages are parsed into text blocks without furniture (menus, footers, adverts, forms, comments ...).  The
token streams of a host's pages form its suffix array: suffixes are ordered by their first ``DEPTH`` tokens,
and equal ones of distinct pages (pages of the same tokens are one) are repeated runs.  No shorter prefix counts;
a run may cross blocks.  Of every ``DEPTH`` tokens one prefix of ``GRAM`` at least is sampled by content (the smallest hash of
neighbours).  Those on enough pages of their host are candidates, and around them all places are compared.  The
array is dealt over the cluster by (host, prefix), with counts made before the shuffle, so a large host is many groups.

A run on more than half of its host's pages is boilerplate and goes from all of them.  Any other on two
pages or more goes outside articles from all but one of them, so that an article under two addresses is kept
once; inside an article so does one on more than a quarter of the host's pages, as articles may quote others.  So does a run on just two pages, one of which consists of such runs for the most part.
Just the compared tokens go.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .hashing import Sums, mix
from .suffix_dedup import slide
from .urls import parts

DEPTH = 12  # tokens of the shortest run
GRAM = 6  # tokens of a sampled prefix
#: Of a run on n pages: most of its host's have it; and enough for it to be no quotation inside an article.
COMMON = "2 * n > pages"
COMMON_INSIDE = "4 * n > pages"

# Element names by role, and words in class, id or role that mark furniture.
RAW = {"script", "style", "template", "textarea", "title", "iframe", "svg", "select"}
DROP = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "header"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "button", "object",
          "math", "mi", "mn", "mo", "mrow", "mfrac", "msup", "msub", "msubsup", "msqrt", "mroot", "mtext", "mstyle", "mover", "munder", "semantics"}
FURNITURE = frozenset("ad ads advert adverts advertisement sponsor sponsored banner promo cookie cookies consent notice gdpr popup modal overlay sidebar side "
                      "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments replies disqus social share sharing related "
                      "recommended newsletter subscribe signup login search widget skip pagination pager toolbar complementary contentinfo alert".split())
#: Readers' comments go even where each of them is an article.
COMMENTS = frozenset("comment comments replies disqus".split())
#: Elements of running text, and the words that mark one of them in an article; others there (share, alert, related) are its subject.
TEXT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
STRONG = frozenset("ad ads advert adverts advertisement sponsor sponsored promo cookie cookies consent notice gdpr newsletter subscribe "
                   "breadcrumb breadcrumbs comment comments".split())
#: Parts of a name that may stand beside such words: site-footer is furniture, has-sidebar and menu-page are layouts.
BESIDE = frozenset("site main top bottom left right primary secondary global box bar list container block section item items area form links link "
                   "buttons button icons icon posts post articles article inner outer thread text message google sticky mobile desktop the my js "
                   "slot unit wrapper wrap widgets row panel title toggle".split())
MOST_WORDS = 25  # of an element that may be most of a page's text
_PART = re.compile(r"[_-]+")
MAIN_MARK = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|post|entry)(?:$|[\s_-])", re.I)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>?", re.S)
_ATTR = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements that end an open paragraph, and those that close others of their kind when left open.
_CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}


@functools.lru_cache(100_000)
def _furniture(marks: str, words: frozenset = FURNITURE) -> bool:
    """Whether a name in class, id or role holds one of ``words`` and consists of furniture words, and of words that may stand beside them."""
    for mark in marks.lower().split():
        found = [x for x in _PART.split(mark.strip("_-")) if not x.isdigit()]
        if not words.isdisjoint(found) and all(x in FURNITURE or x in BESIDE for x in found):
            return True
    return False


def blocks(page: str | None) -> list[tuple[bool, str]]:
    """(in an article, text) of each block that is no furniture, in page order.  White space is folded,
    character references are decoded, empty blocks are left out.

    An element that a name marks as furniture keeps the article elements in it, unless it is in an article itself, and is
    kept as a whole if it has most of the text of a page that has no article; readers' comments go in either case. In an
    article a paragraph or heading is furniture by few names only (``STRONG``)."""
    page, out, text, stack = page or "", [], [], []  # stack: (name, dropped, in an article, marks that drop it)
    dropped, main = False, 0  # main: 1 by a mark of html or body, 2 in an article
    marked: tuple[int, ...] = ()
    at = 0

    def end() -> None:
        t = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if t:
            out.append((main, t, marked))

    for m in iter(lambda: _TAG.search(page, at), None):
        if not dropped:
            text.append(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        closing, attrs = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if not name:
            continue
        if name in RAW:
            if not closing and not attrs.endswith("/"):
                stop = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = stop.end() if stop else len(page) if name in ("script", "style", "textarea", "title") else at
            continue
        if name in INLINE and not (_furniture(" ".join(map("".join, _ATTR.findall(attrs)))) if attrs else False) and not any(s[0] == name for s in stack):
            continue
        if not dropped:
            if name == "br":
                text.append(" ")
            else:
                end()
        if name in VOID or attrs.endswith("/"):
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "body") and name not in ("body", "html"):
                    break  # a stray end tag does not close the article around it
        else:
            if name in _CLOSES and stack and stack[-1][0] in _CLOSES[name]:
                stack.pop()
                _, dropped, main, marked = stack[-1] if stack else ("", False, 0, ())
            marks = " ".join(map("".join, _ATTR.findall(attrs))) if attrs else ""
            named = bool(marks) and _furniture(marks, STRONG if main == 2 and name in TEXT else FURNITURE)
            article = name in ("article", "main") or bool(marks and not named and MAIN_MARK.search(marks))
            gone = name in DROP and not (name == "header" and main)
            by = marked
            if name in ("article", "main"):
                by = by if main == 2 or named else tuple(k for k in by if k < 0)
            elif named and name not in ("html", "body"):
                by = (*by, -at if _furniture(marks, COMMENTS) else at)  # below zero: what no article in it resets
            stack.append((name, dropped or gone, max(main, article and (1 if name in ("html", "body") else 2)), by))
        _, dropped, main, marked = stack[-1] if stack else ("", False, 0, ())
    if not dropped:
        text.append(page[at:])
    end()
    return _kept(out)


def _kept(found: list[tuple[int, str, tuple[int, ...]]]) -> list[tuple[bool, str]]:
    """The blocks that no mark drops."""
    kept = [(m > 0, t) for m, t, by in found if not by]
    if len(kept) < len(found) and not any(m == 2 for m, _, by in found if not by):
        size, total = Counter(), 0
        for _, t, by in found:
            n = len(t.split())
            total += n
            size.update(dict.fromkeys(by, n))
        most = {k for k, n in size.items() if k >= 0 and n >= MOST_WORDS and 2 * n > total}
        if most:
            kept = [(m > 0, t) for m, t, by in found if most.issuperset(by)]
    return kept


class Tokens:
    """The token stream of a page, over the borders of its blocks."""

    def __init__(self, found: list[tuple[bool, str]]):
        toks = [t.encode("utf-8", "surrogatepass").split() for _, t in found]
        self.line = b" ".join(x for t in toks for x in t) + b" "
        self.sums = Sums(self.line)
        self.end = np.flatnonzero(np.frombuffer(self.line, dtype=np.uint8) == 32)
        if not found:
            self.end = self.end[:0]
        self.n = len(self.end)
        self.start = np.concatenate([[0], self.end[:-1] + 1]) if self.n else self.end
        self.main = np.repeat(np.array([m for m, _ in found], dtype=bool), [len(t) for t in toks])

    def prefixes(self, depth: int) -> np.ndarray:
        """The hash of the ``depth`` tokens at each place that has as many."""
        if self.n < depth:
            return np.zeros(0, dtype=np.uint64)
        size = self.end[depth - 1:] - self.start[: self.n - depth + 1]
        return mix(self.sums.hashes(self.start[: self.n - depth + 1], size) + size.astype(np.uint64))

    def outside(self, depth: int) -> np.ndarray:
        """True for the places whose ``depth`` tokens are not all in an article."""
        out = np.concatenate([[0], np.cumsum(~self.main)])
        return out[depth:] > out[:-depth] if self.n >= depth else np.zeros(0, dtype=bool)

    def prints(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the sampled prefixes: one at least in any ``DEPTH`` tokens."""
        h = self.prefixes(GRAM)
        if self.n < DEPTH:
            return np.zeros(0, dtype=np.int64), h[:0]
        width = DEPTH - GRAM + 1
        low = slide(h, width, np.minimum)
        pad = np.zeros(width - 1, dtype=np.uint64)
        at = np.flatnonzero(h == slide(np.concatenate([pad, low, pad]), width, np.maximum))
        return at, h[at]

    def spread(self, at: np.ndarray, back: int, to: int, size: int) -> np.ndarray:
        """True for the places of ``size`` from ``back`` before one of ``at`` up to ``to`` after it."""
        mark = np.zeros(size + 1, dtype=np.int64)
        np.add.at(mark, np.maximum(at - back, 0), 1)
        np.add.at(mark, np.minimum(at + to, size), -1)
        return np.cumsum(mark[:-1]) > 0

    def gone(self, every, once, inside) -> np.ndarray:
        """True for the tokens that go: those of the runs ``every``, and of the runs ``once`` that share no token
        with them (a word beside a notice may be the same on two pages); in an article those of ``inside`` only."""
        g = self.prefixes(DEPTH).view(np.int64)
        e, o, i = (np.isin(g, np.array(x or [], dtype=np.int64)) for x in (every, once, inside))
        o &= ~self.spread(np.flatnonzero(e), DEPTH - 1, DEPTH, len(g))
        hit = e | o
        return (self.spread(np.flatnonzero(hit), 0, DEPTH, self.n) & ~self.main) | self.spread(np.flatnonzero(hit & i), 0, DEPTH, self.n)


def _identities(batches):
    """(hh, th, tt): pages of one ``tt`` have the same tokens."""
    for batch in batches:
        hh, th, tt = [], [], []
        for t, h, page in zip(*(batch.column(k).to_pylist() for k in range(3))):
            x = Tokens(blocks(page))
            if x.n >= DEPTH:
                hh.append(h), th.append(t), tt.append(int.from_bytes(hashlib.blake2b(x.line, digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (hh, th, tt)], ["hh", "th", "tt"])


def _distinct(host, th, h, *flags):
    g, inv = np.unique(h, return_inverse=True)
    out = [np.full(len(g), host, dtype=np.int64), g.view(np.int64), np.full(len(g), th, dtype=np.int64)]
    for f in flags:
        most = np.zeros(len(g), dtype=np.int32)
        np.maximum.at(most, inv, f.astype(np.int32))
        out.append(most)
    return out


def _emitted(rows, names):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], names)


def _prints(batches):
    """(host, g, th, body): the distinct sampled prefixes of each page; body: one may belong to a run outside an article."""
    for batch in batches:
        rows = []
        for th, host, page in zip(*(batch.column(k).to_pylist() for k in range(3))):
            t = Tokens(blocks(page))
            at, h = t.prints()
            if len(at):
                near = t.spread(np.flatnonzero(~t.main), DEPTH - 1, DEPTH, t.n)
                rows.append(_distinct(host, th, h, near[at]))
        if rows:
            yield _emitted(rows, ["host", "g", "th", "body"])


def _runs(batches):
    """(host, g, th, body, mostly): the distinct runs of ``DEPTH`` tokens around the given prefixes of each page,
    at all places; body: one is not all in an article; mostly: such runs cover more than half of the page."""
    for batch in batches:
        rows = []
        for th, host, page, given in zip(*(batch.column(k).to_pylist() for k in range(4))):
            t = Tokens(blocks(page))
            at, h = t.prints()
            at = at[np.isin(h.view(np.int64), np.array(given, dtype=np.int64))]
            g = t.prefixes(DEPTH)
            here = t.spread(at, DEPTH - GRAM, 1, len(g))
            mostly = 2 * t.spread(np.flatnonzero(here), 0, DEPTH, t.n).sum() > t.n
            rows.append(_distinct(host, th, g[here], t.outside(DEPTH)[here], np.full(here.sum(), mostly)))
        if rows:
            yield _emitted(rows, ["host", "g", "th", "body", "mostly"])


def clean(found: list[tuple[bool, str]], every, once, inside) -> list[str]:
    """The blocks' texts without the tokens of repeated runs."""
    if not found or not (every or once):
        return [t for _, t in found]
    gone = Tokens(found).gone(every, once, inside)
    out, at = [], 0
    for _, text in found:
        n = len(text.encode("utf-8", "surrogatepass").split())
        here = gone[at:at + n]
        at += n
        out.append(b" ".join(x for x, g in zip(text.encode("utf-8", "surrogatepass").split(), here) if not g).decode("utf-8", "surrogatepass") if here.any() else text)
    return [x for x in out if x]


def _texts(batches):
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        text = ["\n\n".join(clean(blocks(page), *lists)) for page, *lists in zip(*cols[2:6])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())],
                                         ["id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``url_col``, ``text`` (empty if there is none) and ``n_chars``.

    ``id_col`` is an integer.  A null or empty page has an empty text.  A null URL belongs to the host ''.
    Equal pages of a host, repeated rows among them, are one page to the suffix array and get equal texts.  Empty
    tables give empty results.  Other columns are not read.
    """
    d = parts(pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("page")), "url")
    d = d.select("id", "url", "page", F.expr("xxhash64(host)").alias("hh"), F.expr("xxhash64(page)").alias("th"))
    lists = ("every", "once", "inside")
    rows = "host bigint, g bigint, th bigint, body int"
    texts = C.written(d.select("th", "hh", "page").mapInArrow(_identities, "hh bigint, th bigint, tt bigint"), "html-pages")
    same = texts.groupBy("hh", "tt").agg(F.min("th").alias("lead"), F.count("*").alias("c"))
    hosts = same.groupBy(F.col("hh").alias("host")).agg(F.count("*").alias("pages"))
    # one page of each text: those that are alone as they are, one of the others
    several = C.written(texts.join(same.where("c > 1"), ["hh", "tt"]).select("hh", "th", "lead").distinct(), "html-copies")
    copies = C.small_side(several.select("hh", "th"), 500_000)
    leads = C.small_side(several.selectExpr("hh", "lead AS th").distinct(), 500_000)
    one = d.select("th", "hh", "page")
    one = one.join(copies, ["hh", "th"], "left_anti").unionByName(one.join(leads, ["hh", "th"], "left_semi").dropDuplicates(["hh", "th"]))

    # sampled prefixes that are on enough pages for a run around them to be judged as repeated, and those runs at all places
    prints = one.select("th", "hh", "page").mapInArrow(_prints, rows)
    many = prints.groupBy("host", "g").agg(F.count("*").alias("n"), F.max("body").alias("body")).where("n >= 2")
    many = C.written(many.join(hosts, "host").where(f"body = 1 OR {COMMON_INSIDE}").select("host", "g"), "html-candidates")
    given = (prints.select("host", "g", "th").join(C.small_side(many), ["host", "g"]).groupBy(F.col("host").alias("hh"), "th")
             .agg(F.collect_set("g").alias("given")))
    given = C.written(given, "html-given")
    around = (one.join(C.small_side(given.select("hh", "th"), 500_000), ["hh", "th"], "left_semi").join(given, ["hh", "th"])
              .select("th", "hh", "page", "given").mapInArrow(_runs, rows + ", mostly int"))
    judged = (around.groupBy("host", "g").agg(F.count("*").alias("n"), F.max("body").alias("body"), F.max("mostly").alias("mostly"), F.min("th").alias("first"))
              .where("n >= 2").join(hosts, "host")
              .select("host", "g", "first", F.expr(f"{COMMON} AND NOT (n = 2 AND mostly = 1)").alias("all"), F.expr(COMMON_INSIDE).alias("inside"), "body")
              .where("inside OR body = 1"))
    judged = C.written(judged, "html-repeated")
    hits = (around.select("host", "g", "th").join(C.small_side(judged), ["host", "g"]).where("all OR th != first").groupBy("host", "th")
            .agg(*(F.expr(f"collect_set(g) FILTER (WHERE {k})").alias(x) for x, k in zip(lists, ("all", "NOT all", "inside")))))
    hits = C.written(hits.select(F.col("host").alias("hh"), "th", *lists), "html-hits")
    # pages of one text lose the same
    alike = several.where("th != lead").join(hits.withColumnRenamed("th", "lead"), ["hh", "lead"]).select("hh", "th", *lists)
    hits = hits.unionByName(alike)
    at = ["hh", "th"]
    keys = C.small_side(hits.select(*at), 500_000)
    none = F.expr("cast(null as array<bigint>)")
    cols = ("id", "url", "page", *lists)
    rest = d.join(keys, at, "left_anti").select("id", "url", "page", *(none.alias(x) for x in lists))
    touched = d.join(keys, at, "left_semi").join(hits, at).select(*cols)
    out = [x.mapInArrow(_texts, "id bigint, url string, text string, n_chars bigint") for x in (rest, touched)]
    return out[0].unionByName(out[1]).withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
