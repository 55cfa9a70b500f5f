"""Links of the n-gram Jaccard join over a whole given table, against an exact prefix-filter join.

``RECALL_SF_DIR`` names another table folder; ``-s`` shows the measured recall."""

import collections
import math
import os

from conftest import SF01
from tabspark.llm import common as C
from tabspark.llm import jaccard_join as J


def true_links(sets):
    """Number of links of each set: pairs that share a token among the rarest ones that a similar pair must share, judged exactly."""
    rare = collections.Counter(t for s in sets for t in s)
    at, links = collections.defaultdict(list), collections.Counter()
    order = sorted(sets, key=len)
    for i, s in enumerate(order):
        head = sorted(s, key=lambda t: (rare[t], t))[: len(s) - math.ceil(J.SIMILARITY * len(s) - 1e-9) + 1]
        for j in {j for t in head for j in at[t]}:
            both = len(s & order[j])
            if both >= J.SIMILARITY * (len(s) + len(order[j]) - both) - 1e-9:
                links[s] += 1
                links[order[j]] += 1
        for t in head:
            at[t].append(i)
    return links


def test_recall_of_all_links(spark):
    docs = C.read(spark, os.environ.get("RECALL_SF_DIR", SF01), "documents")
    of = {r.doc_id: frozenset(J.shingles(r.text.encode() if r.text else None).tolist()) for r in docs.select("doc_id", "text").collect()}
    links = true_links({s for s in of.values() if s})
    got = {of[r.doc_id]: r.n_links for r in J.join(docs).collect() if of[r.doc_id]}
    assert all(n <= links[s] for s, n in got.items())  # no link that is none
    found, due = sum(got.values()) // 2, sum(links.values()) // 2
    print(f"links {due}, found {found}, sets with links {len(links)}, complete {sum(got[s] == n for s, n in links.items())}")
    assert due and found >= 0.99 * due
