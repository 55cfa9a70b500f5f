"""N-gram Jaccard join by chosen paths.

The set of a text is its word shingles.  A run sends each set down a path: at every level a hash function
of the run and level picks the set's smallest token, and sets that picked the same tokens share a
bucket.  Two sets of Jaccard similarity s stay together over d levels with probability s ** d.  A bucket
that is small is compared by brute force; a larger one is split at the next level.  Runs are repeated
until a pair at the threshold is found with the target recall even at the deepest level.

- Texts of one set are one class beforehand, so exact copies cost nothing further.
- A bucket that is still large at the deepest level (near copies that no token separates) is dealt out as pairs
  of blocks, so that a task holds two blocks at most; nothing is dropped.
- A pair is judged in the first run in which it meets, first by sketches, then by the whole sets.  Tasks return
  a set's number of links and links that span its bucket's components; pairs are never rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .hashing import Sums, mix
from .licenses import WORD_BYTES

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
LEVELS = 3
SMALL = 128  # sets of a bucket that is compared by brute force, and of a block
SKETCH = 32
#: Least equal sketch values: at the threshold a true pair has fewer with probability 1e-6.
SKETCH_EQUAL = 14


def runs_for(similarity: float = SIMILARITY, recall: float = RECALL, levels: int = LEVELS) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**levels))


_SEEDS = np.random.default_rng(5).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes | None) -> np.ndarray:
    """The sorted hashes of the distinct shingles of WORDS words; one of all words if there are fewer."""
    line = b" ".join((text or b"").translate(WORD_BYTES).split())
    if not line:
        return np.zeros(0, dtype=np.uint64)
    gap = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    start, end = np.concatenate([[0], gap + 1]), np.concatenate([gap, [len(line)]])
    k = min(WORDS, len(start))
    start, size = start[: len(start) - k + 1], end[k - 1:] - start[: len(start) - k + 1]
    return np.unique(mix(Sums(line).hashes(start, size) + size.astype(np.uint64)))


def _picked(s: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed's function, the smallest hash of the set's tokens."""
    return np.array([mix(s * k).min() for k in seeds], dtype=np.uint64)


def _describe(runs: int):
    def work(batches):
        for batch in batches:
            out = []
            for i, th, text in zip(*(batch.column(k) for k in range(3))):
                s = shingles(text.as_py())
                if not len(s):
                    out.append((i.as_py(), th.as_py(), None, 0, None, None))
                    continue
                low = _picked(s, _SEEDS[: SKETCH + runs * LEVELS])
                sketch, tokens = low[:SKETCH].astype(np.uint16), low[SKETCH:].reshape(runs, LEVELS)
                paths, at = np.empty((runs, LEVELS), dtype=np.uint64), np.arange(1, runs + 1, dtype=np.uint64)
                for v in range(LEVELS):
                    at = paths[:, v] = mix((at * _SEEDS[-1]) ^ tokens[:, v])
                out.append((i.as_py(), th.as_py(), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), len(s), sketch.tobytes(),
                            paths.view(np.int64).tolist()))
            if out:
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["id", "th", "key", "n", "sketch", "paths"])
    return work


def _groups(batches):
    """The rows of a sorted partition, one whole (bucket, i, j) group at a time, as a pyarrow table."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        ids = np.stack([t.column(c).to_numpy() for c in ("bucket", "i", "j")])
        cut = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
        start = 0
        for c in cut:
            yield t.slice(start, c - start)
            start = c
        rest = t.slice(start)
    if rest is not None and rest.num_rows:
        yield rest


def _owned_pairs(g: pa.Table):
    """Row numbers (a, b) of the pairs of a group that meet here first and may be similar enough."""
    n = g.num_rows
    size = g.column("n").to_numpy()
    order = np.argsort(size, kind="stable")
    size = size[order]
    sketch = np.frombuffer(b"".join(g.column("sketch").to_pylist()), dtype=np.uint16).reshape(n, SKETCH)[order]
    leaf = np.array(g.column("leaves").to_pylist(), dtype=np.int64)[order]
    run, cross = g.column("r")[0].as_py(), g.column("i")[0].as_py() != g.column("j")[0].as_py()
    side = g.column("side").to_numpy()[order]
    upto = np.searchsorted(size, np.floor(size / SIMILARITY + 1e-9), "right")
    left, right = [], []
    for a in range(n - 1):
        b = np.arange(a + 1, upto[a])
        if cross:
            b = b[side[b] != side[a]]
        b = b[(sketch[b] == sketch[a]).sum(axis=1) >= SKETCH_EQUAL] if len(b) else b
        if len(b):
            same = (leaf[b] == leaf[a]) & (leaf[a] != 0)
            b = b[same.argmax(axis=1) == run]
            left.append(np.full(len(b), a))
            right.append(b)
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return order[np.concatenate(left)], order[np.concatenate(right)]


_GROUP = ["bucket", "i", "j"]


def _needed(batches):
    """The rows of each group that take part in a pair to be judged."""
    for g in _groups(batches):
        if g.num_rows > 1:
            a, b = _owned_pairs(g)
            if len(a):
                yield from g.take(pa.array(np.unique(np.concatenate([a, b])))).combine_chunks().to_batches()


def _similar(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """True for the pairs at the threshold: sizes of the intersections by blocks of shared tokens."""
    tokens, col = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.bincount(col, minlength=len(tokens)) > 1
    new = np.cumsum(shared) - 1
    keep = shared[col]
    row, col = row[keep], new[col[keep]]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for lo in range(0, int(shared.sum()), 4096):
        part = slice(*np.searchsorted(col, [lo, lo + 4096]))
        m = np.zeros((len(sets), 4096), dtype=np.float32)
        m[row[part], col[part] - lo] = 1
        both += m @ m.T
    size = np.array([len(s) for s in sets])
    common = np.rint(both[a, b]).astype(np.int64)
    return common >= SIMILARITY * (size[a] + size[b] - common) - 1e-9


def _judge(batches):
    """(key, root, links): each set's links in a group, and a set that stands for its component there."""
    for g in _groups(batches):
        a, b = _owned_pairs(g)
        ok = _similar([np.frombuffer(x, dtype=np.uint64) for x in g.column("tokens").to_pylist()], a, b)
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        links = np.bincount(np.concatenate([a, b]), minlength=g.num_rows)
        root = np.arange(g.num_rows)
        while True:  # the smallest row number spreads along the links
            low = np.minimum(root[a], root[b])
            was = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == was).all():
                break
        at = np.flatnonzero(links)
        key = g.column("key").combine_chunks()
        yield pa.RecordBatch.from_arrays([key.take(pa.array(at)), key.take(pa.array(root[at])), pa.array(links[at])], ["key", "root", "links"])


def components(edges: DataFrame) -> DataFrame:
    """(key, root) for the nodes of ``edges`` (a, b): large-star and small-star steps, each written,
    until nothing changes.  A node's least neighbour is an aggregate, written, so that the join that takes it to the node's
    edges has plain shuffles on both sides, which Spark splits where a node has very many edges."""
    e = C.written(edges.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").where("a != b").distinct(), "links")
    while True:
        both = e.unionByName(e.selectExpr("b AS a", "a AS b"))
        low = C.written(both.groupBy("a").agg(F.expr("least(min(b), a)").alias("m")), "links")
        big = both.join(low, "a").where("b > a").selectExpr("m AS a", "b")  # larger neighbours to the smallest one
        big = C.written(big.where("a != b").distinct(), "links")
        low = C.written(big.groupBy("b").agg(F.min("a").alias("m")), "links")
        small = big.join(low, "b").selectExpr("m AS a", "a AS b").unionByName(low.selectExpr("m AS a", "b"))
        small = C.written(small.where("a != b").distinct(), "links")
        if not small.exceptAll(e).limit(1).count() and not e.exceptAll(small).limit(1).count():
            return small.selectExpr("b AS key", "a AS root")
        e = small


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``class_id`` (the smallest id of the texts that links
    connect), ``n_links`` (other shingle sets at the threshold; a set's exact copies are no links),
    ``n_same`` (rows of the same set, itself included) and ``_text_hash``.

    ``id_col`` is an integer.  Null and empty texts, and those without a word, are classes of their
    own (``class_id`` the own id, 0 links, 1 same).  Repeated rows are copies.  Null ids take part; a class of null ids
    only has a null id.  Empty tables give empty results.  Other columns are not read.
    """
    return _classes(docs, id_col, text_col).drop("_root")


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``join`` with ``_root``: the key of the class itself, as a repeated or null id names none (null without words)."""
    runs = runs_for()
    d = docs.select(F.col(id_col).cast("bigint").alias("id"), F.expr(f"xxhash64({text_col})").alias("th"), F.col(text_col).cast("binary").alias("text"))
    each = C.written(d.mapInArrow(_describe(runs), "id bigint, th bigint, key binary, n int, sketch binary, paths array<array<bigint>>"), "join-texts")
    sets = C.written(each.where("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("id", "th")).alias("rep"), F.count("*").alias("n_same"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "join-sets")

    # buckets: down the levels as long as they are large
    at = sets.select("key", F.expr("posexplode(paths)").alias("r", "p"))
    leaves = None
    for v in range(LEVELS):
        at = at.withColumn("bucket", F.expr(f"p[{v}]"))
        count = C.written(at.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1"), "join-counts")  # a plain side for the join: hot buckets are split
        at = C.written(at.join(count, "bucket"), "join-buckets")
        small = at.where(f"c <= {SMALL}") if v < LEVELS - 1 else at
        small = small.select("key", "r", "bucket", "c")
        leaves = small if leaves is None else leaves.unionByName(small)
        at = at.where(f"c > {SMALL}").select("key", "r", "p")
    slots = f"transform(sequence(0, {runs - 1}), r -> coalesce(try_element_at(m, r), 0L))"
    own = (leaves.groupBy("key").agg(F.expr("map_from_entries(collect_list(struct(r, bucket)))").alias("m"),
                                     F.expr("map_from_entries(collect_list(struct(r, c)))").alias("sizes"))
           .select("key", F.expr(slots).alias("leaves"), "sizes")
           .join(sets.select("key", "n", "sketch"), "key"))
    # blocks of a large bucket: each pair of blocks is a group
    rows = (own.select("key", "n", "sketch", "leaves", F.expr("explode(sizes)").alias("r", "c"))
            .withColumn("bucket", F.expr("leaves[r]")).withColumn("nb", F.expr(f"cast(ceil(c / {SMALL}) as int)"))
            .withColumn("x", F.expr("cast(pmod(xxhash64(key), nb) as int)"))
            .withColumn("y", F.expr("explode(sequence(0, nb - 1))"))
            .select("bucket", F.expr("least(x, y)").alias("i"), F.expr("greatest(x, y)").alias("j"), F.expr("x <= y").cast("int").alias("side"),
                    "r", "key", "n", "sketch", "leaves"))
    kind = "bucket bigint, i int, j int, side int, r int, key binary, n int, sketch binary, leaves array<bigint>"
    need = C.written(rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_needed, kind), "join-needed")

    # whole sets of those that have a pair to be judged
    reps = need.select("key").distinct().join(sets.select("key", "rep"), "key").selectExpr("rep.id AS rid", "rep.th AS rth", "key")
    reps = C.small_side(C.written(reps, "join-reps"))

    def tokens(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x.as_py()).tobytes() for x in batch.column(1)], pa.binary())], ["key", "tokens"])

    whole = (d.join(reps, F.expr("id <=> rid AND th <=> rth")).select("key", "text").mapInArrow(tokens, "key binary, tokens binary")
             .dropDuplicates(["key"]))
    judged = C.written(need.join(whole, "key").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
                       .mapInArrow(_judge, "key binary, root binary, links bigint"), "join-judged")
    links = judged.groupBy("key").agg(F.sum("links").alias("n_links"))
    comp = components(judged.selectExpr("key AS a", "root AS b"))
    info = (sets.select("key", "n_same").join(links, "key", "left").join(comp, "key", "left")
            .selectExpr("key", "n_same", "coalesce(n_links, 0L) AS n_links", "coalesce(root, key) AS root"))
    info = C.written(info, "join-info")
    firsts = C.written(each.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id")).join(info.select("key", "root"), "key")
                       .groupBy("root").agg(F.min("id").alias("class_id")), "join-firsts")  # plain, as the sets of a large class are split
    info = info.join(firsts, "root").select("key", "root", "class_id", "n_links", "n_same")
    got = each.where("key IS NOT NULL").select("id", "th", "key").join(info, "key").selectExpr("id", "class_id", "n_links", "n_same", "th", "root AS _root")
    alone = each.where("key IS NULL").selectExpr("id", "id AS class_id", "0L AS n_links", "1L AS n_same", "th", "cast(null as binary) AS _root")
    return got.unionByName(alone).withColumnRenamed("id", id_col).withColumnRenamed("th", "_text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (null last, then text hash).  Rows
    without words stay; columns stay as they are."""
    cls = C.written(_classes(docs, id_col, text_col).where("_root IS NOT NULL").selectExpr(f"{id_col} AS _id", "_text_hash AS _th", "_root"), "join-classes")
    rows = cls.groupBy("_root", "_id", "_th").agg(F.count("*").alias("c"))
    # rows of one id and text are of one class, so that its first row tells by these alone who stays
    lead = C.written(rows.groupBy("_root").agg(F.min(F.struct(F.expr("_id IS NULL").alias("no_id"), "_id", "_th", "c")).alias("best"))
                     .selectExpr("best._id AS _lead", "best._th AS _lead_th", "best.c AS c"), "join-leads")
    i, h = C.fresh(docs, "id", "th")
    gone = rows.join(lead, F.expr("_id <=> _lead AND _th = _lead_th"), "left_anti").selectExpr(f"_id AS `{i}`", f"_th AS `{h}`")
    gone = C.small_side(C.written(gone, "join-gone"), 500_000)
    same = F.expr(f"`{id_col}` <=> `{i}` AND xxhash64(`{text_col}`) = `{h}`")
    out = docs.join(gone, same, "left_anti")
    twice = lead.where("c > 1").selectExpr(f"_lead AS `{i}`", f"_lead_th AS `{h}`")
    if twice.limit(1).count():  # one row of rows that are equal in id and text
        twice = C.small_side(twice, 500_000)
        one = out.join(twice, same, "left_semi").withColumn(h, F.expr(f"xxhash64(`{text_col}`)")).dropDuplicates([id_col, h]).drop(h)
        out = out.join(twice, same, "left_anti").unionByName(one)
    return out
