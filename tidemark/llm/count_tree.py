"""Exact set-similarity join of documents by R-trees over count vectors.

A document's set holds its distinct shingles of ``WIDTH`` words (A-Z lower-cased, words are runs
without ASCII white space); with fewer words the whole sequence is one shingle, without words the
set is empty and linked with nothing. Documents link when 100 * intersection >= 90 * union.

Points. Shingles are hashed into groups; a set's point is the vector of its group counts. The
overlap of two sets is at most the sum of the smaller counts, group by group, and so at most the
sum of the smaller upper corners of two boxes that hold them. Points have about half as many
groups as the set has shingles; boxes use the point folded to ``COARSE`` groups.

Trees. One tree over everything prunes little here: the counts of unrelated texts of one length
lie close together in every group, so at any level most boxes overlap. Points are therefore dealt
to a forest first, without losing a link. The smaller set of a linked pair has n shingles and the
sets differ in at most n / 9 of them, so of floor(n / 9) + 1 blocks of groups at least one has
equal counts in both. Each block with its counts names a tree; a point is an entry of about n / 9
trees, and unrelated texts share none. Sets of one size class have the same blocks; a point also
enters the trees of a lower class if a linked smaller set may lie there.

Search. A tree with two entries is that pair. In a larger one all entries are first held against
the entry that meets most others, so groups of copies join up in as many steps as they have
members. Trees whose entries still lie in several components are packed: entries sorted along a
Z-order curve of their counts fill pages of ``PAGE``, ``FANOUT`` nodes form a parent. Pairs of nodes are
descended level by level as joins and dropped by the corner bound, then pairs of points in
surviving page pairs by the point bound, and what is left is confirmed on full sets. Pairs that
lie in one component already are not looked at again; no pair is left out otherwise.

Handling. A null text has no words. A null doc_id takes part but never names a component; a
component of such rows only has a null component_id. Rows that repeat a doc_id are documents of
their own, equal rows give equal results, equal sets are one entry whatever their number. A very
long text gives entries in proportion to its length, one text at a time. Only doc_id and text are
read, so further columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, numbered, stage, worker_cache
from tidemark.llm.near_dedup import Shingler, components, pack, unpack

WIDTH = 3
NUMERATOR, DENOMINATOR = 90, 100
#: Groups of a block; about nine shingles fall into them.
CELLS = 64
COARSE = 32
PAGE = 512
FANOUT = 64
#: Least size of each class: sets below the first link with equal sets only.
CLASSES = [9, 18, 27, 36]
while CLASSES[-1] < 1 << 40:
    CLASSES.append(CLASSES[-1] * 4 // 3)
#: A count stored as one byte; the largest stands for any number.
FULL = 255
_UNBOUNDED = 1 << 24


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def size_classes(n: int) -> range:
    """Classes in whose trees a set of ``n`` shingles is entered."""
    if n < CLASSES[0]:
        return range(0)
    least = -(-NUMERATOR * n // DENOMINATOR)  # the smallest set it can link with
    return range(bisect_right(CLASSES, least) - 1, bisect_right(CLASSES, n))


def blocks(size_class: int) -> int:
    return (CLASSES[size_class + 1] - 1) // 9 + 1


def tree_names(shingles: np.ndarray) -> np.ndarray:
    """Names of the trees of a sorted set: one for each block of each of its classes."""
    names = []
    for c in size_classes(len(shingles)):
        m = blocks(c)
        cells = ((shingles >> np.uint64(32)) * np.uint64(m * CELLS)) >> np.uint64(32)
        ends = np.searchsorted(cells, np.arange(m + 1, dtype=np.uint64) * np.uint64(CELLS))
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(cells + np.uint64(1)), dtype=np.uint64)])
        block = np.arange(m, dtype=np.uint64) + np.uint64(c << 40)
        names.append(_mix(running[ends[1:]] - running[ends[:-1]] + _mix(block + np.uint64(1 << 60))))
    return np.concatenate(names) if names else np.zeros(0, np.uint64)


def groups(n: int) -> int:
    """Groups of the point of a set of ``n`` shingles, a power of two."""
    return max(COARSE, 1 << max(0, (n // 2 - 1).bit_length()))


def point(shingles: np.ndarray) -> np.ndarray:
    width = groups(len(shingles))
    counts = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.minimum(counts, FULL).astype(np.uint8)


def fold(points: np.ndarray, width: int) -> np.ndarray:
    """Counts of ``width`` groups from counts of more; a full count stays without bound."""
    wide = points.astype(np.int64)
    wide[points == FULL] = _UNBOUNDED
    return np.minimum(wide.reshape(len(points), -1, width).sum(axis=1), _UNBOUNDED)


def curve_place(shingles: np.ndarray) -> int:
    """Place on a Z-order curve: two bits of each of eight counts, relative to an even spread."""
    counts = np.bincount((shingles & np.uint64(7)).astype(np.int64), minlength=8)
    even = len(shingles) / 8
    level = np.clip(np.floor((counts - even) / np.sqrt(even) + 2), 0, 3).astype(int)
    place = 0
    for bit in (1, 0):
        for value in level:
            place = place * 2 + (int(value) >> bit & 1)
    return place


def _shingler() -> Shingler:
    return worker_cache(f"shingler-{WIDTH}", lambda: Shingler(WIDTH))


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _pointer():
    shingler = _shingler()

    def work(columns: list) -> list:
        out: list[list] = [[] for _ in range(6)]
        for text in columns[2]:
            s = shingler(text)
            row = (len(s), *_digest(s), curve_place(s) if len(s) else 0, tree_names(s).view(np.int64).tolist(), point(s).tobytes())
            for values, value in zip(out, row):
                values.append(value)
        return [columns[0], columns[1], *out]

    return work


def _handle() -> Column:
    """A row's handle, to find its text again; what it finds is checked by the set's digest."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def points(docs: DataFrame) -> DataFrame:
    rows = docs.select(_handle().alias("handle"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_rows(
        rows, _pointer,
        "handle bigint, doc_id bigint, n bigint, f1 bigint, f2 bigint, place int, trees array<bigint>, point binary",
    )


def _setter():
    shingler = _shingler()

    def work(columns: list) -> list:
        sets = [shingler(t) for t in columns[0]]
        digests = [_digest(s) for s in sets]
        return [[d[0] for d in digests], [d[1] for d in digests], [pack(s) for s in sets]]

    return work


def full_sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, s): the full sets of the named nodes, from one text each."""
    wanted = nodes.join(ids, "id", "left_semi").select("id", "handle", "f1", "f2")
    texts = docs.select(_handle().alias("handle"), F.col("text").cast("binary").alias("text"))
    found = map_rows(
        texts.join(wanted.select("handle").distinct(), "handle", "left_semi").select("text"), _setter, "f1 bigint, f2 bigint, s binary"
    )
    return wanted.join(found, ["f1", "f2"]).dropDuplicates(["id"]).select("id", "s")


def enough(overlap, total):
    """Whether sets of ``total`` shingles together may link with this overlap."""
    return DENOMINATOR * overlap >= NUMERATOR * (total - overlap)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="mergesort")
    return bool(enough(int((both[1:] == both[:-1]).sum()), len(both)))


def _bounder():
    def work(columns: list) -> list:
        kept = []
        for at, (na, pa_, nb, pb) in enumerate(zip(*columns[2:])):
            x, y = np.frombuffer(pa_, np.uint8), np.frombuffer(pb, np.uint8)
            width = min(len(x), len(y))
            if enough(int(np.minimum(fold(x[None], width), fold(y[None], width)).sum()), na + nb):
                kept.append(at)
        return [[columns[0][at] for at in kept], [columns[1][at] for at in kept]]

    return work


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of node ids that the point bound lets pass."""
    side = lambda name: nodes.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("point").alias(f"p{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "pa", "nb", "pb")
    return map_rows(both, _bounder, "a bigint, b bigint")


def _verifier():
    def work(columns: list) -> list:
        a, b, left, right = columns
        kept = [i for i in range(len(a)) if linked(unpack(left[i]), unpack(right[i]))]
        return [[a[i] for i in kept], [b[i] for i in kept]]

    return work


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of node ids whose full sets link."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("s").alias(f"s{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    return map_rows(both, _verifier, "a bigint, b bigint", rows=200)


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    left = stage(bounded(pairs, nodes), "tree-pairs")
    ids = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stage(full_sets(docs, nodes, ids), "tree-sets")
    return stage(verified(left, sets), "tree-links")


# ---- Packed trees -------------------------------------------------------------------------

PAGE_DDL = "tree bigint, page bigint, ids binary, labels binary, n binary, points binary, hi array<int>, least bigint"


def _page(group: pa.Table) -> pa.Table:
    """One leaf page: its entries and the upper corner of their box."""
    n = group.column("n").to_numpy()
    raw = group.column("point").to_pylist()
    coarse = np.concatenate([fold(np.frombuffer(p, np.uint8)[None], COARSE) for p in raw])
    pack_long = lambda name: group.column(name).to_numpy().astype("<i8").tobytes()
    hi = np.minimum(coarse.max(axis=0), _UNBOUNDED)
    return pa.table(
        {
            "tree": group.column("tree")[:1], "page": group.column("page")[:1],
            "ids": pa.array([pack_long("id")]), "labels": pa.array([pack_long("label")]), "n": pa.array([n.astype("<i8").tobytes()]),
            "points": pa.array([b"".join(raw)]), "hi": pa.array([hi.tolist()], pa.list_(pa.int32())), "least": pa.array([int(n.min())], pa.int64()),
        }
    )


class Page:
    """Entries of a stored page, as arrays."""

    def __init__(self, ids: bytes, labels: bytes, n: bytes, points_: bytes) -> None:
        self.ids, self.labels, self.n = (np.frombuffer(x, "<i8") for x in (ids, labels, n))
        widths = [groups(int(k)) for k in self.n]
        ends = np.cumsum([0, *widths])
        flat = np.frombuffer(points_, np.uint8)
        self.points = [flat[a:b] for a, b in zip(ends, ends[1:])]
        self.coarse = np.concatenate([fold(p[None], COARSE) for p in self.points]).astype(np.int32)


def page_pairs(left: Page, right: Page, same: bool) -> Iterator[tuple[int, int]]:
    """Ids of the entries of two pages that may link and lie in different components."""
    slab = 32
    for at in range(0, len(left.ids), slab):
        rows = slice(at, at + slab)
        corner, least = left.coarse[rows].max(axis=0), left.n[rows].min()
        near = np.flatnonzero(enough(np.minimum(corner, right.coarse).sum(axis=1), least + right.n))  # entries against a node's box
        if not len(near):
            continue
        overlap = np.minimum(left.coarse[rows, None, :], right.coarse[None, near, :]).sum(axis=2)
        may = enough(overlap, left.n[rows, None] + right.n[None, near]) & (left.labels[rows, None] != right.labels[None, near])
        for i, j in zip(*np.nonzero(may)):
            x, y = at + int(i), int(near[j])
            if same and y <= x:
                continue
            p, q = left.points[x], right.points[y]
            width = min(len(p), len(q))
            if width == COARSE or enough(int(np.minimum(fold(p[None], width), fold(q[None], width)).sum()), left.n[x] + right.n[y]):
                a, b = int(left.ids[x]), int(right.ids[y])
                yield (a, b) if a < b else (b, a)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            read = lambda s: Page(row[f"ids_{s}"], row[f"labels_{s}"], row[f"n_{s}"], row[f"points_{s}"])  # noqa: E731, B023
            same = row["page_a"] == row["page_b"]
            left = read("a")
            found = sorted(set(page_pairs(left, left if same else read("b"), same)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
            )


def _may_link(hi_a: str, hi_b: str, least_a: str, least_b: str) -> Column:
    overlap = F.aggregate(F.zip_with(hi_a, hi_b, lambda x, y: F.least(x, y).cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return DENOMINATOR * overlap >= NUMERATOR * (F.col(least_a) + F.col(least_b) - overlap)


def tree_search(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of entries (tree, id, label, n, place, point) that the bounds let pass.

    Entries are ordered by (tree, size, curve) with a range sort, so a tree of any size is dealt
    over many tasks, a page at most ``PAGE`` of its entries.
    """
    spark = entries.sparkSession
    placed = numbered(stage(entries, "tree-entries"), F.col("tree"), F.col("n"), F.col("place"), F.col("id"), name="position")
    first = placed.groupBy("tree", F.crc32(F.col("tree").cast("string")).alias("spread")).agg(F.min("position").alias("first"))
    dealt = placed.join(first.drop("spread"), "tree").withColumn("page", F.floor((F.col("position") - F.col("first")) / PAGE))
    pages = stage(
        dealt.select("tree", "page", "id", "label", "n", "point").repartition("tree", "page").groupBy("tree", "page").applyInArrow(_page, PAGE_DDL), "tree-pages"
    )
    levels = [pages.select("tree", F.col("page").alias("node"), "hi", "least")]
    top = pages.agg(F.max("page")).first()[0]  # one number
    while top:
        corner = F.array(*[F.max(F.col("hi")[i]) for i in range(COARSE)]).alias("hi")
        below = levels[-1]
        levels.append(stage(below.groupBy("tree", F.floor(F.col("node") / FANOUT).alias("node")).agg(corner, F.min("least").alias("least")), "tree-level"))
        top //= FANOUT
    pairs = levels[-1].select("tree", F.col("node").alias("a"), F.col("node").alias("b"))
    for nodes in reversed(levels[:-1]):  # as many rounds as the tree has levels
        child = lambda s: nodes.select(
            "tree", F.floor(F.col("node") / FANOUT).alias(s), F.col("node").alias(f"node_{s}"),  # noqa: B023
            F.col("hi").alias(f"hi_{s}"), F.col("least").alias(f"least_{s}"),
        )
        met = pairs.join(child("a"), ["tree", "a"]).join(child("b"), ["tree", "b"]).where("node_a <= node_b")
        may = (F.col("node_a") == F.col("node_b")) | _may_link("hi_a", "hi_b", "least_a", "least_b")
        pairs = stage(met.where(may).select("tree", F.col("node_a").alias("a"), F.col("node_b").alias("b")), "tree-node-pairs")
    names = ("page", "ids", "labels", "n", "points")
    side = lambda s: pages.select("tree", F.col("page").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in names])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = pairs.join(side("a"), ["tree", "a"]).join(side("b"), ["tree", "b"]).repartition(parts)
    return met.mapInArrow(_search, "a bigint, b bigint").distinct()


# ---- The join -----------------------------------------------------------------------------


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def with_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row."""
    known = stage(points(docs), "points")
    nodes = stage(
        known.where("n > 0").groupBy("f1", "f2").agg(
            F.min("handle").alias("handle"), F.min_by(F.struct("n", "place", "trees", "point"), "handle").alias("s")
        ).select(F.monotonically_increasing_id().alias("id"), "handle", "f1", "f2", "s.*"),
        "points-distinct",
    )
    entries = nodes.select("id", F.explode("trees").alias("tree"))
    # grouped by a second name that follows from the first, so that the join below shuffles both
    # sides and a tree with very many entries can be split
    spread = F.crc32(F.col("tree").cast("string")).alias("spread")
    trees = stage(
        entries.groupBy("tree", spread).agg(F.count("*").alias("members"), F.min("id").alias("a"), F.max("id").alias("b")).where("members > 1"),
        "trees",
    )
    members = stage(entries.join(trees.where("members > 2").select("tree", "members"), "tree"), "tree-members")
    degrees = members.groupBy("id", F.crc32(F.col("id").cast("string")).alias("spread")).agg(F.sum("members").alias("degree"))
    hubs = (
        members.join(degrees.drop("spread"), "id").groupBy("tree", spread)
        .agg(F.max(F.struct("degree", F.col("id").alias("hub"))).alias("h")).select("tree", "h.hub")
    )
    stars = members.join(hubs, "tree").where("id <> hub").select(*_pair("id", "hub"))
    pairs = stage(stars.unionByName(trees.where("members = 2").select("a", "b")).distinct(), "tree-stars")
    links = _links(docs, nodes, pairs)
    label = components(links)

    labelled = members.join(label.withColumnRenamed("rid", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    still = labelled.groupBy("tree", spread).agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("tree")
    rest = labelled.join(still, "tree").select("tree", "id", "label").join(nodes.select("id", "n", "place", "point"), "id")
    more = stage(tree_search(rest).join(pairs, ["a", "b"], "left_anti"), "tree-found")
    if not more.isEmpty():
        label = components(links.unionByName(_links(docs, nodes, more)))

    root = nodes.select("id", "f1", "f2").join(label.withColumnRenamed("rid", "id"), "id", "left").select("f1", "f2", F.coalesce("label", "id").alias("root"))
    placed = known.where("n > 0").select("doc_id", "n", "f1", "f2").join(root, ["f1", "f2"])
    lowest = placed.groupBy("root", F.crc32(F.col("root").cast("string")).alias("spread")).agg(F.min("doc_id").alias("component_id")).drop("spread")
    joined = placed.join(lowest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone)
