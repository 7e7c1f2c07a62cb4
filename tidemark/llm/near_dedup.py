"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full sets.

A document's set holds its distinct shingles of ``width`` words, 2 unless stated (A-Z lower-cased,
words are runs without ASCII white space); with fewer words the whole sequence is one shingle,
without words the set is empty and linked with nothing. Documents link with Jaccard similarity of 0.8 or more.

Tables. Two small collections of ``SIDE`` half keys, each of two minhashes, give SIDE * SIDE
table keys (u_i, v_j): 64 tables of 4 minhashes for the cost of 32 minhashes instead of 256.
At similarity 0.8 a half key agrees with probability 0.64, so a pair is missed by all tables
with probability of about 2 * 0.36 ** 8 = 0.0006, and at 0.9 with about 3e-6.

Candidates. Equal sets are one node from the start. In each table key the member that meets
most others is its hub; members are first compared with the hub only. What stays in different
components within a key is then compared pair by pair in blocks, where parity bitmaps give an
upper bound of the overlap that loses no link; only pairs that pass it are confirmed. So a
group of thousands of copies costs rows in proportion, and no pair is left out. A table key or
component may hold a third of all documents: what is counted for it combines before the shuffle
and comes back by key and seat (``SEATS`` of them, dealt by the document's name), so its members
never meet in one task.

Long texts. A text is hashed whole by one task; memory grows with its words (about 40 bytes each).
Columns other than doc_id and text take no part, whatever their names; ``kept_documents`` returns
them unchanged. An empty table gives an empty result.

Nulls and repeats. A null text has no words. A null doc_id takes part, but never names a
component; a component of such rows only has a null component_id and is kept. Each row is a
document of its own, even if its doc_id repeats; equal rows give equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stage, worker_cache

SIDE = 8
PER_HALF = 2
WIDTH = 2
BLOCK = 1024
#: Names of candidates (8 bytes each) that are broadcast to pick out their texts; more are joined
#: by a shuffle of the texts.
BROADCAST_ROWS = 1 << 20
NUMERATOR, DENOMINATOR = 80, 100
#: Parts into which the members of one key are dealt in joins by key; bits of a long.
SEATS = 64
#: Word hashes kept per task; the cache is emptied when full, which changes no result.
CACHE = 1 << 18
_MASK48 = (1 << 48) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over arrays."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words."""

    def __init__(self, width: int = WIDTH) -> None:
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        known = self.known
        if len(known) > CACHE:
            known.clear()
        codes = list(map(known.get, words))
        if None in codes:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            codes = list(map(known.__getitem__, words))
        h = np.array(codes, dtype=np.uint64)
        if len(h) < 2:
            return _mix(h + np.uint64(1))
        width = min(self.width, len(h))
        runs = h[: len(h) - width + 1]
        for at in range(1, width):
            runs = _mix(runs * np.uint64(0xD6E8FEB86659FD93) + h[at : at + len(runs)] + np.uint64(7))
        if width < self.width:  # a short text's only shingle is none of a longer text's
            runs = _mix(runs + np.uint64(width))
        runs.sort()
        return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def _shingler(width: int) -> Shingler:
    return worker_cache(f"shingler-{width}", lambda: Shingler(width))


def _multipliers() -> np.ndarray:
    seeds = np.arange(1, 2 * SIDE * PER_HALF + 1, dtype=np.uint64)
    return _mix(seeds * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def _minima(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least product with each factor; a slice at a time, so that products stay in cache."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 1024):
        best = np.minimum(best, (factors[:, None] * shingles[None, at : at + 1024]).min(axis=1))
    return best


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each cell; about four cells a shingle, a power of two."""
    bits = max(6, int(np.ceil(np.log2(max(1, len(shingles)) * 4))))
    cells = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    parity = (np.bincount(cells, minlength=1 << bits) & 1).astype(np.uint8)
    return np.packbits(parity)


def _sketcher(width: int):
    shingler, factors = _shingler(width), _multipliers()
    salts = np.arange(1, SIDE + 1, dtype=np.uint64)

    def work(columns: list) -> list:
        rid, doc_id, texts = columns
        n, first, second, us, vs, maps = [], [], [], [], [], []
        for text in texts:
            s = shingler(text)
            n.append(len(s))
            digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            first.append(int.from_bytes(digest[:8], "little", signed=True))
            second.append(int.from_bytes(digest[8:], "little", signed=True))
            if not len(s):
                us.append(None)
                vs.append(None)
                maps.append(None)
                continue
            mins = _minima(s, factors).reshape(2, SIDE, PER_HALF)
            halves = _mix(_mix(mins[:, :, 0]) + mins[:, :, 1] * np.uint64(0x8EBC6AF09C88C6E3) + salts)
            us.append(halves[0].view(np.int64).tolist())
            vs.append(halves[1].view(np.int64).tolist())
            maps.append(bitmap(s).tobytes())
        return [rid, doc_id, n, first, second, us, vs, maps]

    return work


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return map_rows(
        rows, lambda: _sketcher(width),
        "rid bigint, doc_id bigint, n bigint, f1 bigint, f2 bigint, u array<bigint>, v array<bigint>, bits binary",
    )


def _setter(width: int):
    shingler = _shingler(width)

    def work(columns: list) -> list:
        rid, texts = columns
        return [rid, [pack(shingler(t)) for t in texts]]

    return work


def pack(shingles: np.ndarray) -> bytes:
    """Sorted distinct 48-bit values, six bytes each."""
    low = np.unique(shingles & np.uint64(_MASK48))
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view("<u8").reshape(-1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="mergesort")
    common = int((both[1:] == both[:-1]).sum())
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _verifier():
    def work(columns: list) -> list:
        a, b, left, right = columns
        kept = [i for i in range(len(a)) if similar(unpack(left[i]), unpack(right[i]))]
        return [[a[i] for i in kept], [b[i] for i in kept]]

    return work


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names whose full sets are similar enough."""
    full = pairs.join(sets.select(F.col("rid").alias("a"), F.col("s").alias("sa")), "a").join(
        sets.select(F.col("rid").alias("b"), F.col("s").alias("sb")), "b"
    )
    return map_rows(full.select("a", "b", "sa", "sb"), _verifier, "a bigint, b bigint", rows=200)


def _seat() -> Column:
    return F.pmod(F.xxhash64("rid"), F.lit(SEATS)).cast("int")


def _seats() -> Column:
    """Aggregate: the seats that the rows of a group take, as bits of a long."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _seat())).alias("seats")


def by_seat(rows: DataFrame, found: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with one row a key, which holds ``_seats()``, on key and seat.

    An aggregate joined back on its own key cannot be split when a key dominates; here each of the
    seats of a key is a join key of its own.
    """
    taken = F.filter(F.sequence(F.lit(0), F.lit(SEATS - 1)), lambda i: F.bit_get("seats", i) == 1)
    dealt = found.withColumn("seat", F.explode(taken)).drop("seats")
    return rows.withColumn("seat", _seat()).join(dealt, [key, "seat"], how).drop("seat")


def components(edges: DataFrame) -> DataFrame:
    """(rid, label): the smallest name reachable, by alternating large and small stars.

    Every round is written to the shared folder; the number of rounds grows with the logarithm
    of the longest chain.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        small = stage(small, "small-star")
        before, edges = edges, small
        if before.count() == small.count() and before.join(small, ["a", "b"], "left_anti").isEmpty():
            return small.select(F.col("a").alias("rid"), F.col("b").alias("label"))


def _fold(data: np.ndarray, width: int) -> np.ndarray:
    """Rows of parity cells, folded to ``width`` cells: a coarser cell is the parity of its parts."""
    return np.bitwise_xor.reduce(data.reshape(len(data), width, -1), axis=2)


def possible(n_a, bits_a, n_b, bits_b) -> list[tuple[int, int]]:
    """Index pairs that the parity bitmaps cannot rule out.

    Each cell in which two bitmaps differ holds at least one element of one set only, so the
    overlap is at most (|a| + |b| - differing cells) / 2.
    """
    found = []
    groups_a, groups_b = _by_width(bits_a), _by_width(bits_b)
    n_a, n_b = np.asarray(n_a), np.asarray(n_b)
    for wa, (ia, xa) in groups_a.items():
        for wb, (ib, xb) in groups_b.items():
            if not wa // 2 <= wb <= wa * 2:  # sizes differ by a factor over 1.25 then
                continue
            width = min(wa, wb)
            left, right = _fold(xa, width), _fold(xb, width)
            left, right = np.packbits(left, axis=1).view(np.uint64), np.packbits(right, axis=1).view(np.uint64)
            for k, row in zip(ia, left):
                differ = np.bitwise_count(right ^ row).sum(axis=1).astype(np.int64)
                both = n_a[k] + n_b[ib]
                overlap = (both - differ) // 2
                overlap = np.minimum(overlap, np.minimum(n_a[k], n_b[ib]))
                for hit in ib[DENOMINATOR * overlap >= NUMERATOR * (both - overlap)]:
                    found.append((int(k), int(hit)))
    return found


def _by_width(bits: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    places: dict[int, list[int]] = {}
    for i, b in enumerate(bits):
        places.setdefault(len(b) * 8, []).append(i)
    return {
        w: (np.array(at), np.unpackbits(np.frombuffer(b"".join(bits[i] for i in at), dtype=np.uint8)).reshape(len(at), w))
        for w, at in places.items()
    }


def _block_pairs(group: pa.Table) -> pa.Table:
    """Pairs of one block pair of a table key that may be similar and lie in two components.

    A pair is given by the first table key that its members share only, so not once per table.
    That key is here too: keys with two members were compared as hub and member, and one whose
    members all lie in one component cannot hold the pair.
    """
    read = lambda name: group.column(name).to_numpy()
    rid, label, n, own = read("rid"), read("label"), read("n"), read("own")
    key, p, q = group.column("key")[0].as_py(), group.column("p")[0].as_py(), group.column("q")[0].as_py()
    u, v = (group.column(c).combine_chunks().flatten().to_numpy().reshape(-1, SIDE) for c in ("u", "v"))
    bits = group.column("bits").to_pylist()
    left = np.flatnonzero(own == p)
    right = left if p == q else np.flatnonzero(own == q)
    pairs = possible(n[left], [bits[i] for i in left], n[right], [bits[i] for i in right])
    out = set()
    if pairs:
        x, y = left[[i for i, _ in pairs]], right[[j for _, j in pairs]]
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        i, j = (u[x] == u[y]).argmax(axis=1), (v[x] == v[y]).argmax(axis=1)
        first = (u[x, i] ^ v[x, j]) == key
        out = {(min(a, b), max(a, b)) for a, b in zip(rid[x[first]].tolist(), rid[y[first]].tolist())}
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def with_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and the row's internal name rid, for every row."""
    known = stage(sketches(docs, width), "sketches")
    nodes = stage(
        known.where("n > 0").groupBy("f1", "f2").agg(
            F.min("rid").alias("rid"), F.min_by(F.struct("n", "u", "v", "bits"), "rid").alias("s"), F.min("doc_id").alias("least_id")
        ).select("rid", "f1", "f2", "s.*", "least_id"),
        "nodes",
    )
    keys = nodes.select(
        "rid",
        F.explode(
            F.flatten(F.transform("u", lambda x: F.transform("v", lambda y: x.bitwiseXOR(y))))
        ).alias("key"),
    )
    shared = keys.groupBy("key").agg(F.count("*").alias("members"), _seats()).where("members > 1")
    members = stage(by_seat(keys, shared, "key"), "members")
    degrees = members.groupBy("rid").agg(F.sum("members").alias("degree"))
    ranked = members.join(degrees, "rid")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", F.col("rid").alias("hub"))).alias("h"), _seats()).select("key", "h.hub", "seats")
    stars = stage(
        by_seat(members, hubs, "key").where("rid <> hub")
        .select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")).distinct(),
        "stars",
    )
    named = stage(stars.select(F.explode(F.array("a", "b")).alias("rid")).distinct(), "named")
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    wanted = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("rid"), F.col("text").cast("binary").alias("text")
    ).join(named, "rid", "left_semi")
    sets = stage(map_rows(wanted, lambda: _setter(width), "rid bigint, s binary").dropDuplicates(["rid"]), "sets")
    links = stage(verified(stars, sets), "links")
    label = components(links)

    labelled = members.where("members > 2").join(label, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    open_keys = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), _seats()).where("lo <> hi")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    dealt = (
        by_seat(labelled, open_keys.select("key", "seats"), "key", "left_semi")
        .join(nodes.select("rid", "n", "u", "v", "bits"), "rid")
        .withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "rid", "label", "n", "u", "v", "bits", "own", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    )
    more = stage(dealt.groupBy("key", "p", "q").applyInArrow(_block_pairs, "a bigint, b bigint").distinct().join(stars, ["a", "b"], "left_anti"), "more-pairs")
    more_links = stage(verified(more, sets), "more-links")
    if not more_links.isEmpty():
        label = components(links.unionByName(more_links))

    rooted = nodes.select("rid", "f1", "f2", "least_id").join(label, "rid", "left").withColumn("root", F.coalesce("label", "rid"))
    lowest = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), _seats())
    named = by_seat(rooted, lowest, "root").select("f1", "f2", "component_id")
    linked = known.where("n > 0").join(named, ["f1", "f2"]).select("rid", "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = known.where("n = 0").select("rid", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One document of each component, with all its columns; equal rows of one id stay together."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    keep = with_components(docs, width).where("kept").select("rid").distinct()
    rid = F.xxhash64(F.col(at["doc_id"]).cast("long"), F.col(at["text"]))
    return docs.toDF(*names).withColumn("rid", rid).join(keep, "rid", "left_semi").select(*names).toDF(*docs.columns)
