"""Exact top-k by inner product with a pivot table.

Components x become floor(64 * x), as double, then integers; the score is their inner product.
Distances from every vector to ``PIVOTS`` fixed vectors are computed once. For a query q and a
candidate x the triangle inequality gives |d(q, p) - d(x, p)| <= d(q, x) for each pivot p; the
largest of these bounds the distance from below and so the score from above:

    score = (|q|^2 + |x|^2 - d(q, x)^2) / 2

Candidates are evaluated in the order of that bound, and a query stops when the next bound is
below its k-th score, so results are exact; equal bounds are evaluated, as ties go to the smaller
id. Bounds carry a margin for rounding.

Pivots are vectors of the data (for the commonest length; other lengths have fixed directions).

Distribution. Vectors are packed into blocks of about ``BLOCK`` rows, dealt by row, so that an id on very
many rows spreads like any other. Candidate blocks stay where they are. Queries come in waves of as
many blocks as fit into ``WAVE_BYTES``; a wave is broadcast, every task holds it against its own candidate
blocks one after the other and keeps each query's best k so far. Those rule out later candidates, and whole
blocks whose pivot distances lie too far away. A task sends k rows a query, which meet under a
row-number limit. Work is the stated queries against all rows, in blocks.

Large components. Floats are exact for vectors shorter than 2**26 once scaled. Pairs with a longer
one are picked by float scores with an error bound and scored in whole numbers. A component or a
resulting score beyond the long range is an error.

Nulls and repeats. Vectors that are null, empty, or hold a null or a non-finite component take no
part, nor do null ids. Vectors only meet vectors of their length. Rows that repeat an id are rows of
their own: a query row is matched with every row but those of its own id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage

K = 20
EVERY = 20
SCALE = 64
PIVOTS = 32
BLOCK = 4096
#: Size of the query blocks that are broadcast together.
WAVE_BYTES = 64 << 20
STEP = 128
#: Squared lengths below this: products of two such vectors are exact as doubles.
USUAL = 2.0**52
LONG = 1 << 63


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id and integer components of the vectors that take part."""
    def whole(x: Column) -> Column:
        wide = F.floor(x.cast("double") * F.lit(float(SCALE)))
        fits = F.abs(x.cast("double") * F.lit(float(SCALE))) < F.lit(float(LONG))
        return F.when(fits, wide).otherwise(F.raise_error(F.lit("a component leaves the long range once scaled")).cast("long"))

    usable = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    )
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def pivots(dims: int) -> np.ndarray:
    """Fixed directions with entries of +-``SCALE``; any points serve as pivots."""
    rng = np.random.default_rng(dims)
    return rng.choice([-float(SCALE), float(SCALE)], size=(PIVOTS, dims)) / np.sqrt(dims)


def best_wide(query_id: int, query, norm_q: float, ids, vectors, norms, k: int = K) -> list[tuple[int, int]]:
    """(-score, id) of the best k candidates, in whole numbers of any size.

    Float scores are off by at most ``slack``; only candidates that may be among the best are
    scored again exactly.
    """
    other = np.flatnonzero(ids != query_id)
    about = vectors[other].astype(np.float64) @ query.astype(np.float64)
    slack = (len(query) + 4) * 2.0**-52 * np.sqrt(norm_q) * np.sqrt(norms[other])
    if len(other) > k:
        least = np.partition(about - slack, len(other) - k)[len(other) - k]
        other = other[about + slack >= least]
    scores = vectors[other].astype(object) @ query.astype(object) if len(other) else []
    return sorted(zip((-int(x) for x in scores), ids[other].tolist()))[:k]


def data_pivots(rows: DataFrame) -> tuple[int, list[list[int]]]:
    """The commonest length and ``PIVOTS`` vectors of it, by a hash of the vector."""
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return 0, []
    order = F.xxhash64(F.lit("pivot"), F.col("v"))
    chosen = rows.where(F.size("v") == common["dims"]).select("v", order.alias("h")).orderBy("h", "v").limit(PIVOTS)
    return common["dims"], [row["v"] for row in chosen.collect()]  # PIVOTS vectors


def search_any(query_ids, queries, query_table, ids, vectors, table, k: int = K, known=None):
    """(query position, ids, scores, scores below the long range) of the best k of each query in one block.

    ``known`` has the best (ids, scores) of each query so far, which then are candidates too; it may
    be given where no vector is longer than usual.
    """
    length = lambda v: np.square(v.astype(np.float64)).sum(1)
    norms_q, norms = length(queries), length(vectors)
    usual_q, usual = np.flatnonzero(norms_q < USUAL), np.flatnonzero(norms < USUAL)
    wide = np.flatnonzero(norms >= USUAL)
    rest = (ids[wide], vectors[wide], norms[wide])
    found = iter(())
    if len(usual_q) and len(usual):
        part = lambda v, at: v if len(at) == len(v) else v[at]
        found = search_block(
            query_ids[usual_q], part(queries, usual_q).astype(np.float64), part(query_table, usual_q),
            ids[usual], part(vectors, usual).astype(np.float64), part(table, usual), k,
            known,
        )
    if len(usual_q) == len(queries) and not len(wide):
        yield from ((row, best_ids, best.astype(np.int64), np.zeros(len(best), bool)) for row, best_ids, best in found)
        return
    near = {int(usual_q[row]): list(zip((-best.astype(np.int64)).tolist(), best_ids.tolist())) for row, best_ids, best in found}
    for row in range(len(queries)):
        against = rest if norms_q[row] < USUAL else (ids, vectors, norms)
        best = sorted(near.get(row, []) + best_wide(query_ids[row], queries[row], norms_q[row], *against, k))[:k]
        if best and -best[0][0] >= LONG:
            raise OverflowError(f"a score of query {query_ids[row]} leaves the long range")
        under = np.array([low > LONG for low, _ in best], dtype=bool)
        yield row, np.array([i for _, i in best], dtype=np.int64), np.array([max(-low, -LONG) for low, _ in best], dtype=np.int64), under


def search_block(query_ids, queries, query_table, ids, vectors, table, k: int = K, known=None):
    """(query position, id, score) of the best k candidates of each query in one block, ``known`` ones included.

    A query whose known k-th score no vector of the block can reach, by the block's intervals of pivot
    distances, gets nothing evaluated.
    Pivot distances are compared as single floats, less a slack above their rounding. Scores are
    single floats only where every sum stays below 2**24 and is exact.
    """
    norms_q, norms = (queries * queries).sum(1), (vectors * vectors).sum(1)
    kind = np.float32 if norms_q.max() * norms.max() < 2.0**48 else np.float64
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    slack = np.float32(max(table.max(), query_table.max()) * 2.0**-21)
    by_pivot, query_table = np.ascontiguousarray(table.T, dtype=np.float32), query_table.astype(np.float32)
    apart = np.empty_like(by_pivot)
    near, far = by_pivot.min(axis=1), by_pivot.max(axis=1)
    outside = np.maximum(np.maximum(near - query_table, query_table - far).max(axis=1) - slack, 0).astype(np.float64)
    reach = (norms_q + norms.max() - outside * outside) / 2 + 1e-6 * (norms_q + norms.max()) + 1e-6
    for row in range(len(queries)):
        start = known[row] if known is not None else None
        if start is not None and len(start[0]) == k and reach[row] < start[1][-1]:
            yield row, start[0], start[1]
            continue
        np.abs(np.subtract(by_pivot, query_table[row][:, None], out=apart), out=apart)
        low = np.maximum(apart.max(axis=0) - slack, 0).astype(np.float64)
        bound = (norms_q[row] + norms - low * low) / 2
        bound += 1e-6 * (norms_q[row] + norms) + 1e-6
        order = np.argsort(-bound.astype(np.float32))  # the margin is above the rounding of the keys
        best_ids, best = start if start is not None else (np.zeros(0, np.int64), np.zeros(0))
        at, step = 0, STEP
        while at < len(order):  # steps double, so a query that stops late has few of them
            part = order[at : at + step]
            at, step = at + step, step * 2
            if len(best) == k and bound[part[0]] < best[-1]:
                break
            scores = vectors[part] @ queries[row]
            if len(best) == k:
                near = np.flatnonzero(scores >= best[-1])
                part, scores = part[near], scores[near]
            other = ids[part] != query_ids[row]
            best_ids = np.concatenate([best_ids, ids[part][other]])
            best = np.concatenate([best, scores[other].astype(np.float64)])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
        yield row, best_ids, best


def _packer(common: int, chosen: list[list[int]]):
    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        flat = group.column("v").combine_chunks().flatten().to_numpy()
        v = flat.reshape(len(ids), -1).astype(np.int64)
        order = np.lexsort((*v.T[::-1], ids)) if len(ids) else np.arange(0)
        ids, v = ids[order], v[order]
        p = np.array(chosen, dtype=np.float64) if v.shape[1] == common else pivots(v.shape[1])
        p = np.concatenate([p, np.repeat(p[:1], PIVOTS - len(p), axis=0)])  # fewer vectors than pivots
        wide = v.astype(np.float64)
        square = (wide * wide).sum(1)[:, None] + (p * p).sum(1) - 2 * (wide @ p.T)
        table = np.sqrt(np.maximum(0, square))
        kind = "<i4" if v.min() >= -(1 << 31) and v.max() < 1 << 31 else "<i8"
        return pa.table(
            {
                "dims": pa.array([v.shape[1]], pa.int32()), "block": pa.array([group.column("block")[0].as_py()], pa.int64()),
                "ids": pa.array([ids.astype("<i8").tobytes()]), "v": pa.array([v.astype(kind).tobytes()]),
                "t": pa.array([table.astype("<f8").tobytes()]),
            }
        )

    return pack


def packed(vectors: DataFrame, rows: int, common: int, chosen: list[list[int]]) -> DataFrame:
    """Blocks of about ``BLOCK`` vectors of one length, with their rows of the pivot table."""
    blocks = max(1, -(-rows // BLOCK))
    return (
        vectors.withColumn("dims", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
        .repartition("dims", "block")
        .groupBy("dims", "block")
        .applyInArrow(_packer(common, chosen), "dims int, block bigint, ids binary, v binary, t binary")
    )


class _Wave:
    """The best k so far of every query of a wave, over the candidate blocks that a task has seen."""

    def __init__(self) -> None:
        self.blocks: dict[tuple[int, int], list] = {}

    def add(self, row: dict) -> None:
        dims, name = row["dims"], (row["dims"], row["q_block"])
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        q_ids, ids = read("q_ids", "<i8"), read("ids", "<i8")
        whole = lambda name, n: read(name, f"<i{len(row[name]) // (n * dims)}").reshape(n, dims)
        q, v = whole("q_v", len(q_ids)), whole("v", len(ids))
        state = self.blocks.setdefault(name, [(q_id, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for q_id in q_ids.tolist()])
        # among vectors of usual length scores are exact as doubles, and earlier ones can rule out others
        length = lambda x: np.square(x.astype(np.float64)).sum(1).max()
        usual = length(q) < USUAL and length(v) < USUAL and all(not len(s[2]) or np.abs(s[2]).max() < 1 << 53 for s in state)
        known = [(s[1], s[2].astype(np.float64)) for s in state] if usual else None
        tables = (read("q_t", "<f8").reshape(-1, PIVOTS), read("t", "<f8").reshape(-1, PIVOTS))
        for at, found, scores, under in search_any(q_ids, q, tables[0], ids, v, tables[1], known=known):
            q_id, old_ids, old, old_under = state[at]
            if known is None:  # else the earlier ones are among them
                found, scores, under = np.concatenate([old_ids, found]), np.concatenate([old, scores]), np.concatenate([old_under, under])
            keep = np.lexsort((found, ~scores, under))[:K]
            state[at] = (q_id, found[keep], scores[keep], under[keep])

    def rows(self) -> pa.RecordBatch:
        out = [(s[0], name[1], at + (name[0] << 32), s) for name, state in self.blocks.items() for at, s in enumerate(state)]
        repeat = lambda values: np.repeat(np.array(values, dtype=np.int64), [len(o[3][1]) for o in out])
        flat = lambda i, kind: np.concatenate([o[3][i] for o in out]).astype(kind) if out else np.zeros(0, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(repeat([o[0] for o in out])), pa.array(repeat([o[1] for o in out])), pa.array(repeat([o[2] for o in out])),
                pa.array(flat(1, np.int64)), pa.array(flat(2, np.int64)), pa.array(flat(3, bool)),
            ],
            names=["query_id", "q_block", "q_row", "vec_id", "score", "under"],
        )


def _search(batches):
    wave = _Wave()
    for batch in batches:
        for at in range(batch.num_rows):  # a pair of blocks at a time
            wave.add(batch.slice(at, 1).to_pylist()[0])
    yield wave.rows()


def top_k(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id and score: the best K of every vector whose id EVERY divides."""
    rows = stage(scaled(vectors), "scaled")
    is_query = F.col("vec_id") % EVERY == 0
    counts = rows.agg(F.count("*").alias("all"), F.count_if(is_query).alias("queries"), F.max(F.size("v")).alias("dims")).first()
    pivot = data_pivots(rows)
    names = {"block": "q_block", "ids": "q_ids", "v": "q_v", "t": "q_t"}
    blocks = stage(packed(rows, counts["all"], *pivot), "blocks")
    queries = stage(packed(rows.where(is_query), counts["queries"], *pivot).withColumnsRenamed(names), "query-blocks")
    size = BLOCK * (8 * (counts["dims"] or 1) + 8 * PIVOTS + 8)
    per_wave = max(1, WAVE_BYTES // size)
    last = queries.agg(F.max("q_block")).first()[0]
    found = []
    for first in range(0, (last or 0) + 1, per_wave):
        # at most WAVE_BYTES for the commonest length
        wave = F.broadcast(queries.where(F.col("q_block").between(first, first + per_wave - 1)))
        met = blocks.join(wave, "dims").select("dims", "q_block", "q_ids", "q_v", "q_t", "ids", "v", "t")
        parts = met.mapInArrow(_search, "query_id bigint, q_block bigint, q_row bigint, vec_id bigint, score bigint, under boolean")
        order = Window.partitionBy("query_id", "q_block", "q_row").orderBy("under", F.desc("score"), "vec_id")
        found.append(stage(parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K), "wave"))
    score = F.when(F.col("under"), F.raise_error(F.lit("a score leaves the long range")).cast("long")).otherwise(F.col("score"))
    return reduce(DataFrame.unionByName, found).select("query_id", "rank", "vec_id", score.alias("score"))
