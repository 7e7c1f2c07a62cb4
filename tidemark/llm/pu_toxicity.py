"""Toxicity from confirmed toxic examples and unlabelled text, by non-negative PU learning.

Only positive labels are examples; everything else is unlabelled. With the class prior p (the
toxic share of the labelled rows that may be used) the risk of a linear classifier is

    p * E_P[loss(+)] + max(0, E_U[loss(-)] - p * E_P[loss(-)])

which is unbiased but for the bound at zero; where a step makes the second term negative, it is
pushed back up instead. The loss is logistic, so scores are class probabilities.

Features are whole words and character 5-grams of words, present or not in the whole text. The
``FEATURES`` ones that differ most between positive and unlabelled documents are weighed.
Training takes at most ``MAX_POSITIVE`` positive and ``MAX_UNLABELLED`` unlabelled documents,
in one task; scoring covers every whole text. Rows are chosen by a hash of id and text, and rows equal
in both count once, so an id on very many rows brings no more than any other.

Nulls and repeats. Null and empty texts have no features and get the score of that. Rows with a
null doc_id are scored, never trained on. Labels that are null are no labels; a document with any
toxic label is a positive. Without usable positives every score is 0. Repeated rows give repeated
results. Long texts are handled one at a time; columns other than doc_id and text may have any name, and
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, remainder, stage, worker_cache

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
MAX_POSITIVE, MAX_UNLABELLED = 4_000, 12_000
FEATURES = 4_096
MIN_DOCUMENTS = 5
BITS = 20
STEPS, RATE, PENALTY = 300, 0.05, 1e-4
CACHE = 1 << 18
_EDGES = ".,;:!?#%&*$|<>()[]{}\"'`"


def word_features(word: str) -> array:
    """Hashed features of one lower-cased word, four bytes each."""
    word = word.strip(_EDGES)
    if not word:
        return array("i")
    framed = f"#{word}#"
    grams = {framed, *(framed[i : i + 5] for i in range(len(framed) - 4))}
    return array("i", [zlib.crc32(g.encode()) & ((1 << BITS) - 1) for g in grams])


def pu_gradient(z: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Derivative by each score of the non-negative risk's step."""
    n_p, n_u = positive.sum(), (~positive).sum()
    right = 1 / (1 + np.exp(-z))  # derivative of loss(-); that of loss(+) is right - 1
    negative_part = np.logaddexp(0, z[~positive]).mean() - prior * np.logaddexp(0, z[positive]).mean()
    g = np.zeros_like(z)
    if negative_part >= 0:
        g[positive] = prior * (right[positive] - 1) / n_p - prior * right[positive] / n_p
        g[~positive] = right[~positive] / n_u
    else:
        g[positive] = prior * right[positive] / n_p
        g[~positive] = -right[~positive] / n_u
    return g


def train(features: list[np.ndarray], positive: np.ndarray, prior: float, size: int) -> tuple[np.ndarray, float]:
    """(weights, bias); ``features`` holds the places, below ``size``, of each document's features."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    cols = np.concatenate(features) if features else np.zeros(0, np.int64)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, w[cols], minlength=len(features)) + w[-1]
        g = pu_gradient(z, positive, prior)
        full = np.append(np.bincount(cols, g[rows], minlength=size) + PENALTY * w[:-1], g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def document_features(text: str | None, known: dict[str, array]) -> set[int]:
    out: set[int] = set()
    if len(known) > CACHE:
        known.clear()
    for word in set((text or "").lower().split()):
        found = known.get(word)
        if found is None:
            found = known[word] = word_features(word)
        out.update(found)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model as plain lists: at most ``FEATURES`` names and weights, and the bias."""
    usable = remainder("doc_id", FOLDS) != HELD_OUT
    marks = labels.where(usable & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    share = marks.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"]
    if not share:
        return {"names": [], "weights": [], "bias": None}
    prior = min(max(share, 1e-4), 0.9)
    # rows are chosen, not ids: by a hash of id and text, so that equal rows are one candidate and a
    # repeated id brings no more rows than any other
    key = F.xxhash64(F.lit("pu"), F.col("doc_id"), F.col("text"))
    rows = docs.where(usable).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("key", key)
    keys = rows.select("doc_id", "key")
    first = lambda df, n, kind: df.select("key").distinct().orderBy("key").limit(n).withColumn("kind", F.lit(kind))
    confirmed = keys.join(marks.where("toxic = 1"), "doc_id", "left_semi")
    # bounded by the two parameters
    chosen = F.broadcast(first(confirmed, MAX_POSITIVE, 1).unionByName(first(keys, MAX_UNLABELLED, 0)))
    sample = rows.join(chosen, "key").dropDuplicates(["kind", "key"]).select("kind", F.col("key").alias("doc_id"), "text")

    def featuriser():
        known: dict[str, array] = worker_cache("toxicity-features", dict)

        def work(columns: list) -> list:
            found = [np.sort(np.fromiter(document_features(t, known), dtype="<i4")).tobytes() for t in columns[2]]
            return [columns[0], columns[1], found]

        return work

    features = stage(map_rows(sample, featuriser, "kind int, doc_id bigint, features binary"), "features")
    names = selected(features)

    def chooser():
        wanted = np.array(names, dtype=np.int64)

        def work(columns: list) -> list:
            found = [np.frombuffer(f, dtype="<i4").astype(np.int64) for f in columns[2]]
            places = [np.searchsorted(wanted, f[np.isin(f, wanted)]).astype("<i4").tobytes() for f in found]
            return [columns[0], columns[1], places]

        return work

    def learn(batches):
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort()  # the order of arrival decides nothing
        positive = np.array([r[0] == 1 for r in rows], dtype=bool)
        weights, bias = [], None
        if positive.any() and not positive.all():
            found, bias = train([np.frombuffer(r[2], dtype="<i4") for r in rows], positive, prior, len(names))
            weights = found.tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights], pa.list_(pa.float64())), pa.array([bias], pa.float64())], names=["weights", "bias"]
        )

    chosen_rows = map_rows(features, chooser, "kind int, doc_id bigint, features binary")
    row = chosen_rows.repartition(1).mapInArrow(learn, "weights array<double>, bias double").first()
    return {"names": names if row and row["weights"] else [], "weights": row["weights"] if row else [], "bias": row["bias"] if row else None}


def selected(features: DataFrame) -> list[int]:
    """The features that differ most between both kinds of documents, at most ``FEATURES``.

    The difference of the shares is measured in standard errors and must exceed three.
    """

    def counts(batches):
        total = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for kind, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[kind, np.frombuffer(found, dtype="<i4")] += 1
        cells = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(total[1, cells]), pa.array(total[0, cells])], names=["cell", "p", "u"]
        )

    sizes = features.agg(F.count_if(F.col("kind") == 1).alias("p"), F.count_if(F.col("kind") == 0).alias("u")).first()
    n_p, n_u = sizes["p"], sizes["u"]
    if not n_p or not n_u:
        return []
    cells = features.select("kind", "features").mapInArrow(counts, "cell bigint, p bigint, u bigint")
    summed = cells.groupBy("cell").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    a, b = (F.col("p") + 0.5) / F.lit(n_p + 1), (F.col("u") + 0.5) / F.lit(n_u + 1)
    merit = F.abs(a - b) / F.sqrt(b * (1 - b) / F.lit(n_p) + a * (1 - a) / F.lit(n_p))
    best = summed.where(F.col("p") + F.col("u") >= MIN_DOCUMENTS).select("cell", merit.alias("merit")).where("merit > 3")
    return sorted(r["cell"] for r in best.orderBy(F.col("merit").desc(), "cell").limit(FEATURES).collect())


def _scorer(model: dict):
    weights = dict(zip(model["names"], model["weights"]))
    bias = model["bias"]
    name = hashlib.sha256(repr(model).encode()).hexdigest()

    def make():
        known: dict[str, tuple] = worker_cache(f"toxicity-{name}", dict)

        def score(text: str | None) -> float:
            if bias is None:
                return 0.0
            if len(known) > CACHE:
                known.clear()
            found: set[int] = set()
            for word in set((text or "").lower().split()):
                hits = known.get(word)
                if hits is None:
                    hits = known[word] = tuple(f for f in word_features(word) if f in weights)
                if hits:
                    found.update(hits)
            z = bias + sum(weights[f] for f in sorted(found))
            return 1 / (1 + np.exp(-z)) if z > -700 else 0.0

        return lambda columns: [columns[0], [float(score(t)) for t in columns[1]]]

    return make


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = map_rows(rows, _scorer(model), "doc_id bigint, score double")
    return out.select(
        "doc_id", F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    model = fit(docs, labels)
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index("text")

    def make():
        score = _scorer(model)()

        def work(columns: list) -> list:
            keep = [i for i, s in enumerate(score([columns[0], columns[place]])[1]) if s < THRESHOLD]
            return [[c[i] for i in keep] for c in columns]

        return work

    inner = docs.toDF(*names)
    return map_rows(inner, make, inner.schema).toDF(*docs.columns)
