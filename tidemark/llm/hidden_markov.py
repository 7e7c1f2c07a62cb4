"""Language-model scores from a hidden Markov model trained on the corpus.

Tokens are words (A-Z lower-cased runs without ASCII white space), then one end. Documents whose
hash remainder is not ``HELD_OUT`` train. Two scores per text, as log10 probabilities:

- ``base_score``: tokens drawn independently, add-half estimates;
- ``score``: a hidden Markov model with ``STATES`` states. A state emits a word class, and the
  class its word: P(word | state) = P(class | state) * P(word | class), the latter an add-half
  estimate within the class with one unseen word. The ``TOP`` commonest words are classes of their
  own, all others fall into ``ENDINGS`` classes by their last characters.

Baum-Welch: each pass runs scaled forward and backward recursions over all training documents;
expected counts are added up per task, then across partitions, and only the model (bounded by
states times classes) returns. The first model comes from a counting pass that assigns documents
to states by their most frequent common class. Scores are exact forward recursions.

Distribution. Texts become sequences of positions in a dictionary per chunk of the input; only
the chunks' dictionaries meet by word, so the vocabulary is never broadcast, whatever its size,
and a word shuffles once per chunk instead of once per use.

Nulls and repeats. A null or empty text is one end token. A null doc_id is not held out. Repeated
rows count and are scored each. An empty table gives no rows; without training tokens both models
know one unseen token. Very long texts are scored whole; the forward values kept for one grow with its
tokens. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remainder, stage
from tidemark.session import scratch_path

FOLDS, HELD_OUT = 5, 1
STATES = 8
TOP, ENDINGS, ENDING_CHARS = 2048, 2048, 3
CLASSES = TOP + ENDINGS
PASSES = 3
CHUNK_TOKENS = 1 << 21
#: Cells of one padded batch of sequences.
AREA = 600_000
SEEDS = 64
UNIT = 10_000  # expected counts are added as whole ten-thousandths, so sums do not depend on order
PRIOR = 100.0


# ---- Chunks: dictionaries and sequences ---------------------------------------------------

_CHUNK_SCHEMA = (
    "kind int, chunk bigint, word bigint, local int, n bigint, ending int, doc_id bigint, held_out boolean, seq binary"
)


class Numbers(dict):
    """Positions of words in the order of their first use; the end of a text is first."""

    def __init__(self) -> None:
        super().__init__({b"": 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def narrow(codes: np.ndarray) -> bytes:
    """Numbers below 2**24, three bytes each."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def widened(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 3, 4), dtype=np.uint8)
    out[:, :3] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 3)
    return out.view("<u4").reshape(-1)


def _chunks(batches):
    """Dictionary rows (kind 0) and documents (kind 1) of each chunk.

    A word goes by a 64-bit hash, so the dictionaries stay small where they meet.
    """
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    names = [c.split()[0] for c in _CHUNK_SCHEMA.split(", ")]
    made, tokens, words, held = 0, 0, Numbers(), []

    def flush():
        chunk = (part << 24) + made
        counts = np.zeros(len(words), dtype=np.int64)
        training = [seq for _, out, seq in held if not out]
        if training:
            counts += np.bincount(np.concatenate(training), minlength=len(words))
        w, d = len(words), len(held)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=w).view(np.int64)
        endings = np.fromiter((zlib.crc32(x.decode()[-ENDING_CHARS:].encode()) % ENDINGS for x in words), dtype=np.int32, count=w)
        rows = [
            [pa.array(np.zeros(w, np.int32)), pa.array(np.full(w, chunk)), pa.array(hashes), pa.array(np.arange(w, dtype=np.int32)),
             pa.array(counts), pa.array(endings), pa.nulls(w, pa.int64()), pa.nulls(w, pa.bool_()), pa.nulls(w, pa.binary())],
            [pa.array(np.ones(d, np.int32)), pa.array(np.full(d, chunk)), pa.nulls(d, pa.int64()), pa.nulls(d, pa.int32()),
             pa.nulls(d, pa.int64()), pa.nulls(d, pa.int32()), pa.array([x[0] for x in held], pa.int64()),
             pa.array([x[1] for x in held], pa.bool_()), pa.array([narrow(x[2]) for x in held], pa.binary())],
        ]
        return [pa.RecordBatch.from_arrays(r, names=names) for r in rows]

    for batch in batches:
        for doc_id, out, text in zip(*(c.to_pylist() for c in batch.columns)):
            codes = list(map(words.__getitem__, (text or b"").lower().split()))
            codes.append(0)
            held.append((doc_id, out, np.array(codes, dtype=np.int32)))
            tokens += len(codes)
            if tokens >= CHUNK_TOKENS:
                yield from flush()
                made, tokens, held, words = made + 1, 0, [], Numbers()
    if held:
        yield from flush()


def _written(df: DataFrame, label: str) -> DataFrame:
    """``stage`` with the denser codec, for tables of packed numbers."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, word, local, n, ending) and (chunk, doc_id, held_out, seq), written once."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    spark = docs.sparkSession
    path = scratch_path(spark, "chunks")
    rows.mapInArrow(_chunks, _CHUNK_SCHEMA).write.option("compression", "zstd").parquet(path)
    read = lambda kind: spark.read.schema(_CHUNK_SCHEMA).parquet(path).where(F.col("kind") == kind)
    return read(0).select("chunk", "word", "local", "n", "ending"), read(1).select("chunk", "doc_id", "held_out", "seq")


def word_classes(dictionary: DataFrame) -> DataFrame:
    """(word, c, cls) of every word that occurs; the commonest get classes of their own."""
    counts = stage(dictionary.groupBy("word").agg(F.sum("n").alias("c"), F.min("ending").alias("ending")), "counts")
    top = counts.where("c > 0").orderBy(F.col("c").desc(), "word").limit(TOP)
    places = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("c")).alias("low"), "word"))).alias("w")).select(
        F.posexplode("w").alias("cls", "w")
    ).select("cls", F.col("w.word").alias("word"))  # TOP rows
    return stage(
        counts.join(F.broadcast(places), "word", "left").select("word", "c", F.coalesce("cls", F.col("ending") + TOP).alias("cls")),
        "classes",
    )


# ---- Sequences of classes with their word scores ------------------------------------------

_SEQUENCES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, word_score double, classes binary"
)


def _recode(total: int, distinct: int, class_total: np.ndarray, class_distinct: np.ndarray):
    base = math.log10(total + 0.5 * (distinct + 1))
    inside = np.log10(class_total + 0.5 * (class_distinct + 1))

    def work(sequences: pa.Table, dictionary: pa.Table) -> pa.Table:
        local = dictionary.column("local").to_numpy()
        c, cls = np.zeros(len(local), dtype=np.int64), np.zeros(len(local), dtype=np.int64)
        c[local], cls[local] = dictionary.column("c").to_numpy(), dictionary.column("cls").to_numpy()
        count = np.log10(c + 0.5)
        known = c > 0
        out: dict[str, list] = {k.split()[0]: [] for k in _SEQUENCES.split(", ")}
        for doc_id, held, seq in zip(*(sequences.column(n).to_pylist() for n in ("doc_id", "held_out", "seq"))):
            seq = widened(seq)
            terms, kinds = count[seq], cls[seq]
            for key, value in zip(out, (
                doc_id, held, len(seq), int(known[seq].sum()), float(terms.sum() - len(seq) * base),
                float((terms - inside[kinds]).sum()), kinds.astype("<i2").tobytes(),
            )):
                out[key].append(value)
        kinds_ = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds_)})

    return work


# ---- Recursions ---------------------------------------------------------------------------


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit.T)  # emit by class


def padded(sequences: list[np.ndarray]):
    """(places, lengths, classes[time, sequence]) of batches of similar lengths, longest first."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    at = 0
    while at < len(order):
        size = max(1, AREA // max(1, len(sequences[order[at]])))
        part = order[at : at + size]
        lengths = np.array([len(sequences[i]) for i in part])
        grid = np.zeros((lengths[0], len(part)), dtype=np.int64)
        for k, i in enumerate(part):
            grid[: lengths[k], k] = sequences[i]
        yield part, lengths, grid
        at += size


def _active(lengths: np.ndarray, steps: int) -> np.ndarray:
    """Number of sequences longer than t, for each t; lengths fall."""
    return np.searchsorted(-lengths, -np.arange(steps), side="left")


def forward(model: Model, lengths: np.ndarray, grid: np.ndarray, keep: bool = False):
    """Natural log likelihoods, and with ``keep`` the scaled forward values and scales."""
    steps, n = grid.shape
    active = _active(lengths, steps)
    likelihood = np.zeros(n)
    alphas = np.zeros((steps, n, len(model.start))) if keep else None
    scales = np.ones((steps, n)) if keep else None
    a = None
    for t in range(steps):
        m = active[t]
        seen = model.emit[grid[t, :m]]
        a = model.start * seen if t == 0 else (a[:m] @ model.move) * seen
        s = a.sum(axis=1)
        a /= s[:, None]
        likelihood[:m] += np.log(s)
        if keep:
            alphas[t, :m], scales[t, :m] = a, s
    return (likelihood, alphas, scales, active) if keep else likelihood


def expected_counts(model: Model, lengths: np.ndarray, grid: np.ndarray):
    """(start, move, emit by class, log likelihood) of one padded batch."""
    likelihood, gamma, scales, active = forward(model, lengths, grid, keep=True)
    steps, n = grid.shape
    moves = np.zeros_like(model.move)
    beta = np.ones((n, len(model.start)))
    for t in range(steps - 2, -1, -1):
        m = active[t + 1]
        if not m:
            continue
        later = model.emit[grid[t + 1, :m]] * beta[:m] / scales[t + 1, :m, None]
        moves += gamma[t, :m].T @ later
        beta[:m] = later @ model.move.T
        gamma[t, :m] *= beta[:m]
    used = np.arange(n)[None, :] < active[:, None]
    flat, weights = grid[used], gamma[used]
    emits = np.stack([np.bincount(flat, weights[:, k], minlength=CLASSES) for k in range(weights.shape[1])])
    return gamma[0].sum(axis=0), moves * model.move, emits, float(likelihood.sum())


def _batched(batches, tokens: int = 1 << 21):
    """Rows in groups of about ``tokens`` tokens, the last column as class sequences."""
    rows, held = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            seq = np.frombuffer(row[-1], dtype="<i2").astype(np.int64)
            rows.append((*row[:-1], seq))
            held += len(seq)
            if held >= tokens:
                yield rows
                rows, held = [], 0
    if rows:
        yield rows


def _count_cells(make):
    """Runs ``make(sequences)`` over a task's rows and emits (cell, whole units) of the sums."""

    def run(batches):
        total = None
        for rows in _batched(batches):
            found = make([r[-1] for r in rows])
            total = found if total is None else total + found
        if total is not None:
            units = np.rint(total * UNIT).astype(np.int64)
            cells = np.flatnonzero(units)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(units[cells])], names=["cell", "units"])

    return run


def _summed(training: DataFrame, make, size: int) -> np.ndarray:
    rows = training.select("classes").mapInArrow(_count_cells(make), "cell bigint, units bigint")
    out = np.zeros(size)
    for row in rows.groupBy("cell").agg(F.sum("units").alias("units")).collect():  # bounded by the model's size
        out[row["cell"]] = row["units"] / UNIT
    return out


def _seed(sequences: list[np.ndarray]) -> np.ndarray:
    """Class counts by state; a document goes to the state of its most frequent common class."""
    out = np.zeros((STATES, CLASSES))
    for seq in sequences:
        counts = np.bincount(seq, minlength=CLASSES)
        out[int(counts[:SEEDS].argmax()) % STATES] += counts
    return out.ravel()


def _maximise(start: np.ndarray, move: np.ndarray, emit: np.ndarray, classes: np.ndarray) -> Model:
    """Probabilities from expected counts; classes not seen in a state keep a small share."""
    share = (classes + 0.5) / (classes + 0.5).sum()
    emit = (emit + PRIOR * share) / (emit.sum(axis=1, keepdims=True) + PRIOR)
    move = (move + 1.0) / (move + 1.0).sum(axis=1, keepdims=True)
    return Model((start + 1.0) / (start + 1.0).sum(), move, emit)


def trained(training: DataFrame, classes: np.ndarray) -> Model:
    """The model after ``PASSES`` passes of Baum-Welch over all training sequences."""
    seeds = _summed(training, _seed, STATES * CLASSES).reshape(STATES, CLASSES)
    size = seeds.sum(axis=1)
    sticky = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
    model = _maximise(size / max(1.0, size.sum()) * STATES, sticky * 1000, seeds, classes)
    for _ in range(PASSES):
        current = model

        def expect(sequences: list[np.ndarray], model: Model = current) -> np.ndarray:
            sums = None
            for _, lengths, grid in padded(sequences):
                s, m, e, _ = expected_counts(model, lengths, grid)
                found = np.concatenate([s, m.ravel(), e.ravel()])
                sums = found if sums is None else sums + found
            return sums

        cells = STATES + STATES * STATES + STATES * CLASSES
        sums = _summed(training, expect, cells)
        model = _maximise(
            sums[:STATES], sums[STATES : STATES + STATES**2].reshape(STATES, STATES),
            sums[STATES + STATES**2 :].reshape(STATES, CLASSES), classes,
        )
    return model


def _score(model: Model):
    def run(batches):
        for rows in _batched(batches):
            logs = np.zeros(len(rows))
            for places, lengths, grid in padded([r[-1] for r in rows]):
                logs[places] = forward(model, lengths, grid)
            columns = list(zip(*rows))
            score = logs / math.log(10) + np.array(columns[5])
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
            arrays = [pa.array(list(c), k) for c, k in zip(columns[:5], kinds)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
            )

    return run


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    dictionary, sequences = chunked(docs)
    words = word_classes(dictionary)
    per_class = words.groupBy("cls").agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).collect()  # CLASSES rows
    totals, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in per_class:
        totals[row["cls"]], distinct[row["cls"]] = row["c"], row["v"]
    n, v = int(totals.sum()), int(distinct.sum())
    coded = dictionary.select("chunk", "local", "word").join(words, "word").select("chunk", "local", "c", "cls")
    recoded = _written(
        sequences.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(_recode(n, v, totals, distinct), _SEQUENCES),
        "sequences",
    )
    model = trained(recoded.where("NOT held_out"), totals)
    out = recoded.select(*[c.split()[0] for c in _SEQUENCES.split(", ")]).mapInArrow(
        _score(model), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
