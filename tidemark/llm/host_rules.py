"""Quality rules per document, and verdicts per host shrunk with an empirical beta prior.

Words are runs without ASCII white space. A document fails by itself with under 20 words or with
more than 30 % of its words inside 8-word windows that occur twice or more in it. Failures are
counted by host, the hosts' rates give a beta prior by the method of moments, and a host is
rejected with all its documents when its shrunk rate exceeds ``LIMIT``, or exceeds ``FLOOR`` and
lies more than ``DEVIATIONS`` standard deviations of that prior above its mean. A host with few
documents thus needs more evidence than its own rate, and a host that is merely the worst of many
like ones stays.

Nulls and repeats. A null text has no words and fails. A null host is a host of its own. Each row
counts, repeated rows too. An empty table gives an empty result. A text of any length is measured
whole in one task, with memory in proportion to its words. Columns other than doc_id, text and the
host's take no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stage

MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: A host is rejected above LIMIT, and above FLOOR if it also departs from the other hosts.
LIMIT = 0.5
FLOOR = 0.3
DEVIATIONS = 2.0
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in an 8-word window found at two or more places."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    if len(ids) == n:
        return 0
    for width in (1, 2, 4):  # names of windows twice as wide, made from pairs of names
        wide = codes[:-width] * np.int64(n) + codes[width:]
        _, codes = np.unique(wide, return_inverse=True)
    counts = np.bincount(codes)
    starts = np.flatnonzero(counts[codes] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges[:n]) > 0).sum())


def measures(text: bytes | None) -> tuple[int, int, int, int, int]:
    text = text or b""
    words = text.split()
    seen = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text.translate(None, SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(seen) - len(set(seen)),
        repeated_words(words),
    )


def _measurer():
    def work(columns: list) -> list:
        doc_id, host, texts = columns
        return [doc_id, host, *([list(c) for c in zip(*map(measures, texts))] if texts else [[]] * 5)]

    return work


def document_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, the five measures and base_failed for every row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.col("text").cast("binary").alias("text")
    )
    found = map_rows(
        rows, _measurer,
        "doc_id bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def host_verdicts(rules: DataFrame) -> DataFrame:
    """host, docs, failures, shrunk rate and rejected, one row per host.

    The prior's mean is the pooled rate m; its weight s follows from the variance v of the hosts'
    rates beyond binomial noise: s = m (1 - m) / v - 1, at least 1. Without such variance every
    host gets the pooled rate. The prior's standard deviation is sqrt(m (1 - m) / (s + 1)).
    """
    hosts = rules.groupBy("host").agg(
        F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failures")
    )
    rate = F.col("failures") / F.col("docs")
    pooled = hosts.agg(
        F.sum("docs").alias("all_docs"), F.sum("failures").alias("all_failures"),
        F.sum(F.col("docs") * rate * rate).alias("squares"), F.count("*").alias("hosts"),
    )
    m = F.col("all_failures") / F.col("all_docs")
    spread = F.col("squares") / F.col("all_docs") - m * m
    noise = m * (1 - m) * F.col("hosts") / F.col("all_docs")
    prior = pooled.select(
        m.alias("m"),
        F.when(spread > noise, F.greatest(F.lit(1.0), m * (1 - m) / (spread - noise) - 1)).alias("s"),
    ).first()  # one row
    mean = prior["m"] if prior["m"] is not None else 0.0
    weight = prior["s"]
    shrunk = F.lit(mean) if weight is None else (F.col("failures") + mean * weight) / (F.col("docs") + weight)
    deviation = 0.0 if weight is None else (mean * (1 - mean) / (weight + 1)) ** 0.5
    limit = min(LIMIT, max(FLOOR, mean + DEVIATIONS * deviation))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > limit)


def judged(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rules of every row with ``kept``: neither it nor its host is rejected."""
    rules = stage(document_rules(docs, host), "rules")
    verdicts = host_verdicts(rules).where("rejected").select(F.col("host").alias("_host"), "rejected")
    out = rules.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull()).drop("_host", "rejected")
