"""URL filter: host and path rules, and logistic regression on hashed n-grams for the rest.

A url's host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
its path follows up to ``?``, ``#`` or the end. A rule (host, path) fits its host and all
subdomains if the path starts with the rule's; the longest rule that fits decides. Other urls get
the verdict of a logistic regression on character 3- and 4-grams of host and path, hashed into
``CELLS`` cells. It is trained on a small labelled table: the distinct urls that the rules decide,
at most ``MAX_LABELLED`` by a hash of the url, with the rules' verdicts.

Everything runs in DataFrame expressions. Each evaluation of loss and gradient is one aggregate over
the bounded table; only the ``CELLS`` weights pass through the driver, where limited-memory quasi-Newton
steps lead to the least penalised loss, until the gradient is below ``TOLERANCE``.

Nulls and repeats. A null url, or one without ``://``, has an empty host and path. Urls without
any n-gram get the model's bias. Without labelled urls of both verdicts the verdict is the one
there is, else allow. Rows are judged one by one, so repeated rows agree. Urls may be of any length. Only
page_id and url are read, so further columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: (host, path, verdict) as stated in the contract.
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
CELLS = 2_048
MAX_LABELLED = 2_000
PENALTY = 1e-4
#: The largest component of the gradient at which training ends, and the evaluations it may take.
TOLERANCE, EVALUATIONS, MEMORY = 2e-4, 80, 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: tuple[str, str, str]) -> Column:
    name, prefix, _ = rule
    h = F.col("host")
    return ((h == name) | h.endswith("." + name)) & F.col("path").startswith(prefix)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule and the rule's verdict, the latter two null without a rule."""
    parts = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
    )
    by_length = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(by_length):
        name = F.when(_fits(rule), rule[0] + rule[1]).otherwise(name)
        verdict = F.when(_fits(rule), rule[2]).otherwise(verdict)
    return parts.select("*", name.alias("rule"), verdict.alias("verdict"))


def cells() -> Column:
    """Distinct cells of the 3- and 4-grams of host and path, from 1."""
    text = F.concat(F.lit("^"), F.col("host"), F.lit("|"), F.col("path"), F.lit("$"))

    def grams(size: int) -> Column:
        last = F.greatest(F.length(text) - size + 1, F.lit(1))
        hashed = lambda i: F.pmod(F.xxhash64(F.substring(text, i, size)), F.lit(CELLS)).cast("int") + 1
        return F.transform(F.sequence(F.lit(1), last), hashed)

    return F.array_distinct(F.concat(grams(3), grams(4)))


def _score(weights: list[float], bias: float) -> Column:
    # lengths differ, so each url's sum is divided by the root of its number of cells
    table = F.lit(np.array(weights, dtype=np.float64))
    total = F.aggregate("cells", F.lit(0.0), lambda a, c: a + F.element_at(table, c))
    return total / F.sqrt(F.size("cells").cast("double")) + F.lit(bias)


def _evaluated(labelled: DataFrame, n: int, at: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss and gradient at ``at`` (bias first), from one aggregate over the labelled table."""
    margin = _score(at[1:].tolist(), float(at[0]))
    error = (1 / (1 + F.exp(-margin)) - F.col("y")) / F.lit(float(n))
    signed = F.when(F.col("y") == 1, margin).otherwise(-margin)
    loss = (F.greatest(-signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))) / F.lit(float(n))
    each = labelled.select(error.alias("e"), loss.alias("loss"), "cells").select(
        F.explode(F.concat(F.array(F.lit(-1), F.lit(0)), "cells")).alias("cell"), "e", "loss", F.sqrt(F.size("cells").cast("double")).alias("root")
    )
    # sums of whole billionths do not depend on the order of rows
    part = F.when(F.col("cell") == -1, F.col("loss")).when(F.col("cell") == 0, F.col("e")).otherwise(F.col("e") / F.col("root"))
    gradient, total = np.zeros(CELLS + 1), 0.0
    for row in each.groupBy("cell").agg(F.sum(F.round(part * 1e12).cast("long")).alias("g")).collect():  # CELLS + 2 rows at most
        if row["cell"] < 0:
            total = row["g"] / 1e12
        else:
            gradient[row["cell"]] = row["g"] / 1e12
    gradient[1:] += PENALTY * at[1:]
    return total + PENALTY / 2 * float(at[1:] @ at[1:]), gradient


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction from the last steps (change of weights, change of gradient)."""
    q, kept = gradient.copy(), []
    for s, y in reversed(steps):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if steps:
        s, y = steps[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(steps, reversed(kept)):
        q += (a - (y @ q) / (s @ y)) * s
    return -q


def train(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights and bias from (cells, y): penalised logistic loss, down to a gradient of ``TOLERANCE``.

    Every evaluation is one aggregate over the labelled table; at most ``EVALUATIONS`` of them.
    """
    size = labelled.agg(F.count("*").alias("n"), F.avg("y").alias("p")).first()
    n, share = size["n"], size["p"]
    at = np.zeros(CELLS + 1)
    if not n or share in (0.0, 1.0):
        return at[1:].tolist(), -10.0 if share == 0.0 else 10.0
    at[0] = math.log(share / (1 - share))
    loss, gradient = _evaluated(labelled, n, at)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    length, used = 1.0 / max(float(np.abs(gradient).sum()), 1e-12), 1
    while used < EVALUATIONS and np.abs(gradient).max() > TOLERANCE:
        way = _direction(gradient, steps)
        slope = float(gradient @ way)
        while used < EVALUATIONS:
            tried, used = at + length * way, used + 1
            new_loss, new_gradient = _evaluated(labelled, n, tried)
            if new_loss <= loss + 1e-4 * length * slope or length < 1e-6:
                break
            length /= 2
        s, y = tried - at, new_gradient - gradient
        if s @ y > 1e-14:
            steps = [*steps[-(MEMORY - 1):], (s, y)]
        at, loss, gradient, length = tried, new_loss, new_gradient, 1.0
    return at[1:].tolist(), float(at[0])


def labelled_urls(judged: DataFrame) -> DataFrame:
    """The bounded training table: cells and y (1: allow) of distinct urls that rules decide."""
    chosen = judged.where("rule IS NOT NULL").select("host", "path", "verdict").distinct()
    return (
        chosen.orderBy(F.xxhash64("host", "path"), "host", "path").limit(MAX_LABELLED)
        .select(cells().alias("cells"), F.when(F.col("verdict") == "allow", 1.0).otherwise(0.0).alias("y"))
    )


def filtered(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score for every row."""
    judged = stage(ruled(pages, rules).drop("url"), "ruled")
    weights, bias = train(stage(labelled_urls(judged), "labelled"))
    scores = judged.withColumn("cells", cells()).withColumn("score", _score(weights, bias))
    model = F.when(F.col("score") >= 0, "allow").otherwise("block")
    return scores.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", model).alias("verdict"), F.col("score").alias("model_score")
    )
