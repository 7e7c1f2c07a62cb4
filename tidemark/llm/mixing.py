"""Mixing sources to target weights, exact to the word.

A document's size is its number of words (runs without ASCII white space; a null text has none).
Sources in code-point order, null last, weigh 1, 2, 3, repeating. They share the words of the
whole corpus by weight; a target stops at three times its source's words and the excess goes to
the others by weight until no target is above. Each source takes whole epochs of its documents
and then, in the order of hash-random keys, documents until its budget is used up; the last one
gives just the words still missing.

Distribution. Keys are spread evenly, so each source is cut into as many key ranges as its number
of documents asks for; running sums are taken within ranges and over the ranges' totals. A source
with a third of all rows is split like any other, and sources are numbered by a range sort.

Nulls and repeats. A null source is one source. Keys are hashes of id and text, so rows that repeat
a doc_id, or have none, are ordered like others; rows equal in both are interchangeable, so reruns agree. A source without words has the target 0.
Very long texts are counted whole. Columns other than doc_id, source, text and n_chars may have any name and are kept
as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, stage

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Documents in one range of keys, on average.
RANGE_ROWS = 4_096
_GAP = "[\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"), F.lit(0).cast("long"))


def budgets(sources: DataFrame) -> DataFrame:
    """Adds weight and target to (source, docs, source_size); ``sources`` is staged.

    A target is min(3 * size, level * weight) for the level at which the targets add up to all
    words. The level rises from total / weights, as capped sources leave words to the others,
    and is right when no further source reaches its cap; each round is one aggregate row.
    """
    ordered = numbered(sources, F.col("source").isNull().asc(), F.col("source").asc(), name="place")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS)).cast("int") + 1)
    weighed = stage(ordered.withColumn("weight", weight).drop("place"), "weights")
    cap = F.col("source_size") * MAX_REPEAT
    level, capped_before = 0.0, -1
    while True:
        capped = cap <= F.lit(level) * F.col("weight")
        row = weighed.agg(
            F.sum("source_size").alias("total"), F.count_if(capped).alias("n"),
            F.sum(F.when(capped, cap).otherwise(0)).alias("taken"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()  # one row
        if row["n"] == capped_before or not row["open"]:
            break
        capped_before = row["n"]
        level = (row["total"] - row["taken"]) / row["open"]
    return weighed.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def _placed(docs: DataFrame) -> DataFrame:
    """Every document's place in its source's order, whole epochs and words of the last one."""
    sized = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"), _key().alias("key"),
        ),
        "sizes",
    )
    totals = stage(sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")), "totals")
    budget = F.floor("target")
    plan = stage(
        budgets(totals)
        .withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.col("docs") / RANGE_ROWS)))
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumnRenamed("source", "_source"),
        "plan",
    )
    high = F.shiftrightunsigned("key", 33)  # 31 bits, spread evenly
    placed = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("range", F.shiftright(high * F.col("ranges"), 31))
    )
    per_range = placed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = per_range.select(
        F.col("source").alias("_source"), F.col("range").alias("_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before"),
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy(*[F.col("pos." + c) for c in _POSITION])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = placed.withColumn("pos", _position()).withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
    left = F.col("rest") - F.col("before") - F.col("within")
    return joined.withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left)))


_POSITION = ("high", "key", "doc_id", "size")


def _key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Of id and text: rows with one id, or without any, are spread like others."""
    return F.xxhash64(F.lit("mix"), F.col(doc_id).cast("long"), F.col(text).cast("string"))


def _position() -> Column:
    return F.struct(F.shiftrightunsigned("key", 33).alias("high"), "key", "doc_id", "size")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row."""
    taken = (F.col("epochs") * F.col("size") + F.col("part")).cast("long")
    return _placed(docs).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, a cut one by its first
    words joined by blanks.

    Only one row per source (its epochs and its last document) meets the texts, which are not
    shuffled by document. No document gives more than three rows, documents without words give
    none, equal rows at the cut are cut alike, and ``n_chars`` is brought up to date.
    """
    names = [f"_m{i}" for i in range(len(docs.columns))]
    last = F.max(F.when(F.col("part") > 0, F.struct("pos", "part"))).alias("_last")
    plan = stage(
        _placed(docs).groupBy(F.col("source").alias("_source")).agg(F.first("epochs").alias("_epochs"), last), "cuts"
    )
    inner = docs.toDF(*names)
    at = dict(zip(docs.columns, names))
    text = F.col(at["text"])
    sized = inner.select(
        "*", F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["source"]).cast("string").alias("source"),
        word_count(text).alias("size"), _key(at["doc_id"], at["text"]).alias("key"),
    )
    rows = sized.where("size > 0").join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("pos", _position())
    part = (
        F.when(F.col("_last").isNull() | (F.col("pos") > F.col("_last.pos")), 0)
        .when(F.col("pos") == F.col("_last.pos"), F.col("_last.part"))
        .otherwise(F.col("size"))
    )
    copies = F.concat(
        F.array_repeat(F.col("size"), F.col("_epochs").cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>"))
    )
    words = F.slice(F.split(F.regexp_replace(text, "^" + _GAP, ""), _GAP), 1, F.col("_cut").cast("int"))
    cut = F.when(F.col("_cut") == F.col("size"), text).otherwise(F.array_join(words, " "))
    out = rows.withColumn("_cut", F.explode(copies)).withColumn("_text", cut)
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(at[c])).alias(c) for c in docs.columns])
