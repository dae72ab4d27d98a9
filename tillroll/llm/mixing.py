"""Mixing sources to target weights, exactly to the budget.

Every document gets a hash-random key; within each source the documents lie in
key order and a distributed prefix sum over their sizes says where the
source's budget cuts.  A source whose budget exceeds its size runs whole
epochs first; the rest is cut from the front of the key order.  The document
at the cut gives the part of its words that the budget still has room for.

Targets: the sources in code point order (NULL last) weigh 1, 2, 3, repeating
(or as given) and share all words; a target stops at ``max_epochs`` times its
source's size and the excess goes to the others by weight (water-filling,
solved exactly by sorting the sources by size over weight).

Only DataFrame expressions.  A source is spread over as many slices of the key
space as it needs, so a hot source is not one task.

Defined cases: NULL and empty texts have size 0, and nothing of them is taken;
very long texts are only counted, row by row; NULL source is a source of its own,
last;
repeated rows are separate documents (ties in the key are broken by doc_id and
size; fully equal rows are interchangeable); an empty table gives an empty
result; other columns pass through ``mix`` untouched.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, random_key, running_total, save

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> adds weight and target (one row per source)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("_cap", F.col("source_size") * max_epochs)
    # the sources in the order of cap over weight: the level if all before one
    # are capped is what remains over the weights that remain.  It rises while
    # caps lie below their shares and falls from there, so the largest is it
    filling = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    up_to = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(up_to), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up_to), F.lit(0))
    s = s.withColumn("_level", left / weight_left)
    s = s.withColumn("_lambda", F.max("_level").over(every))
    return s.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_lambda") * F.col("weight"))).drop("_cap", "_level", "_lambda")


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(doc_id, source, key, size) of every document plus source_size, target,
    ``epochs`` (whole copies) and ``taken`` (words over all copies)."""
    sized = save(docs.select("doc_id", "source", random_key("doc_id", seed=seed).alias("key"),
                             word_count(F.col("text")).alias("size")), "mix-sizes")
    per_source = save(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")), "mix-sources")
    goals = targets(per_source.drop("_rows"), weights, max_epochs)
    largest = per_source.agg(F.max("_rows")).first()[0] or 1  # one number decides the slicing, not the result
    # the square root: a slice's rows and a source's slices are then equally many
    placed = running_total(sized, ["source"], ["key", "doc_id", "size"], F.col("size"), math.ceil(math.sqrt(largest)), total="_source_total")
    goals = goals.select(F.col("source").alias("_source"), "source_size", "target")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.least(rest - F.col("before"), F.col("size")), F.lit(0))
    return (placed.join(goals, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("epochs", epochs)
            .withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))
            .drop("_source", "_source_total", "before"))


def oracle(seed: str = "mix", docs: str = "documents") -> str:
    """DuckDB SQL for op6's rows."""
    return rf"""
WITH sized AS (SELECT doc_id, source, md5('{seed}|' || coalesce(doc_id::VARCHAR, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {docs}),
src AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source),
lev AS (SELECT *, {MAX_EPOCHS} * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum({MAX_EPOCHS} * source_size) OVER w, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
    FROM src WINDOW w AS (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM lev),
cut AS (SELECT s.*, source_size, target, floor(target)::BIGINT AS budget,
    CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
    FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
    (epochs * size + greatest(least(budget - epochs * source_size - before, size), 0))::BIGINT AS taken FROM cut"""


def op6(spark, sf_dir: str) -> DataFrame:
    from tillroll.llm.common import read

    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
