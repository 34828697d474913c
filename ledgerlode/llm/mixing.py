"""Mixing sources to target weights: how many words of each document a training mix takes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlode.llm.totals import bucket_count, running_totals
from ledgerlode.sources.files import stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
#: Sampling weight of a document by its quality label; unlabelled documents have 1.
QUALITY_WEIGHT = {1: 2.0, 0: 0.5}
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``source_rank`` and ``target`` to one row per source with its ``source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes. No
    target exceeds ``max_epochs`` times its source; what is cut off goes to the others by weight. Sorted by
    the level at which a source is full, the full ones come first, and the common level is the
    largest of the levels reached by filling one source more.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("source_rank") - 1) % len(weights) + 1).cast("int"))
    full = Window.orderBy("__full_at", "source_rank")
    everything = Window.partitionBy()
    level = (F.col("__total") - F.col("__full_before")) / F.col("__weight_left")
    return (sources.withColumn("source_rank", F.row_number().over(by_name).cast("long"))
            .withColumn("__weight", weight)
            .withColumn("__cap", F.col("source_size") * max_epochs)
            .withColumn("__full_at", F.col("__cap") / F.col("__weight"))
            .withColumn("__total", F.sum("source_size").over(everything))
            .withColumn("__full_before", F.coalesce(F.sum("__cap").over(
                full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("__weight_left", F.sum("__weight").over(
                full.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("__level", F.max(level).over(everything))
            .withColumn("target", F.least(F.col("__cap").cast("double"),
                                          F.col("__weight") * F.col("__level")))
            .drop("__weight", "__cap", "__full_at", "__total", "__full_before", "__weight_left",
                  "__level"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) out of the document's id, the same in any engine that has MD5."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))),
                                1, 13), 16, 10)
    return (digits.cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def mix(documents: DataFrame, labels: DataFrame | None = None, weights: Sequence[float] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: str = "mix-", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``, after the columns ``carry``.

    A source takes as many complete epochs as its target holds. The rest of the target goes to its
    documents in the order of exponential keys -ln(u) / w (the Efraimidis-Spirakis order), where u comes
    from the id and w from the quality label, while they fit; the document at the edge gives the words
    that are left. So a source takes its target to the word. ``copies`` is ``taken`` in whole documents,
    halves up.

    A null or blank text has size 0 and takes nothing; its copies are the complete epochs. A null source
    is a source of its own. Rows with equal keys follow each other by doc_id, then size; repeated rows
    count separately. A missing or null label weighs 1; of several labels of one document the largest
    counts. Other columns are ignored. Empty tables give no rows. Sources are counted as one row each in
    one task; documents are never gathered by source (``running_totals``).
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = documents.select(*carry, "doc_id", "source", size.alias("size"))
    if labels is None:
        sized = sized.withColumn("__weight", F.lit(1.0))
    else:
        marks = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
                       .agg(F.max("quality").alias("__quality")))
        weight = F.lit(1.0)
        for value, w in QUALITY_WEIGHT.items():
            weight = F.when(F.col("__quality") == value, F.lit(w)).otherwise(weight)
        sized = (sized.join(marks, "doc_id", "left").withColumn("__weight", weight)
                      .drop("__quality"))
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.col("__weight")
    sized = stored(sized.withColumn("__key", key).drop("__weight"), "mix-sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                          F.count(F.lit(1)).alias("__rows"))
    targets = stored(source_targets(sources, weights, max_epochs)
                     .withColumn("__buckets", bucket_count(F.col("__rows")))
                     .withColumnRenamed("source", "__source").drop("__rows"), "mix-sources")
    placed = (sized.join(targets, F.col("source").eqNullSafe(F.col("__source")))
                   .withColumn("__unit", 1 - F.exp(-F.col("__key"))))
    ordered = running_totals(placed, "source_rank", "__buckets", "__unit",
                             ["__key", "doc_id", "size"], "size", "__taken_before")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.floor(F.col("target") - F.col("__epochs") * F.col("source_size")).cast("long")
    taken = F.col("__epochs") * F.col("size") + F.greatest(
        F.lit(0), F.least(F.col("size"), left - F.col("__taken_before")))
    return (ordered.withColumn("__epochs", epochs)
            .withColumn("taken", taken.cast("long"))
            .withColumn("copies", F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5))
                                   .otherwise(F.col("__epochs")).cast("long"))
            .select(*carry, "doc_id", "size", "source_size", "target", "taken", "copies"))


MIX_SQL = r"""
WITH marks AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         -ln((('0x' || substr(md5('mix-' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
             / 4503599627370496.0)
         / CASE m.quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS k
  FROM documents d LEFT JOIN marks m USING (doc_id)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r
  FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(r - 1) % 3 + 1] AS w, source_size * 3 AS cap FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM weighed),
targets AS (SELECT source, source_size, least(cap::DOUBLE, w * max(lvl) OVER ()) AS target FROM levels),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, (epochs * size + greatest(0, least(size, floor(target - epochs * source_size)::BIGINT - before)))::BIGINT
            AS taken FROM ordered)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN size > 0 THEN floor(taken::DOUBLE / size + 0.5) ELSE epochs END::BIGINT AS copies
FROM mixed
"""
