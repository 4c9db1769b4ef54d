"""Mixing sources to target weights by capped water-filling, in DataFrame operations only.

Targets: every source gets its weight's share of the budget.  A source whose share
exceeds its cap (``max_epochs`` times its size) is clamped there, and the excess goes
to the others by weight, until no share exceeds its cap.  Each round is one
aggregation over the table of sources; only its sums reach the driver.

Sampling: a document is taken the whole part of its source's epochs (target / size),
and once more if it lies in the fraction that a seeded order of the source's
documents selects.  The order is cut where the words taken come nearest to the target:
a histogram over the first ``HEX`` digits of the order finds the cut's cell, and only
that cell's documents are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, packed, unpacked, word_count
from .ranks import ranked

HEX = 3


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, rank)``, ranked from 0 by code point with null last.

    Sources are ranked inside range partitions, which are then offset by the counts
    of those before; no task holds them all.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    is_null = F.col("source").isNull()
    spread = totals.repartitionByRange(is_null, "source").withColumn("part", F.spark_partition_id())
    # Written, since a recomputed range partitioning may cut elsewhere.
    placed = materialize(spread, "sources")
    inside = Window.partitionBy("part").orderBy(is_null, "source")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = placed.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, "part")
    return ranked.select("source", "source_size", (F.col("offset") + F.col("inside")).alias("rank"))


def water_fill(sources: DataFrame, budget_share: float, max_epochs: int) -> DataFrame:
    """``sources(source, source_size, weight)`` with ``target`` added.

    Weights must be positive.  The level (words per unit of weight) only rises, so a
    clamped source stays clamped; the loop ends after as many rounds as sources at most.
    """
    cap = F.col("source_size") * max_epochs
    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = budget_share * whole
    level, clamped = 0.0, -1
    while True:
        # Empty sources are clamped at 0 from the start.
        is_clamped = (F.col("weight") * F.lit(level) > cap) | (F.col("source_size") == 0)
        used, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(is_clamped, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_clamped, F.col("weight"))), F.lit(0)),
            F.count(F.when(is_clamped, 1)),
        ).first()
        if n == clamped or weight == 0:
            break
        level, clamped = (budget - used) / weight, n
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(is_clamped | (share > cap), cap.cast("double")).otherwise(share))


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded place of a document in its source; rows without an id go by their text."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), name))


def measures(docs: DataFrame, seed: int, id_column: str, text_column: str, source_column: str) -> dict[str, Column]:
    """What decides how often a row is taken: its id, source, words and place."""
    doc_id, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`").cast("string")
    return {
        "doc_id": doc_id,
        "source": F.col(f"`{source_column}`").cast("string"),
        "size": word_count(text),
        "key": order_key(doc_id, text, seed),
    }


def mix_counts(
    docs: DataFrame,
    weights: Sequence[int],
    budget_share: float,
    max_epochs: int = 2,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How often each document is taken, so that sources reach their target words.

    Sources in code point order (null last, as a source of its own) have the weights
    in turn.  Their targets share ``budget_share`` of all words and stop at
    ``max_epochs`` times their size.  Returns one row per input row: ``doc_id``,
    ``source``, ``key``, ``size`` (words), ``source_size``, ``target``, ``repeats``
    (0 to ``max_epochs``) and ``taken`` (``size * repeats``).

    * Null and empty texts and texts without words have size 0; they are taken the
      whole part of their source's epochs, which moves no words.
    * Sources without words have the target 0 and repeat nothing.
    * Rows without an id are ordered by their text.  Rows equal in id, source and size
      are interchangeable; of those at the cut as many are taken as are needed.
    * Other columns are not read; an empty table gives an empty result.
    * The words taken of a source miss its target by half of one document at most.
    """
    own = measures(docs, seed, id_column, text_column, source_column)
    sizes = materialize(docs.select(*[c.alias(n) for n, c in own.items()]), "sizes")
    joined = repeated(sizes, source_plan(sizes, weights, budget_share, max_epochs))
    return joined.select(
        "doc_id", "source", "key", "size", "source_size", "target", "repeats",
        (F.col("size") * F.col("repeats")).cast("long").alias("taken"),
    )


def source_plan(sizes: DataFrame, weights: Sequence[int], budget_share: float, max_epochs: int) -> DataFrame:
    """Per source ``of``: target, whole epochs and where its seeded order is cut."""
    ranked = ranked_sources(sizes)
    turn = F.array(*[F.lit(w) for w in weights])
    weighted = ranked.withColumn("weight", turn[(F.col("rank") % len(weights)).cast("int")])
    plan = water_fill(materialize(weighted, "sources"), budget_share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(epochs))
    plan = plan.withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = plan.select(F.col("source").alias("of"), "source_size", "target", "whole", "extra")

    # The cell in which the running total of the seeded order passes the extra words.
    cell = F.substring("key", 1, HEX)
    cells = sizes.where("size > 0").groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
    cells = cells.withColumn("upto", running)
    same = F.col("source").eqNullSafe(F.col("of"))
    cut = cells.join(plan.where("extra > 0"), same).where("upto >= extra and upto - words < extra")
    cut = cut.select("source", F.col("cell").alias("cut"), (F.col("upto") - F.col("words")).alias("before"), "extra")

    # Rank the documents of that cell alone; the one that crosses is taken if that is nearer.
    inside = sizes.where("size > 0").withColumn("cell", cell).alias("d").join(
        cut.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.cell") == F.col("c.cut"))
    )
    order = Window.partitionBy("d.source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.col("before") + F.sum("size").over(order))
    chosen = F.col("upto") - F.col("size") / 2 <= F.col("extra")
    equal = inside.groupBy("d.source", "key", "doc_id", "size")
    equal = equal.agg(F.count_if(chosen).alias("ties"), F.count("*").alias("same")).where("ties > 0")
    last = equal.groupBy("source").agg(F.max(F.struct("key", "doc_id", "size", "ties", "same")).alias("last"))
    last = last.select(F.col("source").alias("last_of"), "last")
    cut = cut.select(F.col("source").alias("cut_of"), "cut")
    plan = plan.join(cut, F.col("of").eqNullSafe(F.col("cut_of")), "left")
    plan = plan.join(last, F.col("of").eqNullSafe(F.col("last_of")), "left")
    return materialize(plan.select("of", "source_size", "target", "whole", "extra", "cut", "last"), "plan")


def repeated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's plan and their own ``repeats``.

    ``last`` of the plan is the last row in the seeded order that is taken once more, with
    the number of rows equal to it (``same``) and how many of these are taken (``ties``).
    """
    cell, here = F.substring("key", 1, HEX), F.struct("key", "doc_id", "size")
    last = F.struct("last.key", "last.doc_id", "last.size")
    inside = F.coalesce((F.col("extra") > 0) & (cell == F.col("cut")), F.lit(False))
    more = ((F.col("extra") > 0) & (cell < F.col("cut"))) | (inside & (here <= last))

    def counted(some: DataFrame, once_more: Column) -> DataFrame:
        extra = F.when(F.coalesce(once_more, F.lit(False)), 1).otherwise(0)
        return some.withColumn("repeats", (F.col("whole") + extra).cast("int"))

    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    if plan.where("last.same > last.ties").isEmpty():
        return counted(joined, more)
    # Some sources are cut between equal rows; these are numbered, however many they are.
    edge = F.coalesce(inside & (here == last) & (F.col("last.same") > F.col("last.ties")), F.lit(False))
    numbered = ranked(joined.where(edge), ["of"], ["key"], "mix-edge")
    split = counted(numbered, F.col("rank") < F.col("last.ties")).drop("rank")
    return counted(joined.where(~edge), more).unionByName(split)


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[int],
    budget_share: float,
    max_epochs: int = 2,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``docs`` with every row repeated by its own count of ``mix_counts``; others go.

    Rows without an id, and rows that share one, are counted by themselves, so the words
    of each source are those that ``mix_counts`` takes.  Nulls, empty texts, repeated rows
    and an empty table are treated as there; extra columns may have any name.
    """
    own = measures(docs, seed, id_column, text_column, source_column)
    sizes = materialize(docs.select(*[c.alias(n) for n, c in own.items()]), "sizes")
    counted = repeated(packed(docs, **own), source_plan(sizes, weights, budget_share, max_epochs))
    counted = counted.where("repeats > 0")
    return unpacked(counted.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats")))), docs.columns)


def mixed(docs: DataFrame, counts: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with every document repeated as often as ``counts`` says; others go.

    Rows of ``docs`` that share an id are repeated alike, by the largest count of the
    id.  Rows without an id are dropped: nothing tells which count is theirs.  Where
    ids may be null or shared, ``mixed_rows`` repeats each row by its own count.
    """
    per_id = counts.groupBy(F.col("doc_id").alias("of")).agg(F.max("repeats").alias("repeats"))
    rows = packed(docs, id=F.col(f"`{id_column}`").cast("long"))
    joined = rows.join(per_id.where("repeats > 0"), F.col("id") == F.col("of"))
    times = joined.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return unpacked(times, docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size * 2) OVER f AS caps, sum(w) OVER f AS ws,
         row_number() OVER (ORDER BY source_size * 2.0 / w, source NULLS LAST) AS i
  FROM s WINDOW f AS (ORDER BY source_size * 2.0 / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM s) - coalesce(caps, 0)::DOUBLE)
         / ((SELECT sum(w) FROM s) - coalesce(ws, 0))::DOUBLE AS level, source_size * 2.0::DOUBLE / w AS most, i
  FROM o),
level AS (SELECT level FROM l WHERE level <= most ORDER BY i LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN w * coalesce((SELECT level FROM level), 1e300) > source_size * 2
              THEN (source_size * 2)::DOUBLE ELSE w * (SELECT level FROM level) END AS target
  FROM s),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS extra
  FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.whole, e.extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS FIRST, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN extra > 0 AND upto - size / 2.0 <= extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
