"""Mixing sources to target weights by capped water-filling.

Every source asks for its weight's part of the wanted size. A source that would be read more than
``max_epochs`` times is clamped there, and what it leaves is shared again by weight, until no source
is above its cap. Whole repetitions are the same for all documents of a source; the fraction that is
left goes to the documents that come first in a seeded order, up to the one that brings the sum
nearest to the target, so the words taken are off by half a document at most.

Nulls: a null text has size 0, a null source is a source of its own (the last one). Rows with equal
ids are one place in the order and share one decision. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscore.llm.common import WORD, unpack, with_row
from payscore.shared import Stored, lookup, numbered, store

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = 17

_PLAN = ["source_size", "target", "whole", "cut_key", "cut_size"]


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, seed: int) -> Column:
    """The seeded order of documents, the same on every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_key(source: Column) -> Column:
    """A source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def water_level(sources: DataFrame, wanted: float) -> float:
    """The size that one unit of weight gets, from rows (weight, cap).

    Each round clamps the sources above their caps and shares the rest anew; the clamped set only
    grows. A round is one small aggregate over the sources, however many there are.
    """
    level, clamped = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        row = sources.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)).alias("caps"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
        ).first()
        if row["n"] == clamped or row["weights"] is None:
            return level or 0.0
        clamped, level = row["n"], (wanted - row["caps"]) / row["weights"]


@dataclass(frozen=True)
class Mix:
    """What is taken of each source: whole repetitions, and the last place in the order of one more."""

    sources: Stored
    seed: int

    def decide(self, rows: DataFrame) -> DataFrame:
        """Adds the source's plan and ``copies`` to rows with ``_source``, ``_key`` and ``_size``."""
        found = lookup(rows, self.sources, {"_source": "source"})
        extra = (F.col("_key") < F.col("cut_key")) | (
            (F.col("_key") == F.col("cut_key")) & (F.col("_size") <= F.col("cut_size"))
        )
        return found.withColumn("copies", F.col("whole") + F.coalesce(extra.cast("long"), F.lit(0)))


def plan(
    sized: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> Mix:
    """The mix of rows (source, key, size), where ``source`` is a :func:`source_key`."""
    sums = store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), 128)
    # The null source is coded as the empty text; it comes last all the same.
    order = [F.col("source") == "", F.col("source")]
    ranked = numbered(Stored(sums.df.withColumn("all", F.lit(0)), sums.rows, 128), "all", order, "rank")
    cycle = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    caps = store(ranked.select("source", "source_size", cycle.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), 160)
    total = caps.df.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(caps.df, share * total)
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("cap").cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = caps.df.withColumn("target", target).withColumn("whole", whole)
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = store(targets.select("source", "source_size", "target", "whole", "rest"), 160)
    return Mix(store(_cuts(sized, targets), 240), seed)


def _cuts(sized: DataFrame, targets: Stored) -> DataFrame:
    """Where the extra repetition of each source ends in the seeded order.

    The order is cut in 65,536 buckets. Sums over buckets say in which one the cut lies; only that
    bucket's documents are added up one by one.
    """
    bucket = F.substring("key", 1, 4)
    some = lookup(sized, targets.select("source", "rest"), {"source": "source"}).where("rest > 0").withColumn("bucket", bucket)
    sums = some.groupBy("source", "bucket").agg(F.sum("size").alias("held"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("held").over(upto) - F.col("held"))
    cut = sums.where("before <= rest").groupBy("source").agg(F.max(F.struct("bucket", "before")).alias("cut"))
    cut = store(cut.select("source", F.col("cut.bucket").alias("bucket"), F.col("cut.before").alias("before")), 128)
    near = some.join(cut.df.withColumnsRenamed({"source": "s", "bucket": "b"}), (F.col("s") == F.col("source")) & (F.col("b") == F.col("bucket")))
    walk = Window.partitionBy("source", "bucket").orderBy("key", "size")
    before = F.col("before") + F.sum("size").over(walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    near = near.withColumn("taken", 2 * before + F.col("size") <= 2 * F.col("rest"))
    last = near.where("taken").groupBy("source").agg(F.max(F.struct("key", "size")).alias("last"))
    # With no document taken in the cut bucket, all buckets before it are.
    ends = cut.df.join(last, "source", "left").select(
        "source",
        F.coalesce("last.key", "bucket").alias("cut_key"),
        F.coalesce("last.size", F.lit(-1)).cast("long").alias("cut_size"),
    )
    return targets.df.drop("rest").join(ends, "source", "left").select("source", *_PLAN)


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The decision on each document: doc_id, size, source_size, target, taken."""
    size, key = size_of(F.col("text")), order_key(F.col("doc_id"), seed)
    sized = store(docs.select("doc_id", source_key(F.col("source")).alias("_source"), key.alias("_key"), size.alias("_size")), 96).df
    made = plan(sized.select(F.col("_source").alias("source"), F.col("_key").alias("key"), F.col("_size").alias("size")), weights, share, max_epochs, seed)
    return made.decide(sized).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("copies")).alias("taken")
    )


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    size, key = size_of(F.col("text")), order_key(F.col("doc_id"), seed)
    sized = store(docs.select(source_key(F.col("source")).alias("source"), key.alias("key"), size.alias("size")), 96).df
    made = plan(sized, weights, share, max_epochs, seed)
    rows = with_row(docs, _source=source_key(F.col("source")), _key=key, _size=size)
    # Not a left-over of zero: such documents are not in the mix.
    many = made.decide(rows).where("copies > 0")
    return unpack(many.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    from payscore.llm.common import table

    return mix(table(spark, sf_dir, "documents"))


#: The same closed form: sources sorted by cap over weight, the clamped ones being the first.
OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), caps AS (
  SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM sums
), filled AS (
  SELECT *, {SHARE} * sum(source_size) OVER () AS wanted,
         coalesce(sum(cap) OVER w, 0) AS caps_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights_left
  FROM caps
  WINDOW w AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT min_by((wanted - caps_before)::DOUBLE / weights_left, cap / weight)
           FILTER (weight * ((wanted - caps_before)::DOUBLE / weights_left) <= cap) AS level
  FROM filled
), targets AS (
  SELECT source, source_size, least(weight * level, cap::DOUBLE) AS target FROM caps, level
), wholes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), walked AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized d JOIN wholes t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM walked
"""
