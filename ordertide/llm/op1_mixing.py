"""Operator 1: mixing sources to target weights by systematic sampling.

Every source gets a target number of words; a document of the source is
expected ``target / source words`` times in the mix.  The expected copies are
prefix-summed inside the source (documents ordered by size), one random offset
is added, and a document is emitted once per integer boundary its interval
crosses.  Ordering by size makes the words taken follow the target closely:
the error is at most about the size of one document.

Targets: weights share all words; a target stops at ``max_repeat`` times the
source's words, and the excess goes to the other sources by weight until none
is above (water filling, computed exactly from the sorted limits).

Defined results: a null text has size 0; a null source is one source, ordered
last; sources without words get target 0 and no copies; repeated rows are
separate documents; an empty table gives an empty mix; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordertide.llm import common as C

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEAT = 3
SEED = 17


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """One row per source: words, target, expected copies and offset.

    The windows run over one row per source (a sum of ``sizes``), never over
    documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    at = ((F.col("ord") - 1) % len(weights)).cast("int")
    s = totals.select("source", "source_size", F.row_number().over(by_code_point).alias("ord"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1))
    s = s.withColumn("most", F.col("source_size") * F.lit(float(max_repeat)))
    # Sources sorted by how soon the rising water meets their limit.
    rising = Window.orderBy((F.col("most") / F.col("weight")), "ord")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    s = s.withColumn("turn", F.row_number().over(rising))
    # The first source that the level of its turn leaves below its limit: it
    # and all after it stay at that level times their weight.
    s = s.withColumn("open", F.min(F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("turn"))).over(whole))
    s = s.withColumn("open_level", F.max(F.when(F.col("turn") == F.col("open"), F.col("level"))).over(whole))
    target = F.when(F.col("open_level").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("open_level") * F.col("weight")))
    s = s.withColumn("target", target)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return s.select("source", "source_size", "target", expected.alias("expected"), source_offset(F.col("source"), seed).alias("offset"))


def source_offset(source: Column, seed: int = SEED) -> Column:
    """The source's offset in [0, 1): the first 32 bits of a seeded digest of
    its name, so reruns draw the same and sources draw unlike ones."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("-"))))
    return F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def copies_by_rank(rank: Column, expected: Column, offset: Column, max_repeat: int = MAX_REPEAT) -> Column:
    """Integer boundaries crossed by the interval of the ``rank``-th document."""
    crossed = F.floor(rank * expected + offset) - F.floor((rank - 1) * expected + offset)
    return F.least(crossed, F.lit(max_repeat)).cast("long")


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    copies, taken.  Texts are read once, for their sizes."""
    sizes = docs.select("doc_id", "source", C.word_count(F.col("text")).alias("size"))
    rows = C.ranked(sizes, ["source"], [F.col("size"), F.col("doc_id")])
    rows = C.cut(rows)
    t = source_targets(rows, weights, max_repeat, seed)
    out = rows.join(
        t.select(F.col("source").alias("_s"), "source_size", "target", "expected", "offset"), F.col("source").eqNullSafe(F.col("_s"))
    )
    copies = copies_by_rank(F.col("rank"), F.col("expected"), F.col("offset"), max_repeat)
    out = out.withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each once per copy taken, with the
    columns of ``docs``.  Rows that share a doc_id keep their own copies: they
    are matched by their place among the rows of that doc_id, source and size,
    so rows without a doc_id don't meet in one task."""
    plan = plan_mix(docs, weights, max_repeat, seed)
    taken = ("_doc", "_from", "_long", "_place", "_times")
    nth, size, copy = (C.fresh(docs.columns, c) for c in ("_nth", "_size", "_copy"))
    doc, source, long, place, times = (C.fresh(docs.columns, c) for c in taken)
    alike = Window.partitionBy("doc_id", "source", size)
    left = docs.withColumn(size, C.word_count(F.col("text")))
    left = left.withColumn(nth, F.row_number().over(alike.orderBy(F.xxhash64("text"))))
    number = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("copies"))
    right = plan.withColumn(place, number).filter("copies > 0")
    right = right.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "source", "size", place, "copies"), (doc, source, long, place, times))])
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & F.col("source").eqNullSafe(F.col(source))
    both = left.join(right, same & (F.col(size) == F.col(long)) & (F.col(nth) == F.col(place)))
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(copy)
    return both.select(*[F.col(c) for c in docs.columns], once).drop(copy)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(C.table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{C.WORD_PATTERN}')) AS BIGINT) AS size FROM documents
), t AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS ord FROM t
), w AS (
  SELECT *, CAST((ord - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * CAST(3 AS DOUBLE) AS most FROM o
), l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
      - coalesce(sum(most) OVER (ORDER BY most / weight, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, ord ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), n AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, ord) AS turn FROM l
), f AS (
  SELECT *, min(CASE WHEN level * weight < most THEN turn END) OVER () AS open_turn FROM n
), m AS (
  SELECT *, max(CASE WHEN turn = open_turn THEN level END) OVER () AS open_level FROM f
), g AS (
  SELECT source, source_size, CASE WHEN open_level IS NULL THEN most ELSE least(most, open_level * weight) END AS target,
    CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce('=' || source, '-')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS offs FROM m
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected FROM g
), r AS (
  SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS rk FROM d
), c AS (
  SELECT r.doc_id, r.size, e.source_size, e.target,
    CAST(least(floor(rk * expected + offs) - floor((rk - 1) * expected + offs), 3) AS BIGINT) AS copies
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""
