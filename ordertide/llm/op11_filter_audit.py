"""Operator 11: what five quality filters remove, alone and in every order.

Filters (a document fails if): A under 50 words; B 100 * distinct words
< 65 * words; C 100 * capitals A-Z > 5 * code points; D holds any of
``#$%&*|``; E identical to the text of a smaller doc_id in the whole table.

* *postings* - every row gets an id; per part (source), id range and filter the
  ascending ids of the rows that fail it, and in the same way the ids labelled
  good and toxic.  A range holds at most ``RANGE`` ids, so a part with most
  rows is many ranges, and a list is never longer than that;
* *merges* - inside a range the union of every set of filters is one k-way
  merge of their lists and what a filter removes after the set is the
  difference of its list and that union.  Both gallop: from the current place
  the step doubles until it passes the other list's head, then a binary search
  ends it, so runs are copied whole and lists of unequal length cost little;
* *sums* - sizes are added per (part, set of filters applied, filter), 75 rows
  and five whole lists a part, and joined to the 600 steps of the 120 orders.

Defined results: a null text is empty, a null source is the part ''; a row
with a null doc_id has no label, never fails E and makes no other row fail it;
rows that repeat a doc_id count each by itself and don't fail E through one
another; of several labels of a doc_id any 1 counts; very long texts are read
whole; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heapreplace
from itertools import combinations, permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ordertide.llm import common as C

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITALS_PERCENT = 5
MARKED = "#$%&*|"
RANGE_BITS = 16  # ids of a range: 2^16 consecutive ones
HOT_SALTS = 64  # ways a text with very many copies is dealt
HOT_COPIES = 10_000

SETS = [frozenset(s) for n in range(len(FILTERS) + 1) for s in combinations(FILTERS, n)]


# -- flags ----------------------------------------------------------------------
def flags(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text."""
    words = F.regexp_extract_all(text, F.lit(C.WORD_PATTERN), F.lit(0))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, C.UPPER, ""))
    marked = F.lit(False)
    for c in MARKED:
        marked = marked | F.contains(text, F.lit(c))
    return {
        "A": n < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < n * DISTINCT_PERCENT,
        "C": capitals * 100 > F.length(text) * CAPITALS_PERCENT,
        "D": marked,
    }


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: id, part, the flags A to E, good, toxic."""
    spark = docs.sparkSession
    folder = C.scratch(spark, "filter-audit")
    text = F.coalesce(F.col("text"), F.lit(""))
    found = [flag.alias(name) for name, flag in flags(text).items()]
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    rows = docs.select("doc_id", part, *found, F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("sha"))
    # Written once: the ids are then fixed, whatever is computed again later.
    rows.withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marks = marks.filter("good OR toxic").withColumnRenamed("doc_id", "_doc")
    rows = with_copies(rows)
    rows = rows.join(marks, F.col("doc_id") == F.col("_doc"), "left")
    no = F.lit(False)
    return rows.select("id", "part", *FILTERS, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, key, sha, ...) with E: a smaller doc_id has the text.

    Only rows that the bitmap can't clear take part in a join; texts with very
    many copies are dealt over ``HOT_SALTS`` groups.
    """
    groups = C.cut(
        rows.filter("doc_id IS NOT NULL").groupBy("key", "sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )
    renamed = groups.select(F.col("key").alias("_key"), F.col("sha").alias("_sha"), "first", "copies")
    seen = C.flag_maybe(rows, "key", groups, "key")
    alone = seen.filter("NOT _maybe").drop("_maybe").withColumn("E", F.lit(False))
    seen = C.flag_maybe(seen.filter("_maybe").drop("_maybe"), "key", groups.filter(F.col("copies") > HOT_COPIES), "key", flag="_hot")
    # A row that may be of a hot text looks in a group of its own salt; every
    # text that such a row can have is there under all salts.
    hot = C.flag_maybe(renamed, "_key", groups.filter(F.col("copies") > HOT_COPIES), "key", flag="_hot")
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = hot.select("_key", "_sha", "first", F.explode(salts).alias("_salt"))
    own = F.when(F.col("_hot"), F.pmod(F.col("id"), F.lit(HOT_SALTS)).cast("int")).otherwise(F.lit(0))
    on = (F.col("key") == F.col("_key")) & (F.col("sha") == F.col("_sha")) & (F.col("salt") == F.col("_salt"))
    joined = seen.withColumn("salt", own).join(spread, on, "left")
    copied = joined.withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    return alone.unionByName(copied.select(*alone.columns))


# -- postings ---------------------------------------------------------------------
def postings(rows: DataFrame) -> DataFrame:
    """Per (part, range): the number of its rows and the ascending failing ids
    of every filter, the good and the toxic ids."""

    def ids(flag: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(flag), F.col("id"))))

    lists = [ids(name).alias(name) for name in (*FILTERS, "good", "toxic")]
    block = F.shiftrightunsigned("id", RANGE_BITS).alias("block")
    return rows.groupBy("part", block).agg(F.count(F.lit(1)).alias("docs"), *lists)


def gallop(ids: list[int], at: int, bound: int) -> int:
    """First place from ``at`` on whose id is not below ``bound``."""
    step, end = 1, len(ids)
    while at + step < end and ids[at + step] < bound:
        at, step = at + step, step * 2
    return bisect_left(ids, bound, at, min(at + step + 1, end))


def union(lists: list[list[int]]) -> list[int]:
    """Ascending ids of any of the ascending ``lists``."""
    heads = [(ids[0], k, 0) for k, ids in enumerate(lists) if ids]
    heapify(heads)
    out: list[int] = []
    while len(heads) > 1:
        head, k, at = heads[0]
        ids = lists[k]
        other = min(heads[1], heads[2])[0] if len(heads) > 2 else heads[1][0]
        if head == other:  # the other list brings it
            end = at + 1
        else:
            end = gallop(ids, at, other)
            out += ids[at:end]
        if end < len(ids):
            heapreplace(heads, (ids[end], k, end))
        else:
            heads[0] = heads[-1]
            heads.pop()
            heapify(heads)
    for _, k, at in heads:
        out += lists[k][at:]
    return out


def difference(ids: list[int], gone: list[int]) -> list[int]:
    """Ascending ``ids`` that aren't in the ascending ``gone``."""
    out: list[int] = []
    at = there = 0
    while at < len(ids) and there < len(gone):
        if ids[at] < gone[there]:
            end = gallop(ids, at, gone[there])
            out += ids[at:end]
            at = end
        elif ids[at] > gone[there]:
            there = gallop(gone, there, ids[at])
        else:
            at, there = at + 1, there + 1
    return out + ids[at:]


def common(a: list[int], b: list[int]) -> int:
    """Number of ids in both ascending lists."""
    if len(a) > len(b):
        a, b = b, a
    n = there = 0
    for x in a:
        there = gallop(b, there, x) if there < len(b) else there
        if there == len(b):
            break
        n += b[there] == x
    return n


def sizes(failing: dict[str, list[int]], good: list[int], toxic: list[int]) -> Iterator[tuple[str, str, int, int, int]]:
    """(filters applied, filter, removed, good and toxic among them) for every
    set of filters and every filter outside it."""
    for applied in SETS:
        gone = union([failing[f] for f in sorted(applied)])
        for f in FILTERS:
            if f not in applied:
                lost = difference(failing[f], gone)
                yield "".join(sorted(applied)), f, len(lost), common(lost, good), common(lost, toxic)


_SIZES = "part string, applied string, filter string, docs long, failing long, removed long, good_lost long, toxic_lost long"


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for r in batch.to_dict("records"):
            failing = {f: list(r[f]) for f in FILTERS}
            rows = [
                (r["part"], applied, f, r["docs"], len(failing[f]), *counts)
                for applied, f, *counts in sizes(failing, list(r["good"]), list(r["toxic"]))
            ]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SIZES.split(", ")])


# -- report -----------------------------------------------------------------------
def steps(spark: SparkSession) -> DataFrame:
    """The 600 steps of the 120 orders: filter_order, step, applied, filter."""
    rows = [("".join(p), k + 1, "".join(sorted(p[:k])), p[k]) for p in permutations(FILTERS) for k in range(len(FILTERS))]
    return spark.createDataFrame(rows, "filter_order string, step int, applied string, filter string")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the module's head."""
    spark = docs.sparkSession
    per_range = postings(flagged(docs, labels)).mapInPandas(_merged, _SIZES)
    whole = ("docs", "failing", "removed", "good_lost", "toxic_lost")
    per_set = C.cut(per_range.groupBy("part", "applied", "filter").agg(*[F.sum(c).alias(c) for c in whole]))
    n = len(FILTERS)
    # A set of k filters comes before a filter in k! (n-1-k)! of the orders.
    orders = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), F.length("applied") + 1)
    per_filter = per_set.groupBy(F.col("part").alias("_part"), F.col("filter").alias("_filter")).agg(
        F.sum(F.col("removed") * orders).alias("shapley"),
        F.max(F.when(F.length("applied") == n - 1, F.col("removed"))).alias("unique_fails"),
    )
    on = (F.col("part") == F.col("_part")) & (F.col("filter") == F.col("_filter"))
    # 600 rows, fixed.
    out = per_set.join(per_filter, on).join(F.broadcast(steps(spark)), ["applied", "filter"])
    gone = F.sum("removed").over(_until_here())
    return out.select(
        "part",
        "filter_order",
        "step",
        (F.col("docs") - gone).cast("long").alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.col("shapley").cast("long").alias("shapley"),
    )


def _until_here() -> WindowSpec:
    return Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


ORACLE = f"""
WITH t AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '{C.WORD_PATTERN}') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {CAPITALS_PERCENT} * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(w.doc_id > first, false) THEN 16 ELSE 0 END AS mask
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id
), m AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), b AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS x(letter, bit)
), o AS (
  SELECT a.letter || b2.letter || c.letter || d.letter || e.letter AS filter_order
  FROM b a, b b2, b c, b d, b e
  WHERE a.bit + b2.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b2.bit | c.bit | d.bit | e.bit = 31
), s AS (
  SELECT filter_order, step, b.bit,
    (SELECT coalesce(sum(p.bit), 0) FROM b p WHERE strpos(filter_order, p.letter) < step) AS gone
  FROM o, range(1, 6) AS r(step), b WHERE b.letter = substr(filter_order, step, 1)
), c AS (
  SELECT m.part, filter_order, step, s.bit,
    sum(CASE WHEN mask & CAST(gone AS INTEGER) = 0 AND mask & s.bit = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(gone AS INTEGER) = 0 AND mask & s.bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & CAST(gone AS INTEGER) > 0 AND mask & s.bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = s.bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & CAST(gone AS INTEGER) = 0 AND mask & s.bit > 0 THEN m.good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(gone AS INTEGER) = 0 AND mask & s.bit > 0 THEN m.toxic ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY m.part, filter_order, step, s.bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM c
"""
