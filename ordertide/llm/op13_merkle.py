"""Operator 13: Merkle manifest of a dataset as a content-addressed DAG.

Every row is a leaf: the sha256 of its five fields, each written as ``-`` if
null, else byte count, ``:``, value.  Per lang the leaves ascend by doc_id and
every eight consecutive nodes become their sha256 until one, the subroot,
remains; the subroots, by lang, are hashed up to the root the same way.

* *build* - ranks inside a lang come from range-dealt runs (``common.ranked``),
  so a lang with most rows is spread over many tasks; each level groups nodes
  by (lang, rank / 8), at most eight rows a group, and is written as records
  ``digest -> children``;
* *descent* - all requests start at the root and read their rank's base-8
  digits from the top: the record of the digest they stand at gives the
  children, the digit selects one, the unselected become a path segment.
  Requests that share their digits so far travel as one row, so a level has
  as many rows as the tree has nodes there, and no digest is a hot key;
* *leaves* - the leaf requests of one parent (at most eight) join its path;
  the segments, reversed, are the proof and fold the leaf back to the root.

What reaches the driver: the greatest number of leaves under a lang and the
number of langs (two longs, they give the number of levels).  The langs'
numbers are broadcast only when there are at most ``BROADCAST_LANGS``.

Defined results: a null lang is a lang of its own, first; a null doc_id comes
first in its lang and is never tampered with; rows with one doc_id are ordered
by their leaf, and equal rows are leaves of their own, in either order; empty
and very long texts are hashed whole; an empty table gives an empty result;
other columns are left out.  The records under the scratch folder are the
manifest and stay until their owner removes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
BROADCAST_LANGS = 10_000  # more langs than this are joined, not broadcast


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(text: Column) -> Column:
    """H of the row's fields, with ``text`` in place of its text."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def leaves(docs: DataFrame, folder: str) -> DataFrame:
    """Written rows (doc_id, lang, leaf, given): ``given`` is the leaf of the
    row as it is presented for checking, tampered or not."""
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0)
    lowered = F.translate(F.col("text"), C.UPPER, C.LOWER)
    leaf = leaf_digest(F.col("text"))
    given = F.when(tampered, leaf_digest(lowered))
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), given.alias("given"))
    rows.write.parquet(f"{folder}/leaves")
    rows = docs.sparkSession.read.parquet(f"{folder}/leaves")
    return rows.withColumn("given", F.coalesce("given", "leaf"))


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def build_levels(nodes: DataFrame, most: int, folder: str) -> DataFrame:
    """Hash ``nodes`` (tree, at, node, size of the tree) up to one a tree.

    Writes each level's records (tree, at, node, children, size) under
    ``folder`` and returns every tree's top: (tree, node, level).  ``most`` is
    the greatest number of nodes a tree has.
    """
    spark = nodes.sparkSession
    tops = None
    for level in range(height(most) + 1):
        top = nodes.filter("size = 1").select("tree", "node", F.lit(level).alias("level"))
        tops = top if tops is None else tops.unionByName(top)
        if level == height(most):
            return tops
        run = nodes.filter("size > 1").groupBy("tree", F.expr(f"at div {FANOUT}").alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("at", "node"))).alias("run"), F.first("size").alias("size")
        )
        children = F.col("run")["node"]
        records = run.select(
            "tree",
            F.col("up").alias("at"),
            digest(F.array_join(children, "")).alias("node"),
            children.alias("children"),
            F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"),
        )
        records.write.parquet(f"{folder}/level={level + 1}")
        nodes = spark.read.parquet(f"{folder}/level={level + 1}").select("tree", "at", "node", "size")


def descend(requests: DataFrame, folder: str, level: int) -> DataFrame:
    """One step down for requests (tree, at, node, path, *tops) standing at
    ``level``: a row per child, the unselected children put before the path."""
    records = requests.sparkSession.read.parquet(f"{folder}/level={level}").select("node", "children").distinct()
    tops = [c for c in ("subroot", "root") if c in requests.columns]
    found = requests.join(records, "node")
    one = found.select("tree", "at", "path", *tops, "children", F.posexplode("children").alias("digit", "child"))
    return one.select(
        "tree",
        *tops,
        (F.col("at") * FANOUT + F.col("digit")).alias("at"),
        F.col("child").alias("node"),
        F.concat(F.array(segment(F.col("children"), F.col("digit"))), F.col("path")).alias("path"),
    )


def segment(children: Column, digit: Column) -> Column:
    """The unselected children left and right of the selected one."""
    left = F.array_join(F.slice(children, 1, digit), "")
    right = F.array_join(F.slice(children, digit + 2, FANOUT), "")
    return F.struct(left.alias("left"), right.alias("right"))


def proof_digest(path: Column) -> Column:
    """H of the siblings; a path's segments run from the leaf to the root."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified."""
    spark = docs.sparkSession
    folder = C.scratch(spark, "merkle")
    rows = leaves(docs, folder)
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    placed = C.ranked(rows, ["lang"], order)
    langs = placed.groupBy("lang").agg(F.max("rank").alias("size"))
    # One row per lang; ranked by range as well, null first, UTF-8 bytewise.
    numbered = C.cut(
        C.ranked(langs.withColumn("all", F.lit(0)), ["all"], [F.col("lang").asc_nulls_first()]).select("lang", "size", (F.col("rank") - 1).alias("tree"))
    )
    sizes = numbered.agg(F.count(F.lit(1)).alias("trees"), F.max("size").alias("most")).first()
    trees, most = sizes["trees"], sizes["most"] or 0
    names = numbered.select(F.col("lang").alias("_lang"), "tree", "size")
    if trees <= BROADCAST_LANGS:
        names = F.broadcast(names)
    at = (F.col("rank") - 1).alias("at")
    placed = placed.join(names, F.col("lang").eqNullSafe(F.col("_lang"))).select("tree", "size", at, "doc_id", "leaf", "given")
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")

    subroots = C.cut(build_levels(placed.select("tree", "at", F.col("leaf").alias("node"), "size"), most, f"{folder}/lang"))
    nothing = F.lit(0).cast("long")
    upper = subroots.select(nothing.alias("tree"), F.col("tree").alias("at"), "node", F.lit(trees).cast("long").alias("size"))
    root = C.cut(build_levels(upper, trees, f"{folder}/top"))

    # Down the top tree: a request per subtree, from the root to the subroots.
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    here = root.select("tree", nothing.alias("at"), "node", no_path.alias("path"), F.col("node").alias("root"))
    for level in range(height(trees), 0, -1):
        here = descend(here, f"{folder}/top", level)
    starts = here.select(F.col("at").alias("tree"), F.col("node").alias("subroot"), "path", "root")
    at_top = C.cut(starts.join(subroots.select("tree", "level"), "tree")).select(
        "tree", nothing.alias("at"), F.col("subroot").alias("node"), "path", "subroot", "root", "level"
    )

    # Down every lang's tree; a lang joins in at its own height.  The last
    # step, from the leaves' parents, is taken by the leaf requests themselves.
    lone = placed.filter("size = 1").select("tree", "doc_id", "given").join(at_top.filter("level = 0").withColumnRenamed("node", "leaf"), "tree")
    found = lone.select("doc_id", "given", "leaf", "path", "subroot", "root")
    here = None
    for level in range(height(most), 0, -1):
        joining = at_top.filter(F.col("level") == level).drop("level")
        here = joining if here is None else here.unionByName(joining)
        if level > 1:
            here = descend(here, f"{folder}/lang", level)
    if here is not None:
        records = spark.read.parquet(f"{folder}/lang/level=1").select("node", "children").distinct()
        parents = here.join(records, "node").withColumnRenamed("at", "parent")
        asked = F.struct((F.col("at") % FANOUT).cast("int").alias("digit"), "doc_id", "given")
        requests = placed.filter("size > 1").groupBy("tree", F.expr(f"at div {FANOUT}").alias("parent")).agg(F.collect_list(asked).alias("asked"))
        each = parents.join(requests, ["tree", "parent"]).select("path", "children", "subroot", "root", F.explode("asked").alias("r"))
        digit = F.col("r.digit")
        below = each.select(
            "r.doc_id",
            "r.given",
            F.get("children", digit).alias("leaf"),
            F.concat(F.array(segment(F.col("children"), digit)), F.col("path")).alias("path"),
            "subroot",
            "root",
        )
        found = below.unionByName(found)
    out = found.withColumn("folded_root", fold(F.col("given"), F.col("path")))
    return out.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(C.table(spark, sf_dir, "documents"))


# crc32 bit by bit: a byte is folded in, then eight shifts (list_reduce).
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(c)::BIGINT for c in string_split({text}, '')]),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""


def _sql_leaf(text: str) -> str:
    parts = []
    for name in FIELDS:
        value = f"({text})" if name == "text" else f"CAST({name} AS VARCHAR)"
        parts.append(f"coalesce(CAST(strlen({value}) AS VARCHAR) || ':' || {value}, '-')")
    return f"sha256({' || '.join(parts)})"


def _sql_tree(source: str, tree: str, pos: str, node: str) -> str:
    """Nodes of all levels of a forest."""
    return f"""
  SELECT {tree} AS tree, 0 AS level, {pos} AS pos, {node} AS node, count(*) OVER (PARTITION BY {tree}) AS n FROM {source}
  UNION ALL
  SELECT tree, level, pos, node, count(*) OVER (PARTITION BY tree) FROM (
    SELECT tree, level + 1 AS level, pos // {FANOUT} AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
    FROM {source}_tree WHERE n > 1 GROUP BY tree, level, pos // {FANOUT})"""


def _sql_siblings(source: str) -> str:
    run = f"PARTITION BY tree, level, pos // {FANOUT} ORDER BY pos ROWS BETWEEN"
    return f"""
  SELECT *, coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {source}_tree"""


def _sql_climb(source: str, siblings: str, name: str) -> str:
    return f"""
  SELECT rid, tree, 0 AS level, pos, cur, proof FROM {source}
  UNION ALL
  SELECT c.rid, c.tree, c.level + 1, c.pos // {FANOUT}, sha256(s.l || c.cur || s.r), c.proof || s.l || s.r
  FROM {name} c JOIN {siblings} s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos AND s.n > 1"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, *, {_sql_leaf("text")} AS leaf,
    {_sql_leaf(f"translate(text, '{C.UPPER}', '{C.LOWER}')")} AS low,
    {_CRC.format(text="CAST(doc_id AS VARCHAR)")} AS crc
  FROM documents
), langs AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM d)
), leaves AS (
  SELECT rid, doc_id, tree, leaf, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    CASE WHEN doc_id IS NOT NULL AND crc % {TAMPER_EVERY} = 0 THEN low ELSE leaf END AS given
  FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang
), leaves_tree AS ({_sql_tree("leaves", "tree", "pos", "leaf")}
), siblings AS ({_sql_siblings("leaves")}
), subroots AS (SELECT tree, node FROM leaves_tree WHERE n = 1
), subroots_tree AS ({_sql_tree("subroots", "0", "tree", "node")}
), upper_siblings AS ({_sql_siblings("subroots")}
), low_start AS (SELECT rid, tree, pos, given AS cur, '' AS proof FROM leaves
), low_climb AS ({_sql_climb("low_start", "siblings", "low_climb")}
), low_end AS (
  SELECT c.rid, 0 AS tree, c.tree AS pos, c.cur, c.proof FROM low_climb c
  JOIN siblings s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos AND s.n = 1
), top_climb AS ({_sql_climb("low_end", "upper_siblings", "top_climb")}
), top_end AS (
  SELECT c.rid, c.cur, c.proof, s.node AS root FROM top_climb c
  JOIN upper_siblings s ON s.tree = c.tree AND s.level = c.level AND s.pos = c.pos AND s.n = 1
)
SELECT l.doc_id, l.leaf, r.node AS subroot, t.root, sha256(t.proof) AS proof_sha256, t.cur AS folded_root, t.cur = t.root AS verified
FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN top_end t ON t.rid = l.rid
"""
