"""Operator 6: document fingerprints by SpotSigs, in DataFrame functions only.

A spot signature is a common word (the anchor) and the chain of the
``CHAIN`` content words that follow it; punctuation marks count as a common
word, and the text's start is an anchor too, so short texts, tables and texts
without common words have signatures.  The distinct
signatures are the document's fingerprint.  Likeness is their Jaccard
similarity.

``similar_documents`` finds near duplicates: equal fingerprints form classes;
classes are partitioned by set length (two sets of similarity t differ in
length by a factor t at most, so they lie in one partition or in
neighbouring ones); inside a partition only the rarest signatures of a set,
as many as the threshold asks for, are matched, and the candidates, pruned by
length, are compared by full Jaccard.

Defined results: a null text counts as empty; a text without words has an
empty fingerprint, and two empty ones are alike (1.0), an empty and another
one not (0.0); a text of common words only chains those; repeated rows and
rows that share a doc_id are ordered by text; a null doc_id comes after all
others; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ordertide.llm import common as C

CHAIN = 2
# ASCII punctuation counts as one common word, the mark; a token is a run of
# anything but ASCII white space, controls and punctuation, or a mark.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MARK = "."
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|\."

# The anchors, common words of the supported languages.
ANCHORS = (
    """
    the of and to in a is that it for on was be as with by at from this are or an not have but they you he his her we which their there
    der die das und zu den von mit ist im ein eine einen einem einer auf für nicht auch sich des dem als wie es an bei nach aus
    le la les de du et en un une est que qui dans pour pas sur au ce cette il elle par plus avec se
    el los las y con no su al lo por del una como más o este
    """
).split()

SEGMENTS = 64  # quantile segments of the doc_ids
PIECES, MOST_PIECES = 64, 16_384  # even cuts of a segment, at least and at most
BLOCK_ROWS = 20_000  # rows of a block, on average, from which segments are cut finer


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct spot signatures of a text: array<int>."""
    common = sorted({*ANCHORS, MARK})
    lowered = F.lower(F.coalesce(text, F.lit("")))
    marked = F.translate(lowered, PUNCTUATION, MARK * len(PUNCTUATION))
    tokens = F.regexp_extract_all(marked, F.lit(TOKEN), F.lit(0))
    blank = F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def spots(parts: Column) -> Column:
        words, content = parts["words"], parts["content"]
        # The j-th anchor (from 0) at word p has p - j content words before it.
        starts = F.transform(parts["anchors"], lambda p, j: F.struct(F.get(words, p).alias("anchor"), (p - j).alias("first")))
        starts = F.concat(F.array(F.struct(F.lit("").alias("anchor"), F.lit(0).alias("first"))), starts)
        starts = F.filter(starts, lambda s: s["first"] < F.size(content))
        chains = F.transform(starts, lambda s: F.hash(s["anchor"], *[F.get(content, s["first"] + k) for k in range(chain)]))
        return F.array_sort(F.array_distinct(chains))

    def split_words(words: Column) -> Column:
        places = F.filter(F.transform(words, lambda w, i: F.when(w.isin(common), i)), lambda p: p.isNotNull())
        content = F.filter(words, lambda w: ~w.isin(common))
        return F.struct(words.alias("words"), places.alias("anchors"), content.alias("content"))

    def all_common(parts: Column) -> Column:
        bare = F.struct(parts["words"].alias("words"), F.array().cast("array<int>").alias("anchors"), parts["words"].alias("content"))
        return F.when(F.size(parts["content"]) > 0, parts).otherwise(bare)

    words = _let(tokens, lambda t: F.when(F.size(t) > 0, t).otherwise(blank))
    return _let(_let(_let(words, split_words), all_common), spots)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets (1.0 for two empty ones)."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(sigs: Column) -> Column:
    """A signature set as text: its values in hexadecimal, in order."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), " ")


def with_next(docs: DataFrame, segments: int = SEGMENTS, pieces: int | None = None) -> DataFrame:
    """(doc_id, text, sigs, next, next_sigs): every row's text and signatures,
    and those of the next document in descending doc_id order; after the last
    comes the first.

    Rows are dealt to blocks of neighbouring ids: quantile segments of the
    ids (approximate, at most ``segments`` numbers reach the driver), each cut
    evenly into ``pieces`` (by default as many as keep blocks at some
    ``BLOCK_ROWS``).  A block sees the first row of the block after it as a
    guest, so no task holds more than a block and texts move once.  Each text is
    signed once, in its block (a guest's twice), not before the shuffle, which
    would then carry the signatures as well.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / segments for k in range(segments + 1)]
    quantiles = F.percentile_approx("doc_id", F.array(*[F.lit(s) for s in shares]), F.lit(10_000))
    found = rows.agg(quantiles.alias("edges"), F.count(F.lit(1)).alias("n")).first()
    edges = sorted(set(found["edges"] or [0]))
    pieces = pieces or min(max(PIECES, -(-found["n"] // (segments * BLOCK_ROWS))), MOST_PIECES)
    # The smallest ids are in no case below the first edge by much; they share its block.
    block = F.lit(-1).cast("long")
    for k, low in enumerate(edges):
        high = edges[k + 1] if k + 1 < len(edges) else low + 1
        step = max(1, -(-(high - low) // pieces))
        inside = F.least(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(step)), F.lit(pieces)).cast("long")
        block = F.when(F.col("doc_id") >= low, F.lit(k * (pieces + 1)).cast("long") + inside).otherwise(block)
    block = F.when(F.col("doc_id").isNull(), F.lit(-2).cast("long")).otherwise(block)

    blocks = rows.select("doc_id", block.alias("block")).groupBy("block").agg(F.max("doc_id").alias("head"))
    down = Window.orderBy(F.col("block").desc())  # one row per block
    heads = blocks.withColumn("host", F.lag("block").over(down)).withColumn("last", F.min("block").over(Window.partitionBy()))
    heads = C.cut(heads.select("block", "head", F.coalesce("host", "last").alias("host")))
    # At most SEGMENTS * (MOST_PIECES + 1) + 2 rows of three numbers.
    placed = rows.withColumn("block", block).join(F.broadcast(heads.withColumnRenamed("block", "_b")), F.col("block") == F.col("_b"), "left")
    first = F.col("doc_id").eqNullSafe(F.col("head"))
    homes = F.when(first, F.array(F.struct(F.col("block").alias("at"), F.lit(0).alias("guest")), F.struct(F.col("host").alias("at"), F.lit(1).alias("guest"))))
    homes = homes.otherwise(F.array(F.struct(F.col("block").alias("at"), F.lit(0).alias("guest"))))
    dealt = placed.select("doc_id", "text", F.explode(homes).alias("home")).select("doc_id", "text", "home.at", "home.guest")
    signed = dealt.repartition("at").withColumn("sigs", signatures(F.col("text")))
    order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    pairs = signed.select("*", F.lead("text").over(order).alias("next"), F.lead("sigs").over(order).alias("next_sigs"))
    return pairs.filter("guest = 0").select("doc_id", "text", "sigs", "next", "next_sigs")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, sigs (array<int>) of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(F.col("text")).alias("sigs"))


def similar_documents(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(members, links): every document with its class (the smallest doc_id
    of equal fingerprints), and the pairs of classes at the threshold."""
    prints = C.cut(fingerprints(docs).filter("doc_id IS NOT NULL"))
    classes = C.cut(prints.filter("size(sigs) > 0").groupBy("sigs").agg(F.min("doc_id").alias("class")))
    members = prints.join(classes, "sigs", "left").select("doc_id", F.coalesce("class", "doc_id").alias("class"))

    held = classes.select("class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    common = held.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    rarest = held.join(common, "sig").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_df"))
    needed = (F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1).cast("int")
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(threshold)) + F.lit(1e-9))
    index = C.cut(rarest.select("class", "n", part.alias("part"), F.explode(F.slice("by_df", F.lit(1), needed)["sig"]).alias("sig")))
    short = index.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    long = index.select(F.col("class").alias("b"), F.col("n").alias("n_b"), "sig", "part")
    pruned = (F.col("n_a") >= F.col("n_b") * F.lit(threshold) - 1e-9) & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))))
    found = short.join(long, ["part", "sig"]).filter(pruned).select("a", "b").distinct()
    sets_a = classes.select(F.col("class").alias("a"), F.col("sigs").alias("sigs_a"))
    sets_b = classes.select(F.col("class").alias("b"), F.col("sigs").alias("sigs_b"))
    links = found.join(sets_a, "a").join(sets_b, "b").withColumn("likeness", likeness(F.col("sigs_a"), F.col("sigs_b")))
    return members, links.filter(F.col("likeness") >= threshold).select("a", "b", "likeness")


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(C.table(spark, sf_dir, "documents")).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.expr("left(text, int(n_chars - floor(n_chars / 3)))"), F.expr("left(next, int(floor(n_chars / 3)))"))
    rows = rows.withColumn("edited", F.when(cut > 0, edited).otherwise(F.col("text")))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("sigs").alias("s"),
        signatures(F.col("edited")).alias("s_edited"),
        F.col("next_sigs").alias("s_next"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("s")).alias("fingerprint"),
        as_text(F.col("s_edited")).alias("edited_fingerprint"),
        likeness(F.col("s"), F.col("s_edited")).alias("near_edited"),
        likeness(F.col("s"), F.col("s_next")).alias("near_next"),
    )
