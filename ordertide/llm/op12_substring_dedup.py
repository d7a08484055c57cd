"""Operator 12: substring dedup by super-k-mer partitioning.

A window is 13 consecutive words of a document; words covered by a window
that also starts in a document with a smaller doc_id are removed.

* *minimisers* - of every window the least hashed 3-word sequence; consecutive
  windows that share it travel as one packed string (a super-k-mer, its words
  joined by one space) to the bucket of their minimiser.  Equal windows have
  equal minimisers, so all places of a window meet in one bucket;
* *frequent sequences last* - a count over hashed slots finds the 3-word
  sequences that hold so large a share of the corpus that their bucket would
  be several times the others; they are least only where a window has nothing
  else.  A line or passage that a third of all documents hold then goes with
  its neighbours' minimisers, and by itself as one equal string per task;
* *strings first* - a task sends each of its distinct strings once a bucket,
  with the least and greatest doc_id that hold it and how often it occurs.  A
  bucket maps words to numbers, sorts the windows of its strings and takes the
  least doc_id of each; windows whose hashes are equal are compared word by
  word.  Its verdicts are the strings with a window to remove;
* *places second* - the strings' places (document, first word) are dealt in
  the same way and meet the verdicts of their bucket.  Here a string that very
  many documents hold brings all its places, so a bucket with many is split by
  salts, counted from the first pass, with its verdicts under each of them;
* *texts last* - only documents with a removed window join their marks; a
  fixed-size bitmap keeps most others out of that shuffle.

Places name a string by a 64-bit hash inside its bucket.

The number of buckets grows with the text (``BUCKET_BYTES`` each).  What
reaches the driver: three sums, the frequent slots (their share bounds them:
at most a quarter of the number of buckets, 2^17) and the buckets that need
salts (likewise at most a quarter of all).

Defined results: a null text has no words; a row with a null doc_id removes
nothing from others and keeps all its words; rows that repeat a doc_id are the
same document to each other (none removes the other's words) but each is
answered by itself; texts of under 13 words have no window; very long texts
are cut into super-k-mers like others; an empty table gives an empty result;
other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C
from ordertide.llm import words as W

WIDTH = 13  # words of a window
MINIMISER = 3  # words of a minimiser
RUN = 48  # windows of a super-k-mer at most: a verdict is one bit each
BUCKET_BYTES = 8 << 20  # text bytes a bucket stands for
CHUNK_BYTES = 8 << 20  # text bytes a task packs at a time
SLOT_BITS = 22  # hashed slots in which 3-word sequences are counted
HEAVY = 4  # a share of so many buckets makes a slot frequent

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)
_FREQUENT = _U(1 << 63)


# -- super-k-mers of a batch of texts ------------------------------------------------
def sequence_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of the 3-word sequence that starts at each word (the last have none)."""
    n = len(h) - MINIMISER + 1
    total = h[:n].copy()
    for k in range(1, MINIMISER):
        total = W.mix(total * _MIX) + h[k : n + k]
    return W.mix(total)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    n, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


def super_kmers(counts: np.ndarray, hashes: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, minimiser) of every super-k-mer of documents with
    ``counts`` words each, whose word ``hashes`` follow one another."""
    none = np.empty(0, np.int64)
    if len(hashes) < WIDTH:
        return none, none, np.empty(0, _U)
    key = sequence_hashes(hashes)
    if len(frequent):
        late = frequent[(key >> _U(64 - SLOT_BITS)).astype(np.int64)]
        key = (key >> _U(1)) | np.where(late, _FREQUENT, _U(0))
    else:
        key = key >> _U(1)
    least = sliding_min(key, WIDTH - MINIMISER + 1)
    doc = np.repeat(np.arange(len(counts)), counts)
    valid = doc[: len(least)] == doc[WIDTH - 1 :]  # not across two documents
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    starts = np.flatnonzero(new)
    if not len(starts):
        return none, none, np.empty(0, _U)
    # A run ends where the next starts or the document has no further window.
    stop = np.flatnonzero(valid & ~np.append(valid[1:], False)) + 1
    ends = np.minimum(np.append(starts[1:], len(least)), stop[np.searchsorted(stop, starts, "right")])
    pieces = -(-(ends - starts) // RUN)
    first = np.repeat(starts, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return first, np.minimum(RUN, np.repeat(ends, pieces) - first), least[first]


class Batch:
    """The words of some texts and their super-k-mers."""

    def __init__(self, texts: list[bytes], frequent: np.ndarray, buckets: int):
        plain, counts = [], []
        for text in texts:
            held = text.split()  # at ASCII white space, as in W.SPACE
            counts.append(len(held))
            if held:
                plain.append(b" ".join(held))
        self.joined = b" ".join(plain)
        self.counts = np.array(counts, np.int64)
        hashes = list(W.word_hashes(texts))
        hashes = np.concatenate(hashes) if hashes else np.empty(0, _U)
        self.first, self.windows, least = super_kmers(self.counts, hashes, frequent)
        spaces = np.flatnonzero(np.frombuffer(self.joined, np.uint8) == 32)
        begin = np.concatenate([[0], spaces + 1])
        end = np.append(spaces, len(self.joined))
        before = np.cumsum(self.counts) - self.counts
        self.doc = np.searchsorted(before, self.first, "right") - 1 if len(self.first) else self.first
        # A document without words shares its place with the one after it.
        self.place = self.first - before[self.doc] if len(self.first) else self.first
        self.bucket = (W.mix(least) % _U(buckets)).astype(np.int64)
        lo, hi = (begin[self.first], end[self.first + self.windows + WIDTH - 2]) if len(self.first) else (self.first, self.first)
        joined = self.joined
        self.strings = [joined[a:b] for a, b in zip(lo.tolist(), hi.tolist())]


def _chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[list]]:
    """Rows gathered to about ``CHUNK_BYTES`` of text; the text comes last."""
    held: list[list] = [[] for _ in columns]
    size = 0
    for batch in batches:
        rows = [batch.column(c).to_pylist() for c in columns]
        rows[-1] = [t.encode() for t in rows[-1]]
        for row in zip(*rows):
            for k, v in enumerate(row):
                held[k].append(v)
            size += len(row[-1])
            if size >= CHUNK_BYTES:
                yield held
                held, size = [[] for _ in columns], 0
    if held[0]:
        yield held


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for at in np.split(order, cuts):
        if len(at):
            yield int(bucket[at[0]]), at


def _squeeze(data: bytes) -> bytes:
    """``data`` compressed, after its length."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def _expand(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _pack(values: np.ndarray, kind: type) -> bytes:
    return _squeeze(np.ascontiguousarray(values, kind).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(_expand(data), kind)


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


# -- frequent sequences -----------------------------------------------------------------
def _count_slots(share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(1 << SLOT_BITS, np.int64), 0
        for (texts,) in _chunks(batches, ("text",)):
            keys = [sequence_hashes(h) for h in W.word_hashes(texts) if len(h) >= MINIMISER]
            if keys:
                slots = (np.concatenate(keys) >> _U(64 - SLOT_BITS)).astype(np.int64)
                counts += np.bincount(slots, minlength=len(counts))
                total += len(slots)
        # A slot that is frequent overall is so, or nearly, in some tasks.
        seen = np.flatnonzero(counts > max(1, total * share / 4)) if total else np.empty(0, np.int64)
        slot = np.append(seen, -1)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int64()), "n": pa.array(np.append(counts[seen], total), pa.int64())})

    return run


def frequent_slots(texts: DataFrame, buckets: int) -> np.ndarray:
    """Slots of 3-word sequences that would fill ``HEAVY`` buckets, as flags."""
    share = HEAVY / min(buckets, 1 << 19)
    if share >= 1:
        return np.zeros(0, bool)
    counted = C.cut(texts.mapInArrow(_count_slots(share), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")))
    total = counted.filter("slot = -1").select("n").first()
    heavy = [r["slot"] for r in counted.filter((F.col("slot") >= 0) & (F.col("n") > (total["n"] if total else 0) * share)).collect()]
    flags = np.zeros(1 << SLOT_BITS if heavy else 0, bool)
    flags[heavy] = True
    return flags


# -- strings and their verdicts ---------------------------------------------------------
STRINGS = "bucket int, strings binary, least binary, most binary, copies binary"


def _distinct(strings: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct strings and, for each string, its number among them."""
    found = pa.array(strings, pa.binary()).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy()


def _extremes(number: np.ndarray, n: int, least: np.ndarray, most: np.ndarray | None = None, copies: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per number below ``n`` the least, the greatest and the added copies."""
    order = np.argsort(number, kind="stable")
    heads = np.searchsorted(number[order], np.arange(n))
    lo = np.minimum.reduceat(least[order], heads)
    hi = np.maximum.reduceat((least if most is None else most)[order], heads)
    return lo, hi, np.bincount(number, minlength=n) if copies is None else np.add.reduceat(copies[order], heads)


def _send_strings(frequent: np.ndarray, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _chunks(batches, ("doc_id", "text")):
            b = Batch(texts, frequent, buckets)
            doc_ids = np.array(ids, np.int64)[b.doc]
            out: dict[str, list] = {c.split()[0]: [] for c in STRINGS.split(", ")}
            for bucket, at in _by_bucket(b.bucket):
                held, number = _distinct([b.strings[k] for k in at.tolist()])
                least, most, copies = _extremes(number, len(held), doc_ids[at])
                out["bucket"].append(bucket)
                out["strings"].append(_squeeze(b"\n".join(held)))
                out["least"].append(_pack(_steps(least), np.int64))
                out["most"].append(_pack(most - least, np.int64))
                out["copies"].append(_pack(copies, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["bucket"], pa.int32())] + [pa.array(out[c], pa.binary()) for c in ("strings", "least", "most", "copies")], names=list(out)
            )

    return run


def string_hash(strings: list[bytes]) -> np.ndarray:
    """64-bit hashes of the strings' bytes."""
    return np.frombuffer(b"".join([hashlib.blake2b(s, digest_size=8).digest() for s in strings]), _U)


def window_firsts(strings: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, least doc_id of any string that holds it) for every window of
    the strings, in order; ``least`` is the strings' own least doc_id."""
    listed = pc.split_pattern(pa.array(strings, pa.binary()).cast(pa.string()), " ")
    ids = listed.values.dictionary_encode().indices.to_numpy().astype(_U)
    ends = listed.offsets.to_numpy()[1:].astype(np.int64)
    lengths = np.diff(ends, prepend=0)
    windows = lengths - WIDTH + 1
    string = np.repeat(np.arange(len(strings)), windows)
    at = np.arange(windows.sum()) + np.repeat((ends - lengths) - (np.cumsum(windows) - windows), windows)
    mixed = W.mix(ids + _U(1))
    total = mixed[at]
    for k in range(1, WIDTH):
        total = total * _MIX + mixed[at + k]
    order = np.argsort(total, kind="stable")
    same = total[order[1:]] == total[order[:-1]]
    # Equal hashes: compare the words, all thirteen.
    left, right = at[order[:-1][same]], at[order[1:][same]]
    for k in range(WIDTH):
        if not np.array_equal(ids[left + k], ids[right + k]):  # a collision: sort by the words themselves
            order = np.lexsort([ids[at + j] for j in range(WIDTH)])
            same = np.ones(len(order) - 1, bool)
            for j in range(WIDTH):
                same &= ids[at[order[1:]] + j] == ids[at[order[:-1]] + j]
            break
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
    heads = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else order
    firsts = np.empty(len(order), np.int64)
    if len(order):
        firsts[order] = np.minimum.reduceat(least[string[order]], heads)[group]
    return string, firsts


VERDICTS = "bucket int, places long, strings binary, first binary, windows binary, removed binary"


def _judge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sent: list[bytes] = []
    numbers: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for packed, *packs in zip(*(batch.column(c).to_pylist() for c in ("strings", "least", "most", "copies"))):
            least, above, copies = (_unpack(x, np.int64) for x in packs)
            sent += _expand(packed).split(b"\n")
            numbers.append((np.cumsum(least), np.cumsum(least) + above, copies))
    strings, number = _distinct(sent)
    del sent
    least, most, copies = _extremes(number, len(strings), *(np.concatenate(c) for c in zip(*numbers)))
    string, firsts = window_firsts(strings, least)
    start = np.searchsorted(string, np.arange(len(strings)))
    bit = np.where(firsts < least[string], _U(1) << (np.arange(len(string)) - start[string]).astype(_U), _U(0))
    removed = np.bitwise_or.reduceat(bit, start)
    told = np.flatnonzero((removed != 0) | (most > least))
    hashes = string_hash([strings[k] for k in told.tolist()])
    order = np.argsort(hashes)
    told, hashes = told[order], hashes[order]
    windows = np.diff(np.append(start, len(string)))
    row = [
        pa.array([key[0].as_py()], pa.int32()),
        pa.array([int(copies.sum())], pa.int64()),
        *[
            pa.array([x], pa.binary())
            for x in (hashes.tobytes(), _pack(least[told], np.int64), _pack(windows[told], np.uint8), _pack(removed[told], _U))
        ],
    ]
    yield pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in VERDICTS.split(", ")])


# -- places ---------------------------------------------------------------------------
PLACES = "bucket int, salt int, strings binary, docs binary, tags binary, place binary"


def _send_places(frequent: np.ndarray, buckets: int, salts: dict[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for turn, (ids, tags, texts) in enumerate(_chunks(batches, ("doc_id", "tag", "text"))):
            b = Batch(texts, frequent, buckets)
            doc_ids, doc_tags = np.array(ids, np.int64)[b.doc], np.array(tags, np.int64)[b.doc]
            hashes = string_hash(b.strings)
            del b.strings
            out: dict[str, list] = {c.split()[0]: [] for c in PLACES.split(", ")}
            for bucket, at in _by_bucket(b.bucket):
                out["bucket"].append(bucket)
                out["salt"].append((task * 31 + turn) % salts.get(bucket, 1))
                out["strings"].append(hashes[at].tobytes())
                out["docs"].append(_pack(_steps(doc_ids[at]), np.int64))
                out["tags"].append(_pack(_steps(doc_tags[at]), np.int64))
                out["place"].append(_pack(b.place[at], np.uint32))
            numbers = [pa.array(out[c], pa.int32()) for c in ("bucket", "salt")]
            yield pa.RecordBatch.from_arrays(numbers + [pa.array(out[c], pa.binary()) for c in ("strings", "docs", "tags", "place")], names=list(out))

    return run


MARKS = "doc_id long, tag long, place long, removed long"


def _mark(verdicts: pa.Table, places: pa.Table) -> pa.Table:
    """Places whose string has windows to remove, and which (a bit each)."""
    found = []
    if verdicts.num_rows and places.num_rows:
        v = {c: verdicts.column(c)[0].as_py() for c in ("strings", "first", "windows", "removed")}
        told = np.frombuffer(v["strings"], _U)
        first, windows, removed = _unpack(v["first"], np.int64), _unpack(v["windows"], np.uint8), _unpack(v["removed"], _U)
        every = (_U(1) << windows.astype(_U)) - _U(1)
        for k in range(places.num_rows if len(told) else 0):
            p = {c: places.column(c)[k].as_py() for c in ("strings", "docs", "tags", "place")}
            hashes = np.frombuffer(p["strings"], _U)
            at = np.minimum(np.searchsorted(told, hashes), len(told) - 1)
            hit = np.flatnonzero(told[at] == hashes)
            docs, tags = np.cumsum(_unpack(p["docs"], np.int64))[hit], np.cumsum(_unpack(p["tags"], np.int64))[hit]
            place, at = _unpack(p["place"], np.uint32)[hit], at[hit]
            bits = np.where(docs > first[at], every[at], removed[at])
            some = np.flatnonzero(bits)
            found.append([docs[some], tags[some], place[some].astype(np.int64), bits[some].astype(np.int64)])
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "tag", "place", "removed"])


def marks(docs: DataFrame) -> DataFrame:
    """Windows to remove: (doc_id, tag, place, removed), ``removed`` a bit for
    every window from word ``place`` on.  ``docs``: doc_id, tag, text."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    frequent = frequent_slots(docs.select("text"), buckets)
    sent = docs.select("doc_id", "text").mapInArrow(_send_strings(frequent, buckets), STRINGS)
    verdicts = C.cut(sent.groupBy("bucket").applyInArrow(_judge, VERDICTS))
    # Salts for buckets with several times the average number of places.
    average = verdicts.agg(F.avg("places").alias("n")).first()["n"] or 1.0
    many = F.ceil(F.col("places") / F.lit(HEAVY * average)).cast("int")
    salts = {r["bucket"]: r["salts"] for r in verdicts.select("bucket", many.alias("salts")).filter("salts > 1").collect()}
    spread = verdicts.select("bucket", F.explode(F.sequence(F.lit(0), many - 1)).alias("salt"), "strings", "first", "windows", "removed")
    places = docs.mapInArrow(_send_places(frequent, buckets, salts), PLACES)
    keys = ("bucket", "salt")
    return spread.groupBy(*keys).cogroup(places.groupBy(*keys)).applyInArrow(_mark, MARKS)


# -- texts -------------------------------------------------------------------------------
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def removed_words(n: int, place: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Flags of the words that the marked windows cover."""
    run, b = np.nonzero(np.unpackbits(bits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    at = place[run] + b
    edge = np.bincount(at, minlength=n + 1) - np.bincount(at + WIDTH, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "marks"))):
            kept = words = text.encode().split()
            if found:
                gone = removed_words(len(words), np.array([m["place"] for m in found]), np.array([m["removed"] for m in found]))
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
            for column, value in zip(out, (doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=[c.split()[0] for c in RESULT.split(", ")])


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # Rows that repeat a doc_id are told apart by their text.
    repeated = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    tag = F.lit(0).cast("long") if repeated.isEmpty() else F.xxhash64("text")
    rows = rows.select("doc_id", tag.alias("tag"), "text")
    found = marks(rows.filter("doc_id IS NOT NULL"))
    per_doc = C.cut(found.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("place", "removed")).alias("marks")))
    seen = C.flag_maybe(rows, "doc_id", per_doc, "doc_id")
    nothing = F.lit(None).cast("array<struct<place:long,removed:long>>")
    alone = seen.filter("NOT _maybe").select("doc_id", "text", nothing.alias("marks"))
    marked = seen.filter("_maybe").drop("_maybe").join(per_doc, ["doc_id", "tag"], "left").select("doc_id", "text", "marks")
    return alone.unionByName(marked).mapInArrow(_finish, RESULT)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(C.table(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{C.WORD_PATTERN}') AS words FROM documents
), w AS (
  SELECT rid, doc_id, pos, array_to_string(words[pos:pos + {WIDTH - 1}], ' ') AS win
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - {WIDTH - 2})) AS pos FROM d WHERE len(words) >= {WIDTH})
), f AS (
  SELECT rid, pos, doc_id > min(doc_id) OVER (PARTITION BY win) AS gone FROM w
), c AS (
  SELECT DISTINCT rid, unnest(range(pos, pos + {WIDTH})) AS pos FROM f WHERE gone
), g AS (SELECT rid, list(pos) AS gone FROM c GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string([x for x, i in words if NOT list_contains(coalesce(gone, []), i)], ' '), '')) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""
