"""Operator 10: masked pseudo-likelihood with a bidirectional window network.

Every word is predicted from the words on either side of it by a softmax of
two levels.  First its *symbol*: a table per window place maps the symbols of
the two neighbours on either side to a hidden vector, their sum goes through
tanh and a softmax layer over all symbols.  Then the *word* among the words of
its symbol, from the symbols next to it.  ``log_likelihood`` sums the
log-probabilities of all symbols of a document, ``word_log_likelihood`` those
of all its words.

1. *Vocabulary* - words of the whole corpus are counted (per task in numpy,
   then by a shuffle on the word's hash); the ``FREQUENT`` most frequent get
   their own symbol, others share ``RARE`` symbols by hash; symbol 0 stands
   for the places outside a text.
2. *Training* - in ``ROUNDS`` rounds every task runs one pass of minibatch
   gradient steps (numpy, AdaGrad) over its documents from the current
   weights; the tasks' weights are averaged by their number of words, summed
   exactly in a tree of groups, so the result doesn't depend on the order of
   tasks and no group receives all of them.  All
   documents take part; a round trains on every ``STRIDE``-th word place, each
   round on another residue, so that ``ROUNDS`` rounds train on every place
   once; contexts are always whole.
3. *Words* - every distinct word that shares a symbol, however rare, has a row
   of its own: its count, and its counts after and before each symbol.  Rows
   are sharded by the word's hash, shards grow in number with the corpus.  The
   probability of a word w of symbol c between symbols l and r is the mean of
   (n(l,w) + PRIOR q(w)) / (n(l,c) + PRIOR) and the same with r, where q(w) is
   n(w) / n(c), smoothed for words seen nowhere else.  The place itself is
   masked: its own word is left out of all these counts.
4. *Scoring* - every word place of every document.  A shard gets the places of
   its words in packed blobs, counts them, and sends the log-probabilities
   back to the documents' chunks.

The driver holds the network (about 20 thousand numbers) and n(l,c), n(r,c);
symbols, a byte a word, and the hashes of words that share a symbol are kept
in the checkpoint folder.  Words are told apart by symbol, shard and up to 35
more bits of their hash (49 to 53 bits in all).

Defined results: a null or empty text has 0 words, log-likelihood 0.0 and a
null mean, for symbols and words; repeated rows are scored alike; an empty table gives an empty
result; texts of any length are scored whole, in minibatches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C
from ordertide.llm.words import word_hashes

FREQUENT, RARE = 95, 32
SIZE = 1 + FREQUENT + RARE
HIDDEN = 32
WINDOW = (-2, -1, 1, 2)
STRIDE = 4
ROUNDS = STRIDE
BATCH = 2048
RATE = 0.1
SCALE = 1 << 24  # weights are averaged in steps of 2^-24
SHARD = 1 << 18  # places a shard gets on average, at most
SHARDS = 1 << 9  # at least
PRIOR = 32.0  # places that a word's share of its symbol counts for
NEW = 32.0  # places of a symbol that words seen nowhere else count for
OPEN = 1 << 20  # words that could be new, of every symbol
BINS = 1 << 23  # pairs counted by place, more by sorting
REST = 1 << 35
KEPT = 6  # bytes of a word's hash kept beside its symbol
PLACE = 9  # bytes of a packed place: key 5, left 1, right 1, row 2
LINE = 1 << 18  # words of texts that are joined
HELD = 1 << 19  # distinct words a task counts before it hands them on


class Network(NamedTuple):
    tables: np.ndarray  # (places, SIZE, HIDDEN)
    bias: np.ndarray  # (HIDDEN,)
    out: np.ndarray  # (HIDDEN, SIZE)
    out_bias: np.ndarray  # (SIZE,)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self])

    @staticmethod
    def of(flat: np.ndarray) -> "Network":
        shapes = [(len(WINDOW), SIZE, HIDDEN), (HIDDEN,), (HIDDEN, SIZE), (SIZE,)]
        parts, at = [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            parts.append(flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return Network(*parts)

    @staticmethod
    def start(seed: int = 11) -> "Network":
        rng = np.random.default_rng(seed)
        return Network(
            rng.normal(0, 0.1, (len(WINDOW), SIZE, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            rng.normal(0, 0.1, (HIDDEN, SIZE)).astype(np.float32),
            np.zeros(SIZE, np.float32),
        )


def raised(net: Network, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden vectors and logits, their largest 0, for (n, places) context tokens."""
    total = net.tables[0].take(context[:, 0], axis=0)
    total += net.bias
    for k in range(1, len(WINDOW)):
        total += net.tables[k].take(context[:, k], axis=0)
    hidden = np.tanh(total, out=total)
    logits = hidden @ net.out
    logits += net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    return hidden, logits


def forward(net: Network, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden vectors and log-probabilities for (n, places) context tokens."""
    hidden, logits = raised(net, context)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return hidden, logits


def target_log(net: Network, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probabilities of the target tokens."""
    _, logits = raised(net, context)
    own = logits[np.arange(len(target)), target]
    return own - np.log(np.exp(logits, out=logits).sum(axis=1))


def gradients(net: Network, context: np.ndarray, target: np.ndarray) -> Network:
    """Mean gradients of the loss -log p(target) over the places."""
    n = len(target)
    hidden, delta = raised(net, context)
    np.exp(delta, out=delta)
    # delta holds p - 1(target), times the row's sum; the sums are divided out
    # of the narrow factors.
    total = delta.sum(axis=1)
    delta[np.arange(n), target] -= total
    share = 1 / (total * np.float32(n))
    back = delta @ net.out.T
    back *= share[:, None]
    back *= 1 - hidden * hidden
    tables = np.zeros_like(net.tables)
    for k in range(len(WINDOW)):
        order = np.argsort(context[:, k], kind="stable")
        token = context[order, k]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        tables[k][token[first]] = np.add.reduceat(back[order], first, axis=0)
    hidden *= share[:, None]
    return Network(tables, back.sum(axis=0), hidden.T @ delta, share @ delta)


def step(net: Network, seen: Network, context: np.ndarray, target: np.ndarray) -> None:
    """One AdaGrad step, in place; ``seen`` sums the squared gradients."""
    for value, square, grad in zip(net, seen, gradients(net, context, target)):
        square += grad * grad
        value -= RATE * grad / (np.sqrt(square) + 1e-6)


def contexts(ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Tokens around ``places`` of a text; token 0 outside of it."""
    padded = np.concatenate([np.zeros(2, ids.dtype), ids, np.zeros(2, ids.dtype)])
    return np.stack([padded[places + 2 + w] for w in WINDOW], axis=1)


def lines(raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to lines of about ``LINE`` words, token 0 around each:
    (line, place in it, row, place in its text) of every word."""
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) <= LINE):
            size += len(raws[end])
            end += 1
        some = raws[at:end]
        lengths = np.array([len(r) for r in some], np.int32)
        row = np.repeat(np.arange(len(some), dtype=np.int32), lengths)
        own = np.arange(size, dtype=np.int32)
        place = own + 2 * row + 2
        line = np.zeros(size + 2 * len(some) + 2, np.uint8)
        line[place] = np.frombuffer(b"".join(some), np.uint8)
        yield line, place, row + np.int32(at), own - np.repeat(np.cumsum(lengths, dtype=np.int32) - lengths, lengths)
        at = end


def around(line: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Tokens around places of a line."""
    return np.stack([line[place + w] for w in WINDOW], axis=1)


def log_likelihood(net: Network, ids: np.ndarray) -> float:
    line = np.zeros(len(ids) + 4, ids.dtype)
    line[2:-2] = ids
    views = [line[2 + w : 2 + w + len(ids)] for w in WINDOW]
    total = 0.0
    for at in range(0, len(ids), BATCH):
        near = np.column_stack([v[at : at + BATCH] for v in views])
        total += float(target_log(net, near, ids[at : at + BATCH]).sum(dtype=np.float64))
    return total


def vocabulary(texts: DataFrame, frequent: int = FREQUENT) -> np.ndarray:
    """Hashes (int64) of the most frequent words, most frequent first.

    The shuffle carries a row per distinct word and task; ``frequent`` rows
    reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64))

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], ["word", "n"])

        for batch in batches:
            found = [w for w in word_hashes(batch.column(0).to_pylist()) if len(w)]
            if not found:
                continue
            words, n = np.unique(np.concatenate(found).view(np.int64), return_counts=True)
            words, back = np.unique(np.concatenate([held[0], words]), return_inverse=True)
            held = (words, np.bincount(back, np.concatenate([held[1], n])).astype(np.int64))
            if len(words) > HELD:
                yield rows()
                held = (np.empty(0, np.int64), np.empty(0, np.int64))
        if len(held[0]):
            yield rows()

    counts = texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.col("n").desc(), "word").limit(frequent).collect()
    return np.array([r["word"] for r in top], np.int64)


def tokenised(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """doc_id, ids (a byte per word), hashes (``KEPT`` bytes per word that shares
    its symbol) and at, a number of the row that grows by one inside a task."""
    order = np.argsort(words)
    known, number = words[order], (order + 1).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, rest = [], []
            for hashes in word_hashes(batch.column(1).to_pylist()):
                ids = (1 + FREQUENT + (hashes % np.uint64(RARE))).astype(np.uint8)
                if len(known) and len(hashes):
                    signed = hashes.view(np.int64)
                    at = np.minimum(np.searchsorted(known, signed), len(known) - 1)
                    hit = known[at] == signed
                    ids[hit] = number[at[hit]]
                out.append(ids.tobytes())
                quotient = hashes[ids > FREQUENT] // np.uint64(RARE)
                rest.append(quotient.view(np.uint8).reshape(-1, 8)[:, :KEPT].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(rest, pa.binary())], ["doc_id", "ids", "hashes"])

    rows = texts.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, hashes binary")
    return rows.withColumn("at", F.monotonically_increasing_id())


def shared_places(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, symbol, left symbol, right symbol) of every word that shares its symbol."""
    ids = np.frombuffer(b"".join(raws), np.uint8)
    row = np.repeat(np.arange(len(raws)), [len(r) for r in raws])
    at = np.arange(len(ids)) + row + 1
    line = np.zeros(len(ids) + len(raws) + 1, np.uint8)
    line[at] = ids
    shares = ids > FREQUENT
    at = at[shares]
    return row[shares], ids[shares], line[at - 1], line[at + 1]


def symbol_pairs(tokens: DataFrame) -> np.ndarray:
    """Counts (2, SIZE, RARE) of each shared symbol after and before each symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SIZE * RARE, np.int64)
        for batch in batches:
            _, symbol, left, right = shared_places(batch.column(0).to_pylist())
            kind = symbol.astype(np.int64) - 1 - FREQUENT
            for side, near in enumerate((left, right)):
                total += np.bincount((side * SIZE + near.astype(np.int64)) * RARE + kind, minlength=len(total))
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(total[place], pa.int64())], ["place", "n"])

    rows = tokens.select("ids").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(2 * SIZE * RARE)
    for r in rows:
        pairs[r["place"]] = r["n"]
    return pairs.reshape(2, SIZE, RARE)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Keys, left and right symbols, and the rows as packed."""
    n = len(blob) // PLACE
    key = np.frombuffer(blob, "<u4", n).astype(np.int64) + (np.frombuffer(blob, np.uint8, n, 4 * n).astype(np.int64) << 32)
    return key, np.frombuffer(blob, np.uint8, n, 5 * n), np.frombuffer(blob, np.uint8, n, 6 * n), blob[7 * n :]


def log_shares(key: np.ndarray, near: tuple[np.ndarray, np.ndarray], pairs: np.ndarray, masked: bool = False) -> np.ndarray:
    """Log-probability of every place's word among the words of its symbol.
    ``key`` holds all places of its words; key % RARE is the symbol.  With
    ``masked`` a place's own word is left out of every count."""
    _, word, n = np.unique(key, return_inverse=True, return_counts=True)
    kind, own = key % RARE, 1 if masked else 0
    held = pairs[0].sum(axis=0)[kind]
    if masked:  # a word seen nowhere else has its part of what is kept for new words
        prior = PRIOR * (n[word] - own + NEW / OPEN) / (held - own + NEW)
    else:
        prior = PRIOR * n[word] / held
    share = np.zeros(len(key))
    for side, symbol in zip(pairs, near):
        pair = word * SIZE + symbol
        if len(n) * SIZE <= BINS:
            m = np.bincount(pair, minlength=1)
        else:
            _, pair, m = np.unique(pair, return_inverse=True, return_counts=True)
        share += (m[pair] - own + prior) / (side[symbol, kind] - own + PRIOR) / 2
    return np.log(share)


def word_scores(tokens: DataFrame, least: int = SHARDS) -> DataFrame:
    """at and words: the sum of ``log_shares`` over the row's words."""
    pairs = symbol_pairs(tokens)
    shards = least
    while shards * SHARD < pairs[0].sum():
        shards *= 2

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            numbers = whole.column(0).to_numpy()
            block = (numbers - numbers[0]) >> 16 if len(numbers) else numbers
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(numbers)]
            for first, end in zip(edges[:-1], edges[1:]):
                if first == end:
                    continue
                batch = whole.slice(first, end - first)
                row, symbol, left, right = shared_places(batch.column(1).to_pylist())
                hashes = np.zeros((len(row), 8), np.uint8)
                hashes[:, :KEPT] = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, KEPT)
                hashes = hashes.view("<u8")[:, 0]
                shard = (hashes % np.uint64(shards)).astype(np.int32)
                key = hashes // np.uint64(shards) % np.uint64(REST) * np.uint64(RARE) + (symbol - np.uint8(1 + FREQUENT))
                offset = (numbers[first:end] - numbers[first]).astype("<u2")
                order = np.argsort(shard, kind="stable")
                fields = [key.astype("<u4"), (key >> np.uint64(32)).astype(np.uint8), left, right, offset[row]]
                fields = [f[order] for f in fields]
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                some = np.flatnonzero(np.diff(bounds))
                blobs = [b"".join(f[bounds[s] : bounds[s + 1]].tobytes() for f in fields) for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(np.full(len(some), numbers[first]), pa.int64()), pa.array(blobs, pa.binary())],
                    ["shard", "chunk", "places"],
                )

    def share(shard: pa.Table) -> pa.Table:
        chunks, blobs = shard.column("chunk"), shard.column("places").to_pylist()
        parts = [unpacked(b) for b in blobs]
        key, left, right = (np.concatenate([p[k] for p in parts]) for k in range(3))
        values = np.round(log_shares(key, (left, right), pairs, masked=True) * SCALE).astype("<i4")
        cuts = np.cumsum([0] + [len(p[0]) for p in parts])
        out = [values[a:b].tobytes() + p[3] for a, b, p in zip(cuts[:-1], cuts[1:], parts)]
        return pa.table({"chunk": chunks, "values": pa.array(out, pa.binary())})

    def gather(chunk: pa.Table) -> pa.Table:
        blobs = chunk.column("values").to_pylist()
        ns = [len(b) // 6 for b in blobs]
        value = np.concatenate([np.frombuffer(b, "<i4", n) for b, n in zip(blobs, ns)])
        row = np.concatenate([np.frombuffer(b, "<u2", n, 4 * n) for b, n in zip(blobs, ns)])
        total, some = np.bincount(row, value), np.flatnonzero(np.bincount(row))
        return pa.table({"at": pa.array(some + chunk.column("chunk")[0].as_py(), pa.int64()), "words": pa.array(total[some] / SCALE, pa.float64())})

    dealt = tokens.select("at", "ids", "hashes").mapInArrow(deal, "shard long, chunk long, places binary")
    shares = dealt.groupBy("shard").applyInArrow(share, "chunk long, values binary")
    return shares.groupBy("chunk").applyInArrow(gather, "at long, words double")


def train_round(tokens: DataFrame, net: Network, residue: int, stride: int = STRIDE) -> Network:
    """Every task's pass from ``net``, averaged by the words it trained on."""
    shared = tokens.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(*[p.copy() for p in shared.value])
        seen = Network(*[np.zeros_like(p) for p in own])
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = trained = 0

        def flush() -> None:
            nonlocal held, trained
            context, target = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            held = 0
            for at in range(0, len(target), BATCH):
                step(own, seen, context[at : at + BATCH], target[at : at + BATCH])
            trained += len(target)

        for batch in batches:
            for line, place, _, own_place in lines(batch.column(0).to_pylist()):
                place = place[own_place % stride == residue]
                for at in range(0, len(place), BATCH):
                    part = place[at : at + BATCH]
                    waiting.append((around(line, part), line[part]))
                    held += len(part)
                    if held >= 8 * BATCH:
                        flush()
        if waiting:
            flush()
        if trained:
            flat = np.round(own.flat().astype(np.float64) * SCALE).astype(np.int64)
            yield weighed([flat], [trained])

    # Summed as a tree, about the square root of the tasks a group.
    groups = max(1, round(tokens.rdd.getNumPartitions() ** 0.5))
    task = F.pmod(F.spark_partition_id(), F.lit(groups)).cast("int")
    parts = tokens.select("ids").mapInArrow(run, WEIGHTS).withColumn("task", task)
    some = parts.groupBy("task").applyInArrow(added, f"task int, {WEIGHTS}")
    rows = some.withColumn("task", F.lit(0)).groupBy("task").applyInArrow(added, f"task int, {WEIGHTS}").collect()
    if not rows:
        return net
    high, low = (np.frombuffer(rows[0][c], np.int64).astype(np.float64) for c in ("high", "low"))
    return Network.of((high * LOW + low) / rows[0]["words"] / SCALE)


WEIGHTS = "words long, high binary, low binary"
LOW = 1 << 20  # weighed sums are kept in two parts, so that they can't overflow


def weighed(flats: list[np.ndarray], words: list[int]) -> pa.RecordBatch:
    """Weights times words, in two parts."""
    sums = [f * n for f, n in zip(flats, words)]
    high, low = [(x // LOW).tobytes() for x in sums], [(x % LOW).tobytes() for x in sums]
    return pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(high, pa.binary()), pa.array(low, pa.binary())], ["words", "high", "low"])


def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a group's weighed weights: exact, in any order."""
    words, high, low = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for n, a, b in zip(*(batch.column(c).to_pylist() for c in ("words", "high", "low"))):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            high, low, words = (high + a, low + b, words + n) if words else (a, b, n)
    high, low = high + low // LOW, low % LOW
    columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([words], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in (high, low)]]
    yield pa.RecordBatch.from_arrays(columns, ["task", "words", "high", "low"])


def fit(tokens: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    net = Network.start()
    for r in range(rounds):
        net = train_round(tokens, net, r % stride, stride)
    return net


def scored(tokens: DataFrame, net: Network) -> DataFrame:
    """at, doc_id, n_words and symbols, the log-likelihood of the row's symbols."""
    shared = tokens.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(raw, np.uint8) for raw in batch.column(2).to_pylist()]
            # Text by text: equal texts then get equal sums, to the last bit.
            sums = [log_likelihood(shared.value, i) if len(i) else 0.0 for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(i) for i in ids], pa.int64()), pa.array(sums, pa.float64())],
                ["at", "doc_id", "n_words", "symbols"],
            )

    return tokens.select("at", "doc_id", "ids").mapInArrow(run, "at long, doc_id long, n_words long, symbols double")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and the sums and means of the log-probabilities of every
    row's symbols (log_likelihood) and words (word_log_likelihood)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    tokens = C.cut(tokenised(texts, vocabulary(texts)))
    rows = scored(tokens, fit(tokens)).join(word_scores(tokens), "at", "left")
    sums = {"log_likelihood": F.col("symbols"), "word_log_likelihood": F.col("symbols") + F.coalesce("words", F.lit(0.0))}
    rows = rows.select("doc_id", "n_words", *[F.round(v, 4).alias(k) for k, v in sums.items()])
    means = [F.when(F.col("n_words") > 0, F.col(k) / F.col("n_words")).alias(f"mean_{k}") for k in sums]
    return rows.select("doc_id", "n_words", "log_likelihood", means[0], "word_log_likelihood", means[1])


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(C.table(spark, sf_dir, "documents"))
