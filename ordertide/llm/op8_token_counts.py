"""Operator 8: edit-aware token counts with pre-token segment trees.

A text is split into pre-tokens by the tokenizer's pattern; its token count is
the sum of the pre-tokens' counts.  Per document a segment tree keeps, over
leaves of some pre-tokens, the sums of characters and tokens.  An edit is
located by descending the character sums; splitting starts again at the last
boundary that the edit can't move (the pattern looks at most two characters
past a pre-token), goes on through the new text and stops at the first old
boundary after it; only the pre-tokens in between are encoded again, and the
sums on their paths updated.

Trees are kept per document as a written table (``build_trees``): text,
lengths and token counts of the pre-tokens, which the sums follow from without
splitting or encoding.  ``update_trees`` reads kept trees with their edits and
gives the trees after them; ``with_edits`` finds the trees that a table of
edits touches, so an update reads those documents' trees and no other texts.
The result of an update is a table of trees like the one before.

The vocabulary file is read on the driver (its path is a parameter) and
broadcast: its size doesn't depend on the data.

Defined results: a null or empty text has no token; null edits or an empty
list leave the count as it is; an edit's place beyond the text's end means its
end, a negative one its start; a null start or length counts as 0, a null new
text as empty; repeated rows have a tree each, and edits by
doc_id change all trees of that doc_id (a null one finds those without); an
empty table gives an empty result; texts of any length are counted whole.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import common as C

VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOKAHEAD = 2  # characters past its end that decide a pre-token
LEAF = 64  # pre-tokens of a leaf when a tree is built
SEGMENT = 1 << 16  # characters split at a time
CACHED = 200_000  # pre-tokens whose counts a task remembers

_SPLIT = regex.compile(PATTERN)
_SAFE_CUT = regex.compile(r"\S(?=\s)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed public vocabulary file ``name`` is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


class Counter:
    """Token counts of pre-tokens, the frequent ones remembered."""

    def __init__(self, ranks: bytes):
        self.encoding = _encoding(ranks)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        found = list(map(self.known.get, pieces))
        if None in found:
            if len(self.known) > CACHED:
                self.known.clear()
            new = [p for p, n in zip(pieces, found) if n is None]
            for p, tokens in zip(new, map(self.encoding.encode_ordinary, new)):
                self.known[p] = len(tokens)
            found = [n if n is not None else self.known[p] for p, n in zip(pieces, found)]
        return found


def split(text: str) -> Iterator[list[str]]:
    """Pre-tokens of ``text`` in lists of bounded length.

    Pieces are cut where a character other than white space is followed by
    white space, which always is a boundary of the pattern.
    """
    at = 0
    while len(text) - at > SEGMENT:
        cut = _SAFE_CUT.search(text, at + SEGMENT)
        if cut is None:
            break
        yield _SPLIT.findall(text, at, cut.end())
        at = cut.end()
    yield _SPLIT.findall(text, at)


def leaves_of(text: str, counter: Counter) -> tuple[list[int], list[int]]:
    """Lengths and token counts of the pre-tokens of ``text``."""
    lengths: list[int] = []
    tokens: list[int] = []
    for pieces in split(text):
        lengths += map(len, pieces)
        tokens += counter.counts(pieces)
    return lengths, tokens


class TokenTree:
    """Segment tree over a text's pre-tokens; ``kept`` are the lengths and
    token counts of its pre-tokens, if they are known."""

    def __init__(self, text: str, counter: Counter, kept: tuple[list[int], list[int]] | None = None):
        self.text, self.counter = text, counter
        self.encoded = 0  # pre-tokens encoded by edits
        self._build(*(kept or leaves_of(text, counter)))

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        """Lengths and token counts of all pre-tokens."""
        return list(chain.from_iterable(self.leaf_lengths)), list(chain.from_iterable(self.leaf_tokens))

    def _build(self, lengths: list[int], tokens: list[int]) -> None:
        starts = range(0, max(len(lengths), 1), LEAF)
        self.leaf_lengths = [lengths[i : i + LEAF] for i in starts]
        self.leaf_tokens = [tokens[i : i + LEAF] for i in starts]
        self.width = 1 << max(len(self.leaf_lengths) - 1, 0).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (a, b) in enumerate(zip(self.leaf_lengths, self.leaf_tokens)):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(a), sum(b)
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def pretokens(self) -> int:
        return sum(map(len, self.leaf_lengths))

    def _update(self, leaf: int) -> None:
        node = self.width + leaf
        self.chars[node], self.tokens[node] = sum(self.leaf_lengths[leaf]), sum(self.leaf_tokens[leaf])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _locate(self, place: int) -> tuple[int, int, int]:
        """Leaf, index in it and start of the pre-token that holds character
        ``place`` (past the end: one past the last pre-token)."""
        if place >= self.chars[1]:
            last = len(self.leaf_lengths) - 1
            return last, len(self.leaf_lengths[last]), self.chars[1]
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        for i, n in enumerate(self.leaf_lengths[leaf]):
            if place < start + n:
                return leaf, i, start
            start += n
        raise AssertionError("sums of the tree don't match its leaves")

    def edit(self, start: int, length: int, new: str) -> None:
        """Replace ``length`` characters from ``start`` by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(start + max(length, 0), len(self.text))
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # Pre-tokens that end LOOKAHEAD characters before the edit can't change.
        leaf, index, at = self._locate(max(start - LOOKAHEAD, 0))
        if index and at == start - LOOKAHEAD:
            index -= 1
            at -= self.leaf_lengths[leaf][index]
        # Old boundaries from the first one at or after the edit's end.
        old_leaf, old_index, old = self._locate(end)
        if old < end:
            old += self.leaf_lengths[old_leaf][old_index]
            old_index += 1
        pieces: list[str] = []
        while at < len(text):
            if at >= start + len(new):
                while old < at - shift:
                    while old_index >= len(self.leaf_lengths[old_leaf]):
                        old_leaf, old_index = old_leaf + 1, 0
                    old += self.leaf_lengths[old_leaf][old_index]
                    old_index += 1
                if old == at - shift:
                    break
            piece = _SPLIT.match(text, at).group()
            pieces.append(piece)
            at += len(piece)
        else:
            old_leaf = len(self.leaf_lengths) - 1
            old_index = len(self.leaf_lengths[old_leaf])
        self.encoded += len(pieces)
        lengths, tokens = [len(p) for p in pieces], self.counter.counts(pieces)
        tail = (self.leaf_lengths[old_leaf][old_index:], self.leaf_tokens[old_leaf][old_index:])
        self.leaf_lengths[leaf] = self.leaf_lengths[leaf][:index] + lengths
        self.leaf_tokens[leaf] = self.leaf_tokens[leaf][:index] + tokens
        for gone in range(leaf + 1, old_leaf):
            self.leaf_lengths[gone], self.leaf_tokens[gone] = [], []
            self._update(gone)
        if old_leaf > leaf:
            self.leaf_lengths[old_leaf], self.leaf_tokens[old_leaf] = tail
            self._update(old_leaf)
        else:
            self.leaf_lengths[leaf] += tail[0]
            self.leaf_tokens[leaf] += tail[1]
        self._update(leaf)
        self.text = text
        if len(self.leaf_lengths[leaf]) > 8 * LEAF:
            self._build(*self.leaves)


EDITS = "array<struct<start:long,length:long,text:string>>"
TREE = "doc_id long, text string, lengths array<int>, tokens array<int>, n_tokens long"
COUNTS = "pretokens long, tokens_before long, reencoded long"
ROWS = 256  # rows in Python at a time, and of a written batch
NUMBERS = pa.list_(pa.int32())


def _array(values: tuple, kind: pa.DataType) -> pa.Array:
    """An Arrow array; lists of numbers go through one flat numpy array."""
    if kind != NUMBERS:
        return pa.array(values, kind)
    ends = list(accumulate(map(len, values), initial=0))
    flat = np.fromiter(chain.from_iterable(values), np.int32, ends[-1])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _values(column: pa.Array) -> list:
    """The values of an Arrow array; lists of numbers from their flat array."""
    kind = column.type
    if not pa.types.is_list(kind) or kind.value_type != NUMBERS.value_type or column.null_count or column.values.null_count:
        return column.to_pylist()
    ends = column.offsets.to_numpy().tolist()
    flat = column.values.slice(ends[0], ends[-1] - ends[0]).to_numpy().tolist()
    return [flat[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:])]


def _trees(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, ROWS)):
        yield pa.RecordBatch.from_arrays([_array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[tuple]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield zip(*[_values(c.slice(at, ROWS)) for c in batch.columns])


_TREE_FIELDS = [
    ("doc_id", pa.int64()),
    ("text", pa.string()),
    ("lengths", NUMBERS),
    ("tokens", NUMBERS),
    ("n_tokens", pa.int64()),
]
_COUNT_FIELDS = [("pretokens", pa.int64()), ("tokens_before", pa.int64()), ("reencoded", pa.int64())]


def build_trees(docs: DataFrame, ranks: bytes, path: str) -> DataFrame:
    """Split and encode every row of ``docs`` (doc_id, text) once and keep its
    tree under ``path``; returns the kept trees."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema(_TREE_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)

        def rows() -> Iterator[tuple]:
            for part in _parts(batches):
                for doc_id, text in part:
                    lengths, tokens = leaves_of(text or "", counter)
                    yield doc_id, text, lengths, tokens, sum(tokens)

        yield from _trees(rows(), schema)

    trees = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TREE)
    trees.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(TREE).parquet(path)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """The trees that ``edits`` (doc_id, edits; one row per doc_id) touches,
    with their edits.  A bitmap of the edited ids (fixed size, broadcast) keeps
    the other trees out of the shuffle."""
    todo = edits.select(F.col("doc_id").cast("long").alias("_id"), F.col("edits").cast(EDITS).alias("edits"))
    maybe = C.flag_maybe(trees, "doc_id", todo, "_id").filter("_maybe").drop("_maybe")
    return maybe.join(todo, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")


def update_trees(rows: DataFrame, ranks: bytes) -> DataFrame:
    """The trees of ``rows`` (kept trees with a column edits: array of start,
    length and text, applied in order, each to the text the one before it
    left) after their edits, with the pre-tokens and tokens before and the
    number of pre-tokens encoded again."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema(_TREE_FIELDS + _COUNT_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)

        def updated() -> Iterator[tuple]:
            for part in _parts(batches):
                for doc_id, text, lengths, tokens, edits in part:
                    tree = TokenTree(text or "", counter, (lengths, tokens))
                    before = (tree.pretokens, tree.total)
                    for e in edits or []:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                    yield doc_id, tree.text if edits else text, *tree.leaves, tree.total, *before, tree.encoded

        yield from _trees(updated(), schema)

    kept = rows.select("doc_id", "text", "lengths", "tokens", F.col("edits").cast(EDITS))
    return kept.mapInArrow(run, f"{TREE}, {COUNTS}")


def count_tokens(docs: DataFrame, ranks: bytes, make_edits: Callable[[DataFrame], DataFrame], path: str | None = None) -> DataFrame:
    """doc_id, pretokens, n_tokens, n_tokens_edited, reencoded of every row of
    ``docs``: trees are kept under ``path`` (by default a new folder in the
    shared one) and updated by the column ``edits`` that ``make_edits`` adds
    to them."""
    trees = build_trees(docs, ranks, path or C.scratch(docs.sparkSession, "token-trees"))
    after = update_trees(make_edits(trees), ranks)
    return after.select("doc_id", "pretokens", F.col("tokens_before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_edited"), "reencoded")


def sample_edits(trees: DataFrame) -> DataFrame:
    """Every tree with three edits of its text: its middle overwritten by its own
    beginning in capitals, a cut in the first quarter, a note put before it."""
    n = F.char_length(F.coalesce("text", F.lit("")))

    def edit(start, length, text):
        return F.struct(start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), text.alias("text"))

    first = edit(F.floor(n / 2), 16, F.upper(F.left(F.coalesce("text", F.lit("")), F.lit(24))))
    edits = F.array(first, edit(F.floor(n / 4), 12, F.lit("")), edit(F.lit(0), 0, F.lit("Note: it's edited. ")))
    return trees.withColumn("edits", edits)


def op8_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    with open(vocabulary or vocabulary_path(), "rb") as f:
        ranks = f.read()
    return count_tokens(C.table(spark, sf_dir, "documents"), ranks, sample_edits)
