import random

import pytest
from pyspark.sql import functions as F

from ordertide.llm import op8_token_counts as O

with open(O.vocabulary_path(), "rb") as f:
    RANKS = f.read()
LETTERS = "ab 'sl\n  re12,. é漢\U0001f600tvmd"


@pytest.mark.parametrize("seed", range(4))
def test_edits_equal_encoding_anew(seed):
    rng = random.Random(seed)
    encoding, counter = O._encoding(RANKS), O.Counter(RANKS)

    def some(n):
        return "".join(rng.choice(LETTERS) for _ in range(n))

    for _ in range(150):
        text = some(rng.choice([0, 1, 5, 40, 400, 3000]))
        tree = O.TokenTree(text, counter)
        for _ in range(5):
            start, length, new = rng.randint(-1, len(text) + 2), rng.choice([0, 1, 2, 5, 50]), some(rng.choice([0, 1, 2, 9, 900]))
            tree.edit(start, length, new)
            at = min(max(start, 0), len(text))
            text = text[:at] + new + text[at + length :]
            assert tree.text == text
            assert tree.total == len(encoding.encode_ordinary(text))
            assert [n for leaf in tree.leaf_lengths for n in leaf] == [len(p) for p in O._SPLIT.findall(text)]


def test_only_touched_regions_are_encoded():
    tree = O.TokenTree("some words and more of them " * 5000, O.Counter(RANKS))
    tree.edit(70_000, 4, "x")
    assert tree.encoded < 10


def test_split_in_segments(monkeypatch):
    monkeypatch.setattr(O, "SEGMENT", 37)
    rng = random.Random(9)
    for _ in range(100):
        text = "".join(rng.choice(LETTERS) for _ in range(700))
        assert [p for part in O.split(text) for p in part] == O._SPLIT.findall(text)


def test_table(spark, odd_docs, odd_rows, no_docs):
    encoding = O._encoding(RANKS)
    rows = O.count_tokens(odd_docs, RANKS, O.sample_edits).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(encoding.encode_ordinary(t or "")) for _, t, _ in odd_rows)

    def edited(t):
        n = len(t)
        t = t[: n // 2] + t[:24].upper() + t[n // 2 + 16 :]
        t = t[: n // 4] + t[n // 4 + 12 :]
        return "Note: it's edited. " + t

    assert sorted(r["n_tokens_edited"] for r in rows) == sorted(len(encoding.encode_ordinary(edited(t or ""))) for _, t, _ in odd_rows)
    assert O.count_tokens(no_docs, RANKS, O.sample_edits).collect() == []
    bare = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    for none in ("null", "array()"):
        rows = O.count_tokens(bare, RANKS, lambda t: t.withColumn("edits", F.expr(none).cast(O.EDITS))).collect()
        assert all(r["n_tokens"] == r["n_tokens_edited"] for r in rows) and len(rows) == 2


def test_kept_trees_take_edits_again_and_again(spark, make_docs, monkeypatch):
    """Trees are read back, only edited documents' are updated, and no text is
    split or encoded as a whole; the updated trees take the next edits."""
    rng = random.Random(3)
    encoding = O._encoding(RANKS)
    texts = {k: "".join(rng.choice(LETTERS) for _ in range(rng.choice([0, 3, 200, 3000]))) for k in [*range(40), None]}
    monkeypatch.setattr(O, "ROWS", 3)
    trees = O.build_trees(make_docs([(k, t, "s") for k, t in texts.items()]), RANKS, O.C.scratch(spark, "trees-test"))
    for _ in range(2):
        edits = {}
        for k in [7, 8, 30, None, 99]:
            edits[k] = [(rng.randint(0, 300), rng.choice([0, 4, 30]), "it's " * rng.randint(0, 3)) for _ in range(3)]
        table = spark.createDataFrame(list(edits.items()), f"doc_id long, edits {O.EDITS}")
        after = O.update_trees(O.with_edits(trees, table), RANKS)
        path = O.C.scratch(spark, "trees-test")
        after.write.parquet(path)
        rows = spark.read.parquet(path).collect()
        assert sorted(r["doc_id"] or -1 for r in rows) == [-1, 7, 8, 30]
        for r in rows:
            text = texts[r["doc_id"]]
            assert r["tokens_before"] == len(encoding.encode_ordinary(text))
            for start, length, new in edits[r["doc_id"]]:
                start = min(start, len(text))
                text = text[:start] + new + text[start + length :]
            texts[r["doc_id"]] = text
            assert r["text"] == text and r["n_tokens"] == sum(r["tokens"]) == len(encoding.encode_ordinary(text))
            assert r["lengths"] == [len(p) for p in O._SPLIT.findall(text)]
            assert r["pretokens"] < 50 or r["reencoded"] < r["pretokens"]
        trees = spark.read.parquet(path).select("doc_id", "text", "lengths", "tokens", "n_tokens")


def test_query(spark, sf_dir):
    rows = {r["doc_id"]: r["n_tokens"] for r in O.op8_token_counts(spark, sf_dir).collect()}
    encoding = O._encoding(RANKS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert rows == {r["doc_id"]: len(encoding.encode_ordinary(r["text"])) for r in docs}


def test_lists_of_numbers_go_through_flat_arrays():
    """Also of a slice, of empty lists and with nulls."""
    lists = [[], [1, 2], [3], [], [2**31 - 1, 0]]
    column = O._array(tuple(lists), O.NUMBERS)
    assert column.to_pylist() == lists and column.type == O.NUMBERS
    assert [O._values(column.slice(a, 2)) for a in range(4)] == [lists[a : a + 2] for a in range(4)]
    assert O._values(column.slice(5)) == [] and O._array((), O.NUMBERS).to_pylist() == []
    assert O._values(O.pa.array([[1, None], None], O.NUMBERS)) == [[1, None], None]
    text, counter = "it's some text " * 200, O.Counter(RANKS)
    assert O.leaves_of(text, counter) == O.TokenTree(text, counter).leaves
