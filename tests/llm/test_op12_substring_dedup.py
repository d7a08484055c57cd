import random
import re
from hashlib import sha256

import numpy as np

from ordertide.llm import op12_substring_dedup as op


def brute_force(rows):
    """rows: (doc_id, text)."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, words in split:
        if d is not None:
            for i in range(len(words) - 12):
                w = tuple(words[i : i + 13])
                first[w] = min(first.get(w, d), d)
    out = []
    for d, words in split:
        gone = set()
        if d is not None:
            for i in range(len(words) - 12):
                if first[tuple(words[i : i + 13])] < d:
                    gone |= set(range(i, i + 13))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs):
    got = sorted((tuple(r) for r in op.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)
    assert got == brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()])
    return got


def passages(seed, n, vocabulary, shared=6):
    """Documents of random words with passages of 20 to 60 words in common."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    common = [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(shared)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(common) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randint(1, 40))))
        rows.append((i, rng.choice(["\n", "  ", " "]).join(parts), "s"))
    return rows


def test_odd_rows(odd_docs):
    assert len(check(odd_docs)) == odd_docs.count()


def test_passages(make_docs):
    got = check(make_docs(passages(1, 150, 400)).repartition(4))
    assert sum(r[2] for r in got) > 1000


def test_few_words_many_buckets_and_salts(make_docs, monkeypatch):
    """Two-word texts hold windows everywhere; buckets, frequent sequences,
    salts, long runs and many chunks a task give the same answer."""
    rows = passages(2, 60, 2) + [(100 + i, "a b " * 200, "s") for i in range(30)] + passages(3, 60, 300, 2)
    rows = [(k, t, s) for k, (_, t, s) in enumerate(rows)]
    plain = check(make_docs(rows).repartition(3))
    monkeypatch.setattr(op, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(op, "CHUNK_BYTES", 700)
    monkeypatch.setattr(op, "HEAVY", 1)
    assert check(make_docs(rows).repartition(3)) == plain


def test_colliding_window_hashes_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(op, "_MIX", np.uint64(0))  # windows with the same last word collide
    strings = [" ".join(f"x{i + j}" for j in range(14)).encode() for i in range(5)]
    strings.append(" ".join(["y"] * 12 + ["x13"]).encode())
    string, firsts = op.window_firsts(strings, np.array([9, 8, 7, 6, 5, 4]))
    assert string.tolist() == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert firsts.tolist() == [9, 8, 8, 7, 7, 6, 6, 5, 5, 5, 4]


def test_super_kmers_cover_every_window_once():
    rng = np.random.default_rng(5)
    counts = np.array([0, 5, 13, 40, 0, 300, 12, 13])
    hashes = rng.integers(0, 50, counts.sum()).astype(np.uint64)
    first, windows, _ = op.super_kmers(counts, hashes, np.zeros(0, bool))
    got = sorted(i for a, n in zip(first.tolist(), windows.tolist()) for i in range(a, a + n))
    before = np.cumsum(counts) - counts
    assert got == [int(b) + i for b, n in zip(before, counts) for i in range(n - 12)]
    assert windows.max() <= op.RUN


def test_empty_table(no_docs):
    assert op.dedup(no_docs).collect() == []
