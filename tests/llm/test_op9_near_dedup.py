import random
from collections import defaultdict

import numpy as np
import pytest

from ordertide.llm import hyperminhash as H
from ordertide.llm import op9_near_dedup as O
from ordertide.llm import words as W


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1))


def brute(texts, width, percent):
    """(set size, component) per id, every pair that shares a shingle compared."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for g in sets[i]:
            for j in holders[g]:
                shared[j] += 1
            holders[g].append(i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in texts}


def found(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def family(rng, base, n, most):
    """Copies of ``base`` with up to ``most`` words replaced."""
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, make_docs, width, percent):
    """Families of near copies around the threshold, and chains of edits."""
    rng = random.Random(width)
    texts = []
    for f in range(4):
        base = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([30, 80, 150])))
        texts += family(rng, base, 60, 6)
        step = base
        for _ in range(15):  # each close to the one before, ends far apart
            step = family(rng, step, 1, 2)[0]
            texts.append(step)
    texts += [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(1, 60))) for _ in range(200)]
    rng.shuffle(texts)
    table = dict(enumerate(texts))
    rows = O.near_groups(make_docs([(i, t, "s") for i, t in table.items()]).repartition(6), width, percent).collect()
    want = brute(table, width, percent)
    assert found(rows) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert len({c for _, c in want.values()}) < len(texts) - 100


def test_blocks_of_a_large_cluster(spark, make_docs, monkeypatch):
    """Small blocks: every block pair of a cluster is compared."""
    monkeypatch.setattr(O, "BLOCK_DOCS", 8)
    rng = random.Random(12)
    base = " ".join(f"w{rng.randrange(3000)}" for _ in range(60))
    table = dict(enumerate(family(rng, base, 150, 5)))
    rows = O.near_groups(make_docs([(i, t, "s") for i, t in table.items()]), 3, 85).collect()
    assert found(rows) == brute(table, 3, 85)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = O.near_groups(odd_docs, 3, 85).collect()
    assert len(rows) == len(odd_rows)
    got = found(rows)
    want = brute({i: t for i, t, _ in odd_rows if i is not None}, 3, 85)
    assert {i: got[i] for i in want} == want
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    kept = O.distinct_documents(odd_docs, 3, 85)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if r["kept"])
    assert O.near_groups(no_docs, 3, 85).collect() == [] and O.distinct_documents(no_docs).collect() == []


def test_tables(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert found(O.op9_near_dedup(spark, sf_dir).collect()) == brute(texts, O.WIDTH, O.PERCENT)


def test_shingles_are_exact():
    rng = random.Random(3)
    texts = ["", " ", "a", "a B", "a b c", "A b C a b c", "x " * 50] + ["".join(rng.choice("aB \t\né") for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts.append("long word" * 300_000)
    for text, words in zip(texts, W.word_hashes([t.encode() for t in texts])):
        assert len(words) == len(text.encode().split())
        assert len(W.shingles(words, 3)) == len(shingle_set(text, 3))
    same = list(W.word_hashes([b"One two", b"one TWO", "é É".encode()]))
    assert (same[0] == same[1]).all() and same[2][0] != same[2][1]


def test_estimates_are_corrected():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.3, 0.6, 0.85, 1.0):
        n = 2000
        both = int(2 * n * share / (1 + share))
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = np.unique(pool[:n]), np.unique(pool[n - both : 2 * n - both])
            ra, rb = H.registers(a)[None], H.registers(b)[None]
            errors.append(H.estimate(ra, rb, np.array([n]), np.array([n]))[0][0] - share)
        assert abs(np.mean(errors)) < 0.02


def test_empty_registers_are_filled():
    rng = np.random.default_rng(5)
    regs = np.stack([H.registers(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))) for n in (1, 2, 7, 50, 4000)])
    filled = H.fill_empty(regs)
    assert (filled != 0).all()
    assert ((regs == 0) | (regs == filled)).all()
    assert len(set(filled[0])) == 1 and H.band_keys(regs).shape == (5, H.BANDS)


def test_another_text_of_a_dropped_id_stays(make_docs):
    """Rows (5, x), (5, y), (1, y): x is linked with nothing and stays."""
    x, y = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    docs = make_docs([(5, x, "s"), (5, y, "s"), (1, y, "s"), (7, x + " tail", "s"), (7, "alone", "s"), (None, y, "s")])
    kept = O.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted([(0, y), (1, y), (5, x), (7, "alone")])
