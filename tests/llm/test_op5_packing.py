import itertools
import random

from pyspark.sql import functions as F

from ordertide.llm import op5_packing as O


def test_boundaries_against_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        m, k = rng.randint(1, 8), rng.randint(1, 5)
        top = sorted(rng.sample(range(50), m))
        n = [rng.randint(1, 9) for _ in top]

        def cost(edges):
            return sum(c * min(e for e in edges if e >= t) for t, c in zip(top, n))

        import numpy as np

        got = O.boundaries(np.array(top), np.array(n), k)
        best = min(cost([*s, top[-1]]) for r in range(min(k, m)) for s in itertools.combinations(top[:-1], r))
        assert len(got) <= k and cost(got) == best


def test_bins_keep_order(spark):
    lengths = sorted({*range(0, 9000), *(2**p + d for p in range(12, 50) for d in (-1, 0, 1))})
    rows = spark.createDataFrame([(n,) for n in lengths], "length long").select("length", O.length_bin(F.col("length")).alias("bin"))
    rows = sorted(tuple(r) for r in rows.collect())
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]))
    assert all(a[1] < b[1] for a, b in zip(rows[:4096], rows[1:4096]))
    assert all(max(g) <= min(g) * (1 + 1 / 256) for _, g in ((b, [r[0] for r in rows if r[1] == b]) for b in {r[1] for r in rows if r[0] > 4096}))


def test_pack(spark, odd_docs, odd_rows, no_docs):
    rows = O.pack(odd_docs, buckets=4, budget=64).collect()
    assert sorted(r["length"] for r in rows) == sorted(len((t or "").encode().split()) for _, t, _ in odd_rows)
    by_batch = {}
    for r in rows:
        assert r["length"] <= r["padded_length"]
        by_batch.setdefault((r["bucket"], r["batch"]), []).append(r)
    for batch in by_batch.values():
        assert sorted(r["place"] for r in batch) == list(range(len(batch)))
        assert len(batch) == 1 or sum(r["padded_length"] for r in batch) <= 64
    per_bucket = {}
    for r in rows:
        per_bucket.setdefault(r["bucket"], []).append(r)
    for b in per_bucket.values():
        assert max(r["length"] for r in b) == b[0]["padded_length"]
        assert {r["batch"] for r in b} == set(range(max(r["batch"] for r in b) + 1))
    assert O.pack(no_docs).collect() == []


def test_batches_cover_all_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = O.batches(docs).agg(F.sum("documents"), F.max(F.when(F.col("documents") > 1, F.col("padded_words")))).first()
    assert total[0] == docs.count() and total[1] <= O.BUDGET
