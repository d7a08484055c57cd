import hashlib
"""run() against the same stages in plain Python; the classifier's decisions
are taken from the operator (its accuracy is tested on its own)."""

import corpus_pipeline as P
from ordertide.llm import op1_mixing, op5_packing, op7_toxicity
from tests.llm.test_op1_mixing import targets
from tests.llm.test_op9_near_dedup import brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages(spark, sf_dir, tmp_path):
    docs = P.common.table(spark, sf_dir, "documents")
    columns = docs.columns
    rows = {}
    for name, stage in P.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        rows[name] = docs.collect()
    packed = P.STAGES[-1][1](spark, docs, sf_dir).collect()

    bad = {r["doc_id"] for r in op7_toxicity.op7_toxicity(spark, sf_dir).collect() if r["predicted"]}
    all_docs = {r["doc_id"]: r for r in P.common.table(spark, sf_dir, "documents").collect()}
    assert bad and {r["doc_id"] for r in rows["toxicity"]} == set(all_docs) - bad

    last = {}
    for r in rows["toxicity"]:
        norm = r["text"].translate(LOWER)
        last[norm] = max(last.get(norm, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows["exact_dedup"]) == sorted(last.values())

    texts = {r["doc_id"]: r["text"] for r in rows["exact_dedup"]}
    assert sorted(r["doc_id"] for r in rows["near_dedup"]) == sorted(i for i, (_, c) in brute(texts, 5, 80).items() if i == c)

    by_source, size = {}, {}
    for r in rows["near_dedup"]:
        size[r["doc_id"]] = len(r["text"].encode().split())
        by_source.setdefault(r["source"], []).append((size[r["doc_id"]], r["doc_id"]))
    want = targets({s: sum(n for n, _ in d) for s, d in by_source.items()})
    offsets = {s: int(hashlib.md5(f"{op1_mixing.SEED}:={s}".encode()).hexdigest()[:8], 16) / 2**32 for s in by_source}
    mixed = []
    for s, d in by_source.items():
        share = want[s] / sum(n for n, _ in d)
        for rank, (_, i) in enumerate(sorted(d), 1):
            mixed += [i] * (int(rank * share + offsets[s]) - int((rank - 1) * share + offsets[s]))
    assert sorted(r["doc_id"] for r in rows["mixing"]) == sorted(mixed)

    assert sorted((r["doc_id"], r["length"]) for r in packed) == sorted((i, size[i]) for i in mixed)
    room = {}
    for r in packed:
        room.setdefault((r["bucket"], r["batch"]), []).append(r["padded_length"])
    assert all(len(b) == 1 or sum(b) <= op5_packing.BUDGET for b in room.values())
    assert sorted(map(tuple, P.run(spark, sf_dir).collect())) == sorted(map(tuple, packed))


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_odd_documents(spark, odd_docs, odd_rows, no_docs, sf_dir):
    """Every stage takes nulls, repeats, clashing names and no rows at all."""
    for docs in (odd_docs, no_docs):
        for _, stage in P.STAGES:
            out = stage(spark, docs, sf_dir)
            assert out.count() <= 3 * len(odd_rows)
