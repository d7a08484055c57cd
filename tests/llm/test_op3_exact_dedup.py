import hashlib

import duckdb
import pyarrow as pa
import pytest

from ordertide.llm import op3_exact_dedup as O

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(t):
    return (t or "").translate(LOWER)


def brute(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[norm(t)]
        keep = max((k for k in ids if k is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("key_bits", [64, 3, 1])
def test_against_brute_force(odd_docs, odd_rows, key_bits):
    """Short keys collide: chains tell the texts apart by their bytes."""
    got = [tuple(r) for r in O.dedup(odd_docs, bucket_keys=2, key_bits=key_bits).collect()]
    assert sorted(got, key=str) == brute(odd_rows)


def test_hot_group(make_docs):
    rows = [(k, "Hot Text" if k % 3 else f"text {k % 50}", "s") for k in range(900)]
    got = [tuple(r) for r in O.dedup(make_docs(rows).repartition(7)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_distinct_documents(odd_docs, odd_rows, no_docs):
    kept = O.distinct_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(norm(r["text"]) for r in rows) == sorted({norm(t) for _, t, _ in odd_rows})
    assert {r["doc_id"] for r in rows if norm(r["text"]).startswith("the same")} == {8}
    assert O.dedup(no_docs).collect() == [] and O.distinct_documents(no_docs).collect() == []


def test_directory_doubling():
    counts = {0b0000: 5, 0b0001: 1, 0b0100: 2, 0b1111: 1}
    buckets, coarse = O.split_buckets(counts, 4, 3)
    assert coarse == [(0, 4)]
    assert all(sum(n for s, n in counts.items() if s >> (4 - d) == p) <= 3 for p, d in buckets)
    rows = O.directory_rows(4, sorted(buckets + coarse))
    assert sorted(s for s, _ in rows) == list(range(16))


def test_directory_counts_deeper_when_needed(spark):
    keys = spark.createDataFrame([(k,) for k in range(64)], "key long")  # all share their leading bits
    depth, buckets = O.build_directory(keys, "key", bucket_keys=8, max_depth=16)
    assert depth == 16 and sum(2.0**-d for _, d in buckets) == 1.0


def test_sql(spark, sf_dir):
    from tests.oracle_check import digest

    df = O.op3_exact_dedup(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    res = con.sql(O.ORACLE)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(res.columns, res.fetchall())[0]


def test_another_text_of_a_dropped_id_stays(make_docs):
    rows = [(5, "A", "s"), (5, "B", "s"), (9, "a", "s"), (5, "B", "s"), (4, "A", "s")]
    kept = O.distinct_documents(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(5, "B"), (9, "a")]


def test_index_holds_every_text_once(odd_docs, odd_rows, spark):
    """The answer is read from the index: a link per text, in its bucket."""
    path = O.C.scratch(spark, "exact-index-test")
    entries, links = O.build_index(odd_docs, path, bucket_keys=2, key_bits=3)
    rows = links.collect()
    assert sorted(r["sha"] for r in rows) == sorted({hashlib.sha256(norm(t).encode()).hexdigest() for _, t, _ in odd_rows})
    by_key = {}
    for r in rows:
        by_key.setdefault((r["bucket"], r["key"]), []).append(r["chain"])
    assert any(len(c) > 1 for c in by_key.values())
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by_key.values())
    assert {(r["bucket"], r["key"]) for r in entries.collect()} == set(by_key)


def test_chains_hand_on_in_bounded_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(O, "HELD", 20)
    monkeypatch.setattr(O, "BATCH", 2)
    rows = [(k, f"text {k % 7}", "s") for k in range(60)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([k % 2 for k, _, _ in rows]), pa.array([t.encode() for _, t, _ in rows]), pa.array([k for k, _, _ in rows])], ["key", "text", "doc_id"]
    )
    links = [r for b in O.chain_read_rows(iter([batch])) for r in b.to_pylist()]
    assert len(links) > 14 and sum(r["group_size"] for r in links) == 60
    links.sort(key=lambda r: r["key"])
    owned = pa.RecordBatch.from_pylist([{"bucket": 0, **r} for r in links])
    done = [r for b in O.chain_owned_keys(iter([owned])) for r in b.to_pylist()]
    want = {}
    for k, t, _ in rows:
        want.setdefault((k % 2, hashlib.sha256(t.encode()).hexdigest()), []).append(k)
    assert {(r["key"], r["sha"]): (r["keep_id"], r["group_size"]) for r in done} == {c: (max(i), len(i)) for c, i in want.items()}
