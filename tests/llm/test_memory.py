"""What a task's Python worker and its executor hold at once."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ordertide.llm import common as C
from ordertide.llm import op3_exact_dedup, op7_toxicity, op9_near_dedup


class Step:
    """Takes the place of a DataFrame; gives the function that Spark would run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def peak_of(run):
    tracemalloc.start()
    try:
        result = run()
        return tracemalloc.get_traced_memory()[1], result
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    return [" ".join(f"word{k}" for k in rng.integers(0, 5000, 250)).encode() for _ in range(3000)]


def test_pieces():
    values = [None, b"", b"x" * 5000, b"yy", None, b"z" * 300] * 50
    batch = pa.RecordBatch.from_pydict({"n": list(range(300)), "text": pa.array(values, pa.binary())})
    cut = list(C.pieces(batch, 4000))
    assert pa.Table.from_batches(cut).to_pydict() == batch.to_pydict()
    assert len(cut) > 50 and all(len(p) == 1 or p.nbytes <= 4000 for p in cut)
    assert [len(p) for p in C.pieces(batch.slice(0, 0))] == [0]


def test_features_hold_a_piece(texts):
    column = pa.array(texts, pa.binary())
    peak, sizes = peak_of(lambda: [len(f) for f in op7_toxicity.features_of(column)])
    assert sizes == [len(f) for f in op7_toxicity.document_features(texts)]
    assert column.nbytes > 6e6 and peak < 12e6, peak


def test_sketches_hold_a_piece(spark, texts):
    run = op9_near_dedup.sketch_rows(Step(), 5)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], ["doc_id", "text"])
    peak, ids = peak_of(lambda: [i for out in run([batch]) for i in out.column(0).to_pylist()])
    assert ids == list(range(len(texts)))
    assert peak < 12e6, peak


def test_bands_hold_a_piece(spark, texts):
    regs = pa.array([bytes([k % 251 + 1, 1]) * 256 for k in range(8000)], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(8000), pa.int64()), regs], ["id", "regs"])
    run = op9_near_dedup.band_rows(Step())
    peak, rows = peak_of(lambda: sum(out.num_rows for out in run([batch])))
    assert rows == 8000 * 42
    assert peak < 12e6, peak


def test_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    def most():
        return max(r["n"] for r in spark.range(3000, numPartitions=1).mapInArrow(sizes, "n long").collect())

    assert most() > C.BATCH_RECORDS
    with C.small_batches(spark):
        assert most() == C.BATCH_RECORDS
    with pytest.raises(ValueError), C.small_batches(spark):
        raise ValueError
    assert spark.conf.get(C.RECORDS, None) is None
    spark.conf.set(C.RECORDS, "700")
    try:
        with C.small_batches(spark):
            assert most() == 700
        assert spark.conf.get(C.RECORDS) == "700"
    finally:
        spark.conf.unset(C.RECORDS)


def test_directory_needs_no_python_worker(spark):
    """A list of rows would start workers of another kind on every executor."""
    buckets = [(0, 1), (2, 2), (3, 2)]
    table = op3_exact_dedup.directory_table(spark, 2, buckets)
    assert [tuple(r) for r in table.collect()] == op3_exact_dedup.directory_rows(2, buckets)
    assert "LocalTableScan" in table._jdf.queryExecution().toString()
