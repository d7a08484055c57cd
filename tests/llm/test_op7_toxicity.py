import random
import zlib

import numpy as np

from ordertide.llm import op7_toxicity as O

WORDS = "alpha beta gamma delta house tree water stone green light paper cloud river field".split()


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(WORDS) + rng.choice("abcde") for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["awful", "Rotten!", "vile,"]))
        rows.append((k, " ".join(words), "s"))
        labels.append((k, 1, toxic))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus(600, 8)
    docs = make_docs(rows)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = O.fit(docs, O.training_labels(table))
    score = O.scorer(spark, weights)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score(docs["text"]).alias("s")).collect()}
    held = [(got[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.97
    assert 0 < len(weights.features) < 500  # L1 keeps the weights few
    clean = O.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in got.items() if s < 0.5}


def test_held_out_rule(spark):
    ids = [0, 1, 17, 123456789, -3]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = [r[0] for r in df.select(O.is_held_out(df["doc_id"])).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def test_labels_of_held_out_rows_are_not_learnt(spark, make_docs):
    rows, labels = corpus(300, 9)
    docs = make_docs(rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (O.fit(docs, O.training_labels(spark.createDataFrame(x, "doc_id long, quality int, toxic int"))) for x in (labels, flipped))
    assert a.intercept == b.intercept and (a.features == b.features).all() and (a.values == b.values).all()


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (9, 1, None), (None, 1, 1), (10, None, 1), (10, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    weights = O.fit(odd_docs, O.training_labels(labels))
    score = O.scorer(spark, weights)
    got = [r[0] for r in odd_docs.select(score(odd_docs["text"])).collect()]
    assert len(got) == len(odd_rows) and all(0 <= s <= 1 for s in got)
    clean = O.clean_documents(odd_docs, labels.limit(0))
    assert clean.columns == odd_docs.columns and clean.count() == len(odd_rows)
    assert O.clean_documents(no_docs, labels).collect() == []


def test_query(spark, sf_dir):
    rows = O.op7_toxicity(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_training_by_hand():
    """FTRL-proximal in plain Python, a coordinate at a time."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(-50, 50, rng.integers(0, 12)).astype(np.int32)) for _ in range(200)]
    toxic = np.array([int(3 in r or -7 in r) for r in rows])
    z, n = {}, {}

    def weight(c):
        x, bound = z.get(c, 0.0), 0.0 if c is None else O.L1
        if abs(x) <= bound:
            return 0.0
        return -(x - np.copysign(bound, x)) / ((O.BETA + n.get(c, 0.0) ** 0.5) / O.ALPHA + O.L2)

    order = np.random.default_rng(7)
    for _ in range(O.EPOCHS):
        for k in order.permutation(len(rows)):
            own = [None, *rows[k].tolist()]
            now = [weight(c) for c in own]
            g = 1 / (1 + np.exp(-sum(now))) - toxic[k]
            for c, w in zip(own, now):
                before = n.get(c, 0.0)
                n[c] = before + g * g
                z[c] = z.get(c, 0.0) + g - (n[c] ** 0.5 - before**0.5) / O.ALPHA * w
    known, values, intercept = O.train(rows, toxic)
    want = {c: weight(c) for c in z if c is not None and weight(c)}
    assert want and dict(zip(known.tolist(), np.round(values, 9))) == {c: round(w, 9) for c, w in want.items()}
    assert abs(intercept - weight(None)) < 1e-9


def test_score_by_hand(spark, make_docs):
    """A score is the logistic of the intercept and the features' weights."""
    texts = ["Awful house tree", "house house of tree", "", None, "rottenness"]
    rows = list(O.document_features([(t or "").lower().encode() for t in texts]))
    assert rows[2] is None and set(rows[4]) & set(next(O.document_features([b"rottenly"])))  # a beginning in common
    known = np.unique(np.concatenate([r for r in rows if r is not None]))
    values = np.linspace(-1, 1, len(known)).astype(np.float32)
    score = O.scorer(spark, O.Weights(known, values, -0.5))
    docs = make_docs([(k, t, "s") for k, t in enumerate(texts)])
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", score(docs["text"]).alias("s")).collect()}
    for k, row in enumerate(rows):
        total = -0.5 + sum(float(v) for f, v in zip(known, values) if row is not None and f in row)
        assert abs(got[k] - 1 / (1 + np.exp(-total))) < 1e-6


def test_the_sample_does_not_move_the_scores(spark, make_docs, monkeypatch):
    """Clean rows left out of the sample are made up for by the intercept."""
    rows, labels = corpus(600, 12)
    table = O.training_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    whole = O.fit(make_docs(rows), table)
    monkeypatch.setattr(O, "MAX_CLEAN", 60)
    part = O.fit(make_docs(rows), table)
    assert part.intercept < 0 and abs(part.intercept - whole.intercept) < 1.5


def test_no_labels_no_documents(spark, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert O.fit(no_docs, O.training_labels(labels)).features.size == 0
    assert no_docs.select(O.scorer(spark, O.fit(no_docs, O.training_labels(labels)))(no_docs["text"])).collect() == []
