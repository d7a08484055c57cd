import hashlib
import re
from unittest import mock

from pyspark.sql import functions as F

from ordertide.llm import op6_spotsigs as O


def query(spark, df):
    with mock.patch("ordertide.llm.common.table", lambda *_: df):
        return O.op6_spotsigs(spark, "")


def edited(texts):
    """By descending id: the last third replaced by the next text's start."""
    order = sorted(texts, reverse=True)
    out = {}
    for k, i in enumerate(order):
        x, y = texts[i], texts[order[(k + 1) % len(order)]]
        cut = len(x) // 3
        out[i] = x[: len(x) - cut] + y[:cut] if cut else x
    return out


def chains(text):
    """The spot signatures of a text before they are hashed, in plain Python."""
    common = {*O.ANCHORS, "."}
    low = text.lower()
    words = re.findall(O.TOKEN, low.translate({ord(c): "." for c in O.PUNCTUATION})) or [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    content = [w for w in words if w not in common]
    spots = [("", 0)]
    for p, w in enumerate(words if content else []):
        if w in common:
            spots.append((w, sum(v not in common for v in words[:p])))
    content = [*(content or words), None]
    return {(a, content[k], content[k + 1]) for a, k in spots if k < len(content) - 1}


def brute(spark, texts):
    """Text -> set of hashed signatures."""
    found = {t: chains(t) for t in texts}
    every = sorted({c for cs in found.values() for c in cs}, key=str)
    df = spark.createDataFrame(every, "a string, b string, c string").select("*", F.hash("a", "b", "c").alias("h"))
    hashed = {(r["a"], r["b"], r["c"]): r["h"] for r in df.collect()}
    return {t: {hashed[c] for c in cs} for t, cs in found.items()}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def printed(sigs):
    return " ".join(f"{h & 0xFFFFFFFF:x}" for h in sorted(sigs))


def check(spark, rows, texts):
    want = edited(texts)
    order = sorted(texts, reverse=True)
    after = {i: texts[order[(k + 1) % len(order)]] for k, i in enumerate(order)}
    sigs = brute(spark, {*texts.values(), *want.values()})
    for r in rows:
        own, cut = sigs[texts[r["doc_id"]]], sigs[want[r["doc_id"]]]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (printed(own), printed(cut))
        assert abs(r["near_edited"] - jaccard(own, cut)) < 1e-12
        assert abs(r["near_next"] - jaccard(own, sigs[after[r["doc_id"]]])) < 1e-12
    assert len(rows) == len(texts)
    for r in rows:
        assert r["n_chars"] == len(texts[r["doc_id"]])
        assert r["edited_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_query_on_the_tables(spark, sf_dir):
    rows = O.op6_spotsigs(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check(spark, rows, {r["doc_id"]: r["text"] for r in docs})
    prints = {}
    for r in rows:
        prints.setdefault(next(d["text"] for d in docs if d["doc_id"] == r["doc_id"]), set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r["near_edited"] > r["near_next"] + 0.1 for r in rows) > 0.9 * len(rows)


def test_sparse_and_negative_ids(spark, make_docs):
    ids = [-5, -4, 0, 7, 8, 9, 1000, 10**12, 10**12 + 1, 2**62]
    texts = {i: f"text number {i} of the test is here to stay " * (k + 1) for k, i in enumerate(ids)}
    check(spark, query(spark, make_docs([(i, t, "s") for i, t in texts.items()]).repartition(4)).collect(), texts)
    check(spark, query(spark, make_docs([(3, "only one of them", "s")])).collect(), {3: "only one of them"})


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = query(spark, odd_docs).collect()
    assert len(rows) == len(odd_rows)
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {""}
    assert query(spark, no_docs).collect() == []


def test_signatures_by_hand(spark):
    """The chains that follow each anchor, and the one at the start."""
    df = spark.createDataFrame([("The cat, sat ON the mat of red wool",)], "text string")
    got = df.select(O.signatures(F.col("text"), chain=2).alias("s")).first()["s"]
    chains = [("", "cat", "sat"), ("the", "cat", "sat"), (".", "sat", "mat"), ("on", "mat", "red"), ("the", "mat", "red"), ("of", "red", "wool")]
    want = spark.createDataFrame(chains, "a string, b string, c string").select(F.hash("a", "b", "c").alias("h")).collect()
    assert got == sorted({r["h"] for r in want})


def test_similar_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets = {r["doc_id"]: frozenset(r["sigs"]) for r in O.fingerprints(docs).collect()}
    members, links = O.similar_documents(docs, 0.6)
    rep = {r["doc_id"]: r["class"] for r in members.collect()}
    first = {}
    for i in sorted(sets):
        assert rep[i] == (first.setdefault(sets[i], i) if sets[i] else i)
    reps = sorted(set(rep.values()))
    want = {
        frozenset((a, b))
        for k, a in enumerate(reps)
        for b in reps[k + 1 :]
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])
    }
    assert {frozenset((r["a"], r["b"])) for r in links.collect()} == want


def test_plan_is_native(spark, sf_dir):
    plan = O.op6_spotsigs(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
