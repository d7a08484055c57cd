import re
from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st

from ordertide.llm import op11_filter_audit as op

ids = st.lists(st.integers(0, 300), unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(st.lists(ids, max_size=5))
def test_union(lists):
    assert op.union(lists) == sorted(set().union(*lists))


@settings(max_examples=200, deadline=None)
@given(ids, ids)
def test_difference_and_common(a, b):
    assert op.difference(a, b) == sorted(set(a) - set(b))
    assert op.common(a, b) == len(set(a) & set(b))


@settings(max_examples=100, deadline=None)
@given(ids, st.integers(0, 20), st.integers(-5, 310))
def test_gallop(a, at, bound):
    at = min(at, len(a))
    assert op.gallop(a, at, bound) == next((k for k in range(at, len(a)) if a[k] >= bound), len(a))


def brute_force(rows, labels):
    """rows: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    rows = [(d, s or "", t or "") for d, s, t in rows]
    fails = []
    for d, _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 50:
            f.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            f.add("C")
        if re.search(r"[#$%&*|]", t):
            f.add("D")
        if d is not None and any(e is not None and e < d and u == t for e, _, u in rows):
            f.add("E")
        fails.append(f)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = [], {}
    for part in {s for _, s, _ in rows}:
        mine = [(rows[k][0], fails[k]) for k in range(len(rows)) if rows[k][1] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append(
                    (part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in mine) - len(gone),
                     sum(x[1] == {f} for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone), f)
                )
    return sorted((*r[:9], shapley[r[0], r[9]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def check(docs, labels):
    got = sorted(tuple(r) for r in op.audit(docs, labels).select(*COLUMNS).collect())
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    assert got == brute_force(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    return got


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, odd_docs):
    labels = labels_of(spark, [(1, 1, 0), (3, None, 1), (5, 1, 1), (8, 0, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)])
    assert len(check(odd_docs, labels)) == 600 * 4


def test_hot_text_and_short_ranges(spark, make_docs, monkeypatch):
    """Copies dealt over salts, lists over many ranges."""
    monkeypatch.setattr(op, "HOT_COPIES", 5)
    monkeypatch.setattr(op, "RANGE_BITS", 3)
    rows = [(i, "The SAME text" if i % 3 else f"text {i} costs 5$ " + "a b " * (i % 40), "ab"[i % 2]) for i in range(120)]
    check(make_docs(rows).repartition(3), labels_of(spark, [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 3)]))


def test_empty_table(spark, no_docs):
    assert op.audit(no_docs, labels_of(spark, [])).collect() == []
