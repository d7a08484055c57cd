import hashlib
import re

from ordertide.llm import op4_pii as O

PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if fine:
                out.append((m.start(), order, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


TEXTS = [
    "",
    None,
    "a@b.co@d.com",
    "a@b.c_x@d.ef x",
    "x@y@z.com a%b+c@d-e.f.g..h",
    "a..b@c.de. @x.y z@",
    "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 5",
    "12--4111111111111111 4111111111111112",
    "4111111111111111" * 3,
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "+1 (968) 555-9369 call é ñ +49 170 1234567 +1+2+1234567890123",
    "\U0001f600 bob@x.org \U0001f600 10.0.0.1",
    "9" * 4000 + ".1.1.1",
    "a" * 30_000,
    "a.b-" * 5000 + "@x.y",
    "mail bob@x.org, " * 300,
]


def query(spark, df):
    from unittest import mock

    with mock.patch("ordertide.llm.common.table", lambda *_: df):
        return O.op4_pii(spark, "")


def check(rows, texts):
    for r in rows:
        want = base_spans(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), r["doc_id"]
        assert [r[f"n_{k}"] for k in O.BASE] == [sum(k == w[0] for w in want) for k in O.BASE]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if s.split(":")[0] in O.BASE] == listed.split(",") * bool(want)


def test_base_spans(spark, make_docs, no_docs):
    df = make_docs([(k, t, "s") for k, t in enumerate(TEXTS)])
    rows = query(spark, df).collect()
    assert len(rows) == len(TEXTS)
    check(rows, dict(enumerate(TEXTS)))
    assert query(spark, no_docs).collect() == []


def test_base_spans_on_the_tables(spark, sf_dir):
    rows = O.op4_pii(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, texts)


def test_odd_rows(spark, odd_docs, odd_rows):
    assert query(spark, odd_docs).count() == len(odd_rows)


def test_method_adds_spans(spark, make_docs):
    """Loose kinds with trigger words are added, look-alikes are not."""
    rows = [(k, f"reach me by mail: bob{k}@example.com or phone: (212) 555-{1000 + k} today", "s") for k in range(60)]
    rows += [(100 + k, f"order 000-12-{1000 + k}/x and version 999-00-{1000 + k}% of it", "s") for k in range(60)]
    got = {r["doc_id"]: r["spans"] for r in query(spark, make_docs(rows)).collect()}
    assert all("phone_national:" in got[k] for k in range(60))
    assert not any("ssn:" in got[100 + k] for k in range(60))


def test_em_recovers_reliabilities():
    import random

    rng = random.Random(5)
    good = dict(zip(O.LABELERS, (0.95, 0.9, 0.85, 0.8, 0.9, 0.7)))
    rows = []
    for _ in range(4000):
        truth = rng.random() < 0.4
        rows.append({n: int(truth if rng.random() < g else not truth) if rng.random() < 0.8 else None for n, g in good.items()} | {"n": 1})
    share, yes = O.reliabilities(rows)
    assert abs(share - 0.4) < 0.06
    assert all(abs(yes[n][0] - g) < 0.08 and abs(yes[n][1] - (1 - g)) < 0.08 for n, g in good.items())


def test_plan_is_native(spark, sf_dir):
    plan = O.op4_pii(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
