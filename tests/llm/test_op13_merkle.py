import zlib
from hashlib import sha256

import pytest

from ordertide.llm import op13_merkle as op


def h(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """Levels from the nodes up to the one that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, at):
    for nodes in levels[:-1]:
        run = at // 8 * 8
        yield "".join(nodes[run:at]), "".join(nodes[at + 1 : run + 8])
        at //= 8


def brute_force(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(r, text):
        return h("".join(field(v) for v in (*r[:4], text)))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    per_lang = {}
    for lang in langs:
        mine = [(r, leaf(r, r[4])) for r in rows if r[2] == lang]
        per_lang[lang] = sorted(mine, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {lang: tree([x[1] for x in per_lang[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    root = top[-1][0] if rows else None
    out = []
    for k, lang in enumerate(langs):
        for at, (r, own) in enumerate(per_lang[lang]):
            path = [*siblings(trees[lang], at), *siblings(top, k)]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf(r, lower(r[4])) if tampered else own
            for left, right in path:
                node = h(left + node + right)
            out.append((r[0], own, trees[lang][-1][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return out


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in op.manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_force(rows)))
    return got


def test_odd_rows(odd_docs):
    assert len(check(odd_docs)) == odd_docs.count()


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_heights(spark, make_docs, n):
    """A lone leaf, a full run, a run of one, three levels; one lang or two."""
    docs = make_docs([(100 + i, f"Text {i}", "s") for i in range(n)])
    check(docs)
    got = check(docs.selectExpr("doc_id", "source", "'de' AS lang", "n_chars", "text"))
    assert any(r[6] for r in got) or n == 1


def test_more_langs_than_a_run(spark, make_docs):
    docs = make_docs([(i, f"Some Text {i}", "s") for i in range(40)]).selectExpr(
        "doc_id", "source", "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE concat('l', doc_id % 13) END AS lang", "n_chars", "text"
    )
    check(docs)


def test_only_tampered_texts_fail(make_docs):
    got = check(make_docs([(i, f"Upper {i}", "s") for i in range(30)]))
    assert {r[0] for r in got if not r[6]} == {i for i in range(30) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_empty_table(no_docs):
    assert op.manifest(no_docs).collect() == []
