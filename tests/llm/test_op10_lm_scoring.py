import random

import numpy as np

from ordertide.llm import op10_lm_scoring as O


def small_net(seed=1):
    rng = np.random.default_rng(seed)
    return O.Network(*[rng.normal(0, 0.5, p.shape).astype(np.float32) for p in O.Network.start()])


def test_log_likelihood_by_hand():
    """The batched score against one word at a time in plain Python."""
    net = small_net()
    ids = np.random.default_rng(2).integers(1, O.SIZE, 37).astype(np.uint8)
    total = 0.0
    for i in range(len(ids)):
        hidden = net.bias.astype(np.float64).copy()
        for k, w in enumerate(O.WINDOW):
            j = i + w
            hidden += net.tables[k][ids[j] if 0 <= j < len(ids) else 0]
        logits = np.tanh(hidden) @ net.out + net.out_bias
        total += logits[ids[i]] - np.log(np.exp(logits).sum())
    assert abs(O.log_likelihood(net, ids) - total) < 1e-2


def test_gradient(monkeypatch):
    """A step's gradient against finite differences."""
    net = small_net(3)
    rng = np.random.default_rng(4)
    context, target = rng.integers(0, O.SIZE, (8, len(O.WINDOW))), rng.integers(0, O.SIZE, 8)
    seen = O.Network(*[np.zeros_like(p) for p in net])
    copy = O.Network(*[p.copy() for p in net])
    O.step(copy, seen, context, target)

    def loss(n):
        return -float(O.forward(n, context)[1][np.arange(8), target].astype(np.float64).mean())

    for part in range(4):
        flat = np.sqrt(seen[part]).ravel()
        at = int(flat.argmax())
        moved = [p.astype(np.float64) for p in net]
        moved[part].ravel()[at] += 1e-4
        up = loss(O.Network(*moved))
        moved[part].ravel()[at] -= 2e-4
        assert abs(abs(up - loss(O.Network(*moved))) / 2e-4 - flat[at]) < 1e-3


def test_learns_and_repeats(spark, make_docs):
    """Text in the corpus' word order scores higher than the same words shuffled."""
    rng = random.Random(6)
    phrases = [f"the {a} of the {b} is in the {c} and" for a, b, c in zip("cat dog sun moon tree".split(), "house road sky lake hill".split(), "red big old new far".split())]
    texts = [" ".join(rng.choice(phrases) for _ in range(40)) for _ in range(120)]
    mixed = []
    for t in texts[:30]:
        words = t.split()
        rng.shuffle(words)
        mixed.append(" ".join(words))
    rows = [(k, t, "s") for k, t in enumerate(texts + mixed)]
    got = {r["doc_id"]: r for r in O.score_documents(make_docs(rows)).collect()}
    assert all(got[k]["n_words"] == len(t.split()) for k, t, _ in rows)
    assert all(got[k]["mean_log_likelihood"] > got[120 + k]["mean_log_likelihood"] + 0.3 for k in range(30))
    again = {r["doc_id"]: r for r in O.score_documents(make_docs(rows)).collect()}
    assert got == again


def test_vocabulary_is_by_count(spark, make_docs):
    from pyspark.sql import functions as F

    from ordertide.llm.words import word_hashes

    docs = make_docs([(k, "aa " * 9 + "bb " * 5 + f"rare{k} ", "s") for k in range(20)])
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    want = [int(h.view(np.int64)[0]) for h in word_hashes([b"aa", b"bb"])]
    assert list(O.vocabulary(texts, 2)) == want


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = O.score_documents(odd_docs).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(len((t or "").encode().split()) for _, t, _ in odd_rows)
    assert all(r["log_likelihood"] == 0 and r["mean_log_likelihood"] is None for r in rows if not r["n_words"])
    assert all(r["log_likelihood"] < 0 for r in rows if r["n_words"])
    assert O.score_documents(no_docs).collect() == []


def test_query(spark, sf_dir):
    rows = O.op10_lm_scoring(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    total = sum(r["log_likelihood"] for r in rows) / sum(r["n_words"] for r in rows)
    assert total > -np.log(O.SIZE)  # better than guessing


def test_shares_of_a_symbol_sum_to_one(monkeypatch):
    """Over the words of a symbol, between any two symbols, by brute force."""
    rng = np.random.default_rng(7)
    kind = rng.integers(0, 2, 400)
    key = rng.integers(0, 9, 400) * O.RARE + kind
    near = rng.integers(0, 3, 400), rng.integers(0, 3, 400)
    pairs = np.zeros((2, O.SIZE, O.RARE))
    for side in range(2):
        np.add.at(pairs[side], (near[side], kind), 1)
    got = np.exp(O.log_shares(key, near, pairs))
    monkeypatch.setattr(O, "BINS", 0)
    assert np.array_equal(got, np.exp(O.log_shares(key, near, pairs)))
    seen = {}
    for k, left, right, p in zip(key, *near, got):
        n = (key == k).sum() / (key % O.RARE == k % O.RARE).sum()
        want = 0.0
        for side, x in ((0, left), (1, right)):
            want += ((key == k) & (near[side] == x)).sum() / 2 / (pairs[side][x, k % O.RARE] + O.PRIOR)
            want += O.PRIOR * n / 2 / (pairs[side][x, k % O.RARE] + O.PRIOR)
        assert abs(p - want) < 1e-9
        seen[k, left, right] = p
    for c in range(2):
        words = [k for k in np.unique(key) if k % O.RARE == c]
        for left in range(3):
            for right in range(3):
                if all((k, left, right) in seen for k in words):
                    assert abs(sum(seen[k, left, right] for k in words) - 1) < 1e-9


def test_rare_words_are_predicted(spark, make_docs):
    """Thousands of words: swapping rare words for random ones of the same
    symbol keeps the symbols' score and lowers the words'."""
    from ordertide.llm.words import word_hashes

    rng = random.Random(8)
    common = [f"common{k}" for k in range(O.FREQUENT)]
    rare = [f"rare{k}" for k in range(4000)]
    kinds = {}
    for w in rare:
        kinds.setdefault(int(next(word_hashes([w.encode()]))[0] % np.uint64(O.RARE)), []).append(w)
    same = {w: ws for ws in kinds.values() for w in ws}
    after = {w: rng.choice(common) for w in rare}  # every rare word has its place
    texts = []
    for _ in range(300):
        words = []
        for w in rng.choices(rare, k=100):
            words += [after[w], w, after[w]]
        texts.append(" ".join(words + common))
    swapped = [" ".join(rng.choice(same[w]) if w in same else w for w in t.split()) for t in texts[:20]]
    rows = [(k, t, "s") for k, t in enumerate(texts + swapped)]
    got = {r["doc_id"]: r for r in O.score_documents(make_docs(rows).repartition(5)).collect()}
    assert all(got[k]["log_likelihood"] == got[300 + k]["log_likelihood"] for k in range(20))
    assert all(got[k]["mean_word_log_likelihood"] > got[300 + k]["mean_word_log_likelihood"] + 0.2 for k in range(20))
    assert all(r["word_log_likelihood"] < r["log_likelihood"] for r in got.values())


def test_words_held_grow_with_the_corpus(spark, make_docs):
    """Every distinct word that shares a symbol reaches a shard, in any number
    of shards, and rows of equal text get equal scores."""
    rows = [(k, " ".join(f"w{k // 2}x{j}" for j in range(50)), "s") for k in range(200)]
    texts = make_docs(rows).selectExpr("doc_id", "cast(text as binary) text")
    tokens = O.C.cut(O.tokenised(texts, O.vocabulary(texts)).repartition(1).sortWithinPartitions("at"))
    few, many = ({r["at"]: r["words"] for r in O.word_scores(tokens, n).collect()} for n in (1, 64))
    assert few == many and len(few) == 200
    held = {r["doc_id"]: few[r["at"]] for r in tokens.select("doc_id", "at").collect()}
    assert len({round(v, 9) for v in held.values()}) > 50
    pairs = O.symbol_pairs(tokens)
    assert pairs[0].sum() == pairs[1].sum() == 200 * 50 - 2 * O.FREQUENT


def test_every_place_is_trained_on(spark, make_docs, monkeypatch):
    """The default rounds make every word place a target exactly once."""
    texts = make_docs([(k, " ".join(f"w{j}" for j in range(n)), "s") for k, n in enumerate((1, 7, 8, 61))]).selectExpr("doc_id", "cast(text as binary) text")
    tokens = O.C.cut(O.tokenised(texts, O.vocabulary(texts)).repartition(1))
    targets = []
    monkeypatch.setattr(O, "train_round", lambda tokens, net, residue, stride=O.STRIDE: targets.append(np.concatenate([np.arange(residue, len(r["ids"]), stride) for r in tokens.collect()])) or net)
    O.fit(tokens)
    assert sorted(np.concatenate(targets)) == sorted(j for n in (1, 7, 8, 61) for j in range(n))


def test_a_place_is_masked():
    """A place's own word is out of the counts, by brute force; a word that
    occurs once has what is kept for new words."""
    rng = np.random.default_rng(9)
    key = np.append(rng.integers(0, 9, 300) * O.RARE + rng.integers(0, 2, 300), 50 * O.RARE)
    near = rng.integers(0, 3, 301), rng.integers(0, 3, 301)
    pairs = np.zeros((2, O.SIZE, O.RARE))
    for side in range(2):
        np.add.at(pairs[side], (near[side], key % O.RARE), 1)
    got = np.exp(O.log_shares(key, near, pairs, masked=True))
    for i, k in enumerate(key):
        others = np.arange(len(key)) != i
        same = others & (key % O.RARE == k % O.RARE)
        q = ((others & (key == k)).sum() + O.NEW / O.OPEN) / (same.sum() + O.NEW)
        want = sum(((same & (key == k) & (x == x[i])).sum() + O.PRIOR * q) / ((same & (x == x[i])).sum() + O.PRIOR) / 2 for x in near)
        assert abs(got[i] - want) < 1e-9
    assert got[-1] < 1e-5


def test_documents_that_occur_twice_score_apart(spark, make_docs):
    """The copy tells a masked place its word; nothing tells a text of its own."""
    rng = random.Random(10)
    texts = [" ".join(f"only{k}x{j}" if j % 3 else rng.choice("the of and in".split()) for j in range(60)) for k in range(40)]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(100 + k, texts[k], "s") for k in range(10)]
    got = {r["doc_id"]: r["mean_word_log_likelihood"] for r in O.score_documents(make_docs(rows)).collect()}
    assert min(got[k] for k in range(10)) > max(got[k] for k in range(10, 40)) + 1


def test_weights_are_averaged_exactly_in_any_grouping():
    rng = np.random.default_rng(3)
    flats = [rng.integers(-(1 << 30), 1 << 30, 50) for _ in range(40)]
    words = [int(n) for n in rng.integers(1, 1 << 22, 40)]

    def add(batches):
        return next(O.added((O.pa.scalar(0, O.pa.int32()),), iter(batches)))

    whole = add([O.weighed(flats, words)])
    parts = [add([O.weighed(flats[i::7], words[i::7])]).drop_columns(["task"]) for i in range(7)]
    assert add(parts).to_pydict() == whole.to_pydict()
    row = whole.to_pylist()[0]
    want = [sum(int(f[j]) * n for f, n in zip(flats, words)) for j in range(50)]
    high, low = (np.frombuffer(row[c], np.int64) for c in ("high", "low"))
    assert [int(a) * O.LOW + int(b) for a, b in zip(high, low)] == want and row["words"] == sum(words)


def test_lines_hold_every_text(monkeypatch):
    """Joined texts give each place the same context as the text alone."""
    monkeypatch.setattr(O, "LINE", 50)
    rng = np.random.default_rng(6)
    raws = [rng.integers(1, O.SIZE, n).astype(np.uint8).tobytes() for n in (3, 0, 60, 1, 20, 0, 29, 2, 0)]
    seen = {}
    for line, place, row, own in O.lines(raws):
        for c, t, r, p in zip(O.around(line, place), line[place], row, own):
            seen[int(r), int(p)] = (t, tuple(c))
    want = {}
    for r, raw in enumerate(raws):
        ids = np.frombuffer(raw, np.uint8)
        for p, c in enumerate(O.contexts(ids, np.arange(len(ids)))):
            want[r, p] = (ids[p], tuple(c))
    assert seen == want
