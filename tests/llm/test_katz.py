import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from furrow.llm import katz

DOCS = [
    (1, "the cat sat on the mat", True), (2, "The cat ran", True), (3, "a dog sat on the mat", True), (4, None, True), (5, "", False),
    (6, "the zebra sat on the mat", False), (7, "the cat sat on the mat", True), (7, "the cat sat on the mat", True), (8, "dog\tdog\n\nDOG dog", True),
    (9, "  ", False), (10, "the dog ran on a cat", False), (11, "b c d e f g h i j k", True), (12, "k j i b", True), (None, "the cat", False), (2**62 + 1, "the cat", False),
    (13, "ça va ÇA", True), (14, "mat mat mat mat mat mat mat mat", True), (15, "q", True),
]


def model(docs):
    """P(word | history) straight from counts."""
    texts = [(t or "").encode().lower().split() + ["<end>"] for _, t, train in docs if train]
    uni, pairs, hist = Counter(), Counter(), Counter()
    for t in texts:
        for h, w in zip(["<start>", *t], t, strict=False):
            uni[w] += 1
            pairs[h, w] += 1
            hist[h] += 1
    d1 = katz.Discounts.of(Counter(uni.values())).factors
    d2 = katz.Discounts.of(Counter(pairs.values())).factors
    n = sum(uni.values())

    def d(f, c):
        return f[min(c, 6)] * c

    kept = sum(d(d1, c) for c in uni.values())
    total = n + (kept >= n)
    p1 = defaultdict(lambda: 1 - kept / total, {w: d(d1, c) / total for w, c in uni.items()})
    after = defaultdict(list)
    for h, w in pairs:
        after[h].append(w)

    def p(w, h):
        if h not in after:
            return p1[w]
        mass = sum(d(d2, pairs[h, x]) for x in after[h])
        whole = hist[h] + (mass >= hist[h])
        if (h, w) in pairs:
            return d(d2, pairs[h, w]) / whole
        return (1 - mass / whole) / (1 - sum(p1[x] for x in after[h])) * p1[w]

    return p, uni, n, after


def expected(docs):
    p, uni, n, _ = model(docs)
    out = []
    for i, t, _ in docs:
        words = (t or "").encode().lower().split() + ["<end>"]
        score = sum(math.log10(p(w, h)) for h, w in zip(["<start>", *words], words, strict=False))
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (len(uni) + 1))) for w in words)
        out.append((i, len(words), sum(w in uni for w in words), n, base, score))
    return out


@pytest.mark.parametrize("block", [24_000_000, 30])
def test_scores_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(katz, "BLOCK_CHARACTERS", block)
    docs = spark.createDataFrame([(*d, 1.5, "x") for d in DOCS], "doc_id bigint, text string, train boolean, score double, shard string").repartition(3)
    got = katz.score_texts(docs, F.col("train")).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    got, want = sorted((tuple(r) for r in got), key=key), sorted(expected(DOCS), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[4:] == pytest.approx(w[4:], rel=1e-9)


def test_every_history_sums_to_one():
    p, uni, _, after = model(DOCS)
    for h in [*after, "<unknown>"]:
        assert sum(p(w, h) for w in [*uni, "<new>"]) == pytest.approx(1.0)


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b", False), (2, None, False)], "doc_id bigint, text string, train boolean")
    rows = {r["doc_id"]: r for r in katz.score_texts(docs, F.col("train")).collect()}
    assert (rows[1]["n_tokens"], rows[1]["n_known"], rows[1]["train_tokens"], rows[1]["score"], rows[2]["n_tokens"]) == (3, 0, 0, 0.0, 1)
    assert katz.score_texts(docs.where("false"), F.col("train")).collect() == []
