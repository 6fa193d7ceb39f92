import random
from collections import Counter

import numpy as np
import pytest

from furrow.llm import jaccard


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, len(s), least.get(top(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([3, 8, 30, 60, 200]))
        rows.append((i, " ".join(words) + (" " + passage if i % 3 == 0 else "")))
    hub = rng.choices(vocabulary, k=80)
    for i in range(70):  # near copies of one text, not all of them near each other
        copy = list(hub)
        for at in rng.sample(range(80), rng.randint(0, 4)):
            copy[at] = f"x{i}_{at}"
        rows.append((1000 + i, " ".join(copy).upper() if i % 2 else "\n".join(copy)))
    chain = rng.choices(vocabulary, k=60)
    for i in range(15):
        rows.append((2000 - i, " ".join(chain[i * 3 :] + [f"y{k}" for k in range(i * 3)])))
    return rows + [(3000, None), (3001, ""), (3002, " \t"), (3003, "one two"), (3004, "ONE two"), (3004, "ONE two"), (3005, "one two three"), (None, rows[5][1]), (None, "q " * 9)]


@pytest.mark.parametrize("small,tile", [(64, 1024), (8, 16)])
def test_components_equal_brute_force(spark, monkeypatch, small, tile):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = corpus(small)
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], "doc_id bigint, text string, node int, n double")
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df).collect()), key=repr)
    assert got == sorted(expected(rows), key=repr)


def test_one_of_each(spark):
    rows = corpus(1)
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id bigint, text string, component_id string")
    out = jaccard.one_of_each(df)
    assert out.columns == ["doc_id", "text", "component_id"]
    want = {c for _, _, c in expected(rows) if c is not None}
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted(want)
    assert jaccard.one_of_each(df.where("false")).collect() == []


def test_one_of_each_tells_rows_of_an_id_apart(spark):
    a, b = "one two three four five six seven eight", "a quite different text of some eight words"
    rows = [(3, a), (7, a + " nine"), (7, b), (None, b + " more"), (None, "a third text that stands for itself alone"), (9, None), (9, None), (9, "")]
    out = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = [(3, a), (7, b), (None, "a third text that stands for itself alone"), (9, None), (9, "")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_one_of_each_sends_documents_once(spark):
    rows = [(i, f"t{i % 7} " * 6) for i in range(40)] + [(None, "a b c"), (None, "a b c"), (None, None), (None, None)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert sorted(map(tuple, out.collect()), key=repr) == sorted({*rows[:7], *rows[40:]}, key=repr)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.partition("== Initial Plan ==")[0]
    dealt = [line for line in final.splitlines() if "Exchange hashpartitioning(" in line and ("_text#" in line or "_hash#" in line)]
    assert len(dealt) == 2, dealt  # the documents and those that stay


def test_tree_keeps_every_pair_that_could_link():
    rng = np.random.default_rng(4)
    base = rng.poisson(3, (40, 32))
    points = np.maximum(np.repeat(base, 6, axis=0) + rng.integers(-1, 2, (240, 32)), 0)
    sizes = points.sum(axis=1)
    got = set(zip(*(x.tolist() for x in jaccard.CountTree(points).candidates(points)), strict=True))
    want = {(i, j) for i in range(240) for j in range(240) if 175 * np.minimum(points[i], points[j]).sum() >= 75 * (sizes[i] + sizes[j])}
    assert want <= got and len(got) < 240 * 240 / 2


def test_shared_shingles():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 300, n)).astype(np.uint64) for n in (0, 5, 80, 200, 200)]
    assert jaccard.shared_shingles(sets, sets[::-1], step=64).tolist() == [[len(np.intersect1d(a, b)) for b in sets[::-1]] for a in sets]


def test_sample_grows_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_DOCUMENTS", 4)
    passage = " ".join(f"p{k}" for k in range(12))
    texts = [f"{' '.join(f'w{i}x{k}' for k in range(20))}{' ' + passage if i % 2 else ''}" for i in range(800)]
    known, often = jaccard._common_shingles(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "doc_id", "text")
    assert set(jaccard.shingle_sets([passage])[0].tolist()) <= set(known.tolist()) and len(known) == len(often) < 20


@pytest.mark.parametrize("others", [1, 40])
def test_large_blocks_send_rows_where_they_may_link(spark, monkeypatch, others):
    monkeypatch.setattr(jaccard, "TILE", 64)
    rng = random.Random(others)
    rows = [(7, k, -1 if k >= others else k, rng.randint(20, 400)) for k in range(600)]  # the commonest component and single nodes
    got = jaccard._meetings(spark.createDataFrame(rows, "sig bigint, node bigint, label bigint, n bigint"), 75).collect()
    units = {}
    for r in got:
        units.setdefault((r["sig"], r["i"], r["j"]), []).append((r["node"], r["label"], r["tile"] == r["i"], r["tile"] == r["j"]))
    met = [(min(x, y), max(x, y)) for u in units.values() for x, a, i, _ in u for y, b, _, j in u if i and j and a != b and x != y]
    size = {node: n for _, node, _, n in rows}
    want = {(x, y) for x in range(others) for y in range(x + 1, 600) if 100 * size[x] >= 75 * size[y] and 100 * size[y] >= 75 * size[x]}
    assert want <= set(met)
    assert max(Counter((r["node"], r["i"], r["j"]) for r in got).values()) == 1
    if others == 1:
        assert len(got) <= 1 + sum(1 for _, node, _, n in rows if node and 100 * n >= 75 * size[0] and 100 * size[0] >= 75 * n) + len(units)
    assert len(got) < 4 * len(rows)


def test_small_blocks_send_rows_of_like_size(spark):
    rows = [(1, 1, 1, 10), (1, 2, 2, 30), (1, 3, 3, 40), (1, 4, 4, 100), (2, 1, 1, 80), (2, 2, 1, 90), (2, 3, 3, 200), (3, 5, 5, 300), (3, 6, 6, 350), (3, 7, 5, 420)]
    got = jaccard._of_like_size(spark.createDataFrame(rows, "sig bigint, node bigint, label bigint, n bigint"), 75).collect()
    assert sorted((r["sig"], r["node"]) for r in got) == [(1, 2), (1, 3), (3, 5), (3, 6), (3, 7)]


def test_files_of_earlier_steps_go(spark, monkeypatch, tmp_path):
    from furrow import session

    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = jaccard.near_duplicates(df)
    left = {p.name.rpartition("-")[0] for p in tmp_path.iterdir()}
    assert {"rows", "components"} <= left and not left & {"profiles", "nodes", "blocks", "sized", "candidates", "concerned", "shingles", "labelled", "open-blocks", "least"}
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected(rows), key=repr)
