import hashlib
import random

from furrow.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, rank int, h string, size double"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA)


def expected(rows, weights=(5, 2, 1), share=1.5, repeats=2):
    """Words taken of each row, one document after another."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s))
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    budget, full = share * sum(size), set()
    while True:
        left = sum(weight[s] for s in sources if s not in full)
        rest = budget - sum(repeats * total[s] for s in full)
        new = {s for s in sources if s not in full and rest * weight[s] / left > repeats * total[s]}
        if not new:
            break
        full |= new
    target = {s: float(repeats * total[s]) if s in full else rest * weight[s] / left for s in sources}
    queue = []
    for s in sources:
        key = lambda i: (int(hashlib.md5(f"{'' if rows[i][0] is None else rows[i][0]}:mix".encode()).hexdigest()[:15], 16), rows[i][0] or 0, size[i])
        at = 0
        for i in sorted((i for i, r in enumerate(rows) if r[2] == s), key=key):
            at += size[i]
            queue += [((e * total[s] + at) / target[s] if target[s] else float("inf"), sources.index(s), key(i), e, i) for e in range(repeats)]
    taken, run = [0] * len(rows), 0
    for _, _, _, _, i in sorted(queue):
        run += size[i]
        if run <= budget:
            taken[i] += size[i]
    return size, [target[r[2]] for r in rows], taken


def test_mix_equals_brute_force_and_keeps_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", 7)
    rng = random.Random(3)
    names = ["b", "a", None, "é", "hot"]
    rows = [(i, " ".join("w" * rng.randint(1, 40)), rng.choice(names + ["hot"] * 6)) for i in range(180)] + [(900, None, "a"), (901, "", "hot"), (902, " \t", None)]
    size, target, taken = expected(rows)
    got = {r["doc_id"]: r for r in mixing.mix(docs(spark, rows)).collect()}
    for (i, _, _), n, t, k in zip(rows, size, target, taken, strict=True):
        assert (got[i]["size"], got[i]["target"], got[i]["size"] * got[i]["copies"]) == (n, t, k)
    by = {}
    for (_, _, s), t, k in zip(rows, target, taken, strict=True):
        by.setdefault(s, [t, 0])[1] += k
    assert all(abs(t - k) <= 80 for t, k in by.values())
    assert sum(taken) <= 1.5 * sum(size)


def test_rows_of_a_unit_are_taken_one_by_one_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_A_BUCKET", 7)
    rows = [(1, "a b c", "x")] * 30 + [(1, "a b d", "x")] * 9 + [(None, "d e", "x"), (None, "d e", "x"), (2, "f", "y"), (1, "a b c d", "x")] + [(None, "q r", "z")] * 40
    size, target, taken = expected(rows)
    got = mixing.mix(docs(spark, rows)).collect()
    assert sum(r["rows"] for r in got) == len(rows)
    assert sorted((r["doc_id"] or 0, r["size"], r["target"], r["size"] * r["copies"]) for r in got for _ in range(r["rows"])) == sorted(
        (r[0] or 0, n, t, k) for r, n, t, k in zip(rows, size, target, taken, strict=True))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs(spark, rows[::-1]).repartition(3)).collect()), key=repr)
    out = mixing.mixed_documents(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "rank", "h", "size"]
    counts = {}
    for r in out.collect():
        counts[r["doc_id"], r["source"], len(r["text"].split())] = counts.get((r["doc_id"], r["source"], len(r["text"].split())), 0) + 1
    want = {}
    for (i, t, s), k, n in zip(rows, taken, size, strict=True):
        want[i, s, n] = want.get((i, s, n), 0) + k // n
    assert counts == {key: n for key, n in want.items() if n}


def test_targets_hold_with_null_and_repeated_ids(spark):
    text = " ".join("w" * 10)
    rows = [(7, text, "s0")] * 600 + [(i, text, "s1") for i in range(300)] + [(None, text, "s2")] * 300
    got, by = mixing.mix(docs(spark, rows)).collect(), {}
    for r in got:
        by.setdefault((r["source"], r["target"]), []).append(r["rows"] * r["size"] * r["copies"])
    assert all(abs(target - sum(words)) <= 20 for (_, target), words in by.items()) and len(by) == 3


def test_empty_table_and_table_without_words(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
    assert [r["copies"] for r in mixing.mix(docs(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]
    assert mixing.mixed_documents(docs(spark, [])).collect() == []


def test_documents_do_not_travel_to_their_number_of_copies(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 30)), rng.choice(["a", "b", None, "hot"])) for i in range(300)] + [(None, "v w x", "a"), (None, None, "b")]
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        out = mixing.mixed_documents(docs(spark, rows))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan
    size, _, taken = expected(rows)
    counts = {}
    for r in got:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {r[0]: k // n for r, n, k in zip(rows, size, taken, strict=True) if k}
