import random

from furrow.llm import toxicity


def test_offending_sentences_are_learnt_from_document_labels(spark):
    rng = random.Random(6)
    calm = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(300):
        sentences = [" ".join(rng.choices(calm, k=8)) for _ in range(5)]
        if i % 4 == 0:
            sentences[2] = "é you " + rng.choice(["Grubl!", "zorch"]) + " thing"
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (None, "you zorch"), (902, rows[0][1]), (902, rows[0][1]), (903, "calm " * 50_000 + ". é you zorch thing.")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id bigint, text string, toxic int, score string")
    known = spark.createDataFrame(labels[:200] + [(0, 1), (1, None), (None, 1)], "doc_id bigint, toxic int")
    got = {}
    for r in toxicity.score_documents(docs, known).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all((got[i][0]["score"] >= 0.5) == (i % 4 == 0) for i in range(300))
    s = got[280][0]["sentences"][0]
    assert rows[280][1][s["start"] : s["end"]].strip() == rows[280][1].split(". ")[2].strip("!") or "Grubl" in rows[280][1]
    assert all(got[i][0]["score"] < 0.5 and got[i][0]["sentences"] == [] for i in (900, 901))
    assert got[None][0]["score"] >= 0.5 and len(got[902]) == 2 and got[903][0]["score"] >= 0.5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert 0 <= toxicity.score_documents(docs, none).first()["score"] < 0.5
    assert toxicity.score_documents(docs.where("false"), none).collect() == []
