import random
from collections import Counter

import corpus_pipeline
from furrow.llm import packing
from furrow.llm.common import release
from tests.llm.test_jaccard import expected as components
from tests.llm.test_mixing import expected as mixture

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string"


def test_stages_on_each_other_s_rows(spark):
    rng = random.Random(9)
    words = {"aa": ["kolo", "mika", "tanu", "lopi", "keto", "rami"], "bb": ["schrift", "zwerg", "pflug", "strumpf", "knopf", "krug"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=rng.randint(12, 40))), lang) for i, lang in enumerate(["aa", "bb"] * 25)]
    rows += [(60, rows[3][1], "bb"), (61, rows[4][1].upper() + " end", "aa"), (62, None, "aa"), (63, "", None), (64, "12 !!", "bb"), (65, rows[5][1] + ' token = "0a1b2c3d4e5f"', None)]
    df = spark.createDataFrame([(i, t, g, f"s{i % 3}" if i % 10 else None, len(t or ""), "x") for i, t, g in rows], SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["known_language", "near_duplicates", "secrets", "mix_sources", "pack_sequences"]

    known = stages["known_language"](spark, df, "").collect()
    assert sorted(r["doc_id"] for r in known) == [i for i, t, _ in rows if i not in (62, 63, 64)]
    df = spark.createDataFrame(known, SCHEMA)
    first = stages["near_duplicates"](spark, df, "").collect()
    assert sorted(r["doc_id"] for r in first) == sorted({c for _, _, c in components([(r["doc_id"], r["text"]) for r in known])})
    df = spark.createDataFrame(first, SCHEMA)
    clean = stages["secrets"](spark, df, "").collect()
    text = {r["doc_id"]: r["text"] for r in first}
    assert {r["doc_id"]: r["text"] for r in clean} == {i: t.replace("0a1b2c3d4e5f", "[SECRET]") for i, t in text.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in clean)
    df = spark.createDataFrame(clean, SCHEMA)
    mixed = stages["mix_sources"](spark, df, "").collect()
    size, _, taken = mixture([(r["doc_id"], r["text"], r["source"]) for r in clean])
    assert Counter(r["doc_id"] for r in mixed) == Counter({r["doc_id"]: k // n for r, n, k in zip(clean, size, taken, strict=True) if k})
    df = spark.createDataFrame(mixed, SCHEMA)
    packed = stages["pack_sequences"](spark, df, "").collect()
    assert Counter(r["doc_id"] for r in packed) == Counter(r["doc_id"] for r in mixed)
    lengths = {}
    for r in packed:
        lengths[r["sequence_id"]] = lengths.get(r["sequence_id"], 0) + r["length"]
    assert max(lengths.values()) <= packing.CAPACITY


def test_stages_send_few_rows_a_batch(spark):
    df = spark.createDataFrame([(1, "a b c", "aa", "s", 5, "x")], SCHEMA)
    before = spark.conf.get(corpus_pipeline.BATCH_ROWS)
    try:
        for given, want in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            spark.conf.set(corpus_pipeline.BATCH_ROWS, given)
            dict(corpus_pipeline.STAGES)["secrets"](spark, df, "")
            assert spark.conf.get(corpus_pipeline.BATCH_ROWS) == want
    finally:
        spark.conf.set(corpus_pipeline.BATCH_ROWS, before)


def test_release_returns_memory_between_what_is_held():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    texts = [bytes([65 + i % 26]) * 20_000 for i in range(10_000)]
    texts[:] = texts[::500]
    before = resident()
    release()
    assert before - resident() > 100_000_000
    assert len(texts) == 20
