import random

from furrow.llm import language

WORDS = {"aa": ["kolo", "mika", "tanu", "lopi", "keto"], "bb": ["schrift", "zwerg", "pflug", "strumpf", "knopf"], "cc": ["èlevé", "prêtre", "façon", "où", "garçon"]}


def text(rng, lang, n):
    return " ".join(rng.choices(WORDS[lang], k=n))


def test_held_out_texts_and_mixtures(spark):
    rng = random.Random(7)
    rows = [(i, text(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(list(WORDS) * 40)]
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !! 34", "bb"), (None, text(rng, "bb", 9), None), (1003, text(rng, "aa", 150) + " " + text(rng, "bb", 60), "cc"),
           (1004, text(rng, "cc", 30_000), None), (5, "KOLO Mika", "bb"), (5, "KOLO Mika", "bb")]
    df = spark.createDataFrame([(*r, 0.5, "s") for r in rows + odd], "doc_id bigint, text string, lang string, score double, languages string")
    got = {}
    for r in language.identify(df, df.where("doc_id < 80")).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all(got[i][0]["lang_pred"] == lang for i, _, lang in rows if i != 5)
    assert [got[i][0]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000][0]["score"] == 0 and got[1001][0]["languages"] == []
    assert got[None][0]["lang_pred"] == "bb" and got[1004][0]["lang_pred"] == "cc" and got[1003][0]["languages"] == ["aa", "bb"]
    assert 0.6 < got[1003][0]["score"] < 0.8 and all(0 <= r["score"] <= 1 for rs in got.values() for r in rs)
    assert sorted(r["lang_pred"] for r in got[5]) == sorted(["aa", "aa", rows[5][2]])
    kept = language.in_known_language(df, df.where("doc_id < 80"))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, *_ in rows + odd} - {1000, 1001, 1002}


def test_nothing_learnt_and_no_rows(spark):
    df = spark.createDataFrame([(1, "kolo", None)], "doc_id bigint, text string, lang string")
    assert [r["lang_pred"] for r in language.identify(df, df).collect()] == ["und"]
    assert language.identify(df.where("false"), df).collect() == []


def test_letters_of_all_planes(spark):
    far = "".join(chr(0x30000 + i % 50) for i in range(200))
    df = spark.createDataFrame([(1, far, "zz"), (2, "kolo mika tanu " * 9, "aa"), (3, far[20:90], None)], "doc_id bigint, text string, lang string")
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(df, df).collect()} == {1: "zz", 2: "aa", 3: "zz"}
