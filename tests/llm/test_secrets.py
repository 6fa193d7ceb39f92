import hashlib
import random

from furrow.llm import secrets

SECRET = "ghp" + hashlib.sha256(b"7").hexdigest()[:9].upper() + "xK9fQ2vLw7RtZ3bNpYc8"


def corpus():
    rng = random.Random(5)
    words = ["thereafter", "internationalisation", "snake_case_identifier", "readFileSync", "donaudampfschifffahrt", "counterrevolutionaries", "the", "of", "and", "number"]
    rows = [(i, " ".join(rng.choices(words, k=80))) for i in range(60)]
    rows += [(100 + i, f'x token = "{hashlib.sha1(str(i).encode()).hexdigest()}" y') for i in range(20)]
    return rows


def test_fixed_patterns():
    key = "AKIA" + "B2" * 8
    text = f'é pAssWord: "abcdef" token=abc api_key = \'A/b+c=d-e_f.g\' {key} AKIASHORT {"0a" * 12} {"f" * 23} apiKey:xyz123'
    spans = secrets.base_spans(text)
    found = [(secrets.KINDS[k], text[s:e], text[v:e]) for s, k, e, v in spans]
    assert found == [
        ("assign", 'pAssWord: "abcdef', "abcdef"), ("assign", "api_key = 'A/b+c=d-e_f.g", "A/b+c=d-e_f.g"), ("access", key, key),
        ("hex", "0a" * 12, "0a" * 12), ("assign", "apiKey:xyz123", "xyz123")]
    # a match that fails takes its text with it; other alphabets' letters are no letters of the names
    assert secrets.base_spans("secret:token=a secret:ab") == [(0, 0, 14, 7)] and secrets.base_spans("ſecret: abcdefgh") == []


def test_random_strings_are_found_and_words_are_not(spark):
    rows = corpus() + [(500, f"é key {SECRET} end"), (501, None), (502, ""), (None, "plain"), (503, "z" * 200_000), (500, f"é key {SECRET} end")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id bigint, text string, spans string")
    got = {}
    for r in secrets.find_secrets(df).collect():
        got.setdefault(r["doc_id"], []).append([tuple(s) for s in r["spans"]])
    at = len("é key ")
    assert got[500] == [[(at, 3, at + len(SECRET), at)]] * 2
    assert all(got[i] == [[]] for i in [*range(60), 501, 502, 503, None])
    assert all([s[1] for s in got[100 + i][0]] == [0, 2] for i in range(20))
    out = {r["doc_id"]: r for r in secrets.masked_documents(df.withColumnRenamed("spans", "n_chars"), chars_col=None).collect()}
    assert out[500]["text"] == "é key [SECRET] end" and out[103]["text"] == 'x token = "[SECRET]" y' and out[501]["text"] is None
    assert secrets.find_secrets(df.where("false")).collect() == []


def test_models_judge_letters_short_strings_and_what_encloses_a_fixed_span(spark):
    rng = random.Random(11)
    letters = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", k=40))
    short, around = "7GqX2vKz9RwB4t", "Zq7" + hashlib.md5(b"x").hexdigest() + "XkT9vLqP"
    capital = [w.capitalize() for w in ("berlin", "september", "wednesday", "nasa", "quixote", "xavier", "zanzibar", "kyoto", "victoria", "greenwich")]
    rows = [(200 + i, " ".join(rng.choices([*capital, *(w.upper() for w in capital)], k=40) + [str(rng.randint(1900, 2030)) for _ in range(30)])) for i in range(90)]
    rows += corpus() + [(500, f"key {letters} end"), (501, f"key {short} end"), (502, f"key {around} end"), (503, "internationalisation counterrevolutionaries")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: [(secrets.KINDS[k], r["spans"][i]["end"]) for i, (_, k, _, _) in enumerate(r["spans"])] for r in secrets.find_secrets(df).collect()}
    assert got[500] == [("random", 44)] and got[501] == [("random", 18)] and got[503] == []
    assert got[502][0] == ("random", 4 + len(around)) and len(got[502]) == 2 and got[502][1][0] == "hex"
    out = {r["doc_id"]: r["text"] for r in secrets.masked_documents(df, chars_col=None).collect()}
    assert out[502] == "key [SECRET] end" and out[500] == "key [SECRET] end" and all(out[i] == dict(rows)[i] for i in range(60))
