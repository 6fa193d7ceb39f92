import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from furrow.llm import packing

TEXTS = ["", None, "plain words, with marks.", "two\nlines here", " leads", "trails ", "a  b", "x\n\ny", "x\n", "it's DON'T 12ab's", "<|endoftext|> in it", "日本 語",
         "a b", "éx ß×÷", "a_b __c ,, .x", "tab\there", "long " * 1500, "mixed Ünïcode wörds. Über-allés! " * 40, "ẞ\U0001f600 🙂"]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(packing.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_path())


def test_ids_are_the_library_s(whole, encoder):
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert [ids.tolist() for ids in encoder(TEXTS)] == want


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab Zé\n.,'s-1×", max_size=30), min_size=1, max_size=5))
def test_ids_of_any_text(texts, whole, encoder):
    assert [ids.tolist() for ids in encoder(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


class Counted:
    """Vocabulary that notes the bytes it is given."""

    def __init__(self, words):
        self.words, self.sizes = words, []

    def encode_to_numpy(self, text, **options):
        self.sizes.append(len(text))
        return self.words.encode_to_numpy(text, **options)


def test_units_met_before_are_not_encoded_again(whole):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta's", "gamma,", "x" * 70, "y" * 65, "été", "12ab"], k=30)) for _ in range(200)]
    texts[3:3] = ["odd \t text", None, "", "a<|endoftext|>b", "ends ", "日本 alpha"]
    encoder = packing.Encoder(packing.tokenizer_path(), 1000)
    encoder.words = Counted(encoder.words)
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder(texts)] == want
    assert sum(encoder.words.sizes) < 2000  # of about 60,000 characters
    before = len(encoder.words.sizes)
    assert [ids.tolist() for ids in encoder(texts)] == want and len(encoder.words.sizes) == before


def test_ids_beyond_what_is_remembered(whole, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_UNITS", 20)
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcé'9", k=rng.randint(1, 30))) for _ in range(5)) for _ in range(60)]
    encoder = packing.Encoder(packing.tokenizer_path(), 100)
    assert [ids.tolist() for ids in encoder(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(encoder.hashes) <= 20


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(0, 50), max_size=60))
def test_best_fit_decreasing_equals_a_search_of_all_bins(lengths):
    lengths = sorted(lengths, reverse=True)
    left, want = [], []
    for n in lengths:
        open_ = [(room, b) for b, room in enumerate(left) if room >= n]
        room = min(open_)[0] if open_ else None
        if room is None:
            left.append(50)
            room = 50
        want.append(room)
        left[left.index(room)] -= n
    got = packing.best_fit_decreasing(lengths, 50)
    assert [50 - o for _, o in got] == want and len({b for b, _ in got}) == len(left)


def test_pieces_and_places(spark, whole):
    rng = random.Random(1)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "two\nlines here", "y"), (None, "no id", "z"), (None, "no id", "z"), (2**62 + 1, "large id", "z")]
    rows += [(100 + i, "word " * rng.randint(1, 900), "") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    out = packing.pack_documents(df).collect()
    want = []
    for i, t, _ in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for k, (s, n) in enumerate(packing.cut(len(ids), 2048)):
            want.append((i, k, s, n, zlib.crc32(np.array(ids[s : s + n], dtype="<u4").tobytes())))
    key = repr
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    assert len(bins) <= -(-sum(r["length"] for r in out) // 2048) + 1


def test_texts_are_tokenised_once(spark, monkeypatch):
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df

    monkeypatch.setattr(packing, "kept", noted)
    packing.pack_documents(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    assert [p.count("ArrowEvalPython") for p in plans] == [1]


def test_cut_leaves_the_rest_to_the_first_piece():
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    assert packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)] and packing.cut(1, 2048) == [(0, 1)]


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
