"""Quality rules: fixed text statistics, and perplexity bands of a modified Kneser-Ney character model per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, query, table, window_hashes

# fixed values
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED_PERCENT = 20

DENSE = 128  # alphabets up to this size get one table of all trigrams per process, larger ones are searched
ORDER = 3
BAND = 5.0  # deviations
SIGMA = 1.4826  # standard deviations of normal data in a median absolute one
LEAST_WIDTH = 0.02  # of half a band, where all good texts are alike
LEAST_TEXTS = 30  # good texts that a length class needs for a band of its own
MOST_SYMBOLS = 0.1  # symbols a word, in texts that the model learns from
_EDGE = 0
_BITS, _END = 21, 0x110000  # of a code point, and the edge of a text in counted trigrams


def _words(text: str) -> list[bytes]:
    return text.encode().split()


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows) of one text."""
    words = _words(text)
    n = len(words)
    if not n:
        return 0, 0, sum(map(text.count, SYMBOLS)), 0, 0
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    repeated = 0
    if n >= REPEAT_WINDOW:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
        if len(number) < n:
            windows = window_hashes(ids + np.uint64(1), REPEAT_WINDOW)
            in_order = np.sort(windows)
            again = in_order[1:][in_order[1:] == in_order[:-1]]
            if len(again):
                starts = np.flatnonzero(np.isin(windows, again))
                edges = np.zeros(n + 1, dtype=np.int64)
                edges[: n - REPEAT_WINDOW + 1][starts] += 1
                np.subtract.at(edges, starts + REPEAT_WINDOW, 1)
                repeated = int((np.cumsum(edges[:n]) > 0).sum())
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def is_reference(text: str, most: float = MOST_SYMBOLS) -> bool:
    """Whether a text has few symbols for its spaces and lines."""
    return sum(map(text.count, SYMBOLS)) <= most * (1 + text.count(" ") + text.count("\n"))


def base_fails(n_words, n_repeat_words):
    """The fixed rules, on numbers or columns."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def is_good(text: str) -> bool:
    """Whether the model learns from a text: few symbols, and it passes the fixed rules."""
    if not is_reference(text):
        return False
    n_words, _, _, _, repeated = statistics(text)
    return not base_fails(n_words, repeated)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)


class Alphabet:
    """Code points to classes 1..n, others to class n + 1; class 0 is the edge of a text."""

    def __init__(self, letters: list[int]):
        self.points = np.array(sorted(letters), dtype=np.uint32)
        self.size = len(self.points) + 2

    def __call__(self, text: str) -> np.ndarray:
        points = _points(text)
        low = self._low[points[points < 1024]] if len(points) and points.max() < 1024 else None
        classes = low if low is not None else self._look_up(points)
        return np.concatenate(([_EDGE], [_EDGE], classes, [_EDGE]))

    def _look_up(self, points: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.points, points)
        known = at < len(self.points)
        known[known] = self.points[at[known]] == points[known]
        return np.where(known, at + 1, self.size - 1).astype(np.int64)

    @property
    def _low(self) -> np.ndarray:
        table = self.__dict__.get("_table")
        if table is None:
            table = self.__dict__["_table"] = self._look_up(np.arange(1024, dtype=np.uint32))
        return table


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; 0.5, 1 and 1.5 of a count where they are undefined."""
    n1, n2, n3, n4 = ((counts == k).sum() for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0.0, 0.05, 0.05, 0.05], [0.0, 0.9, 1.9, 2.9])


def levels(grams: np.ndarray, counts: np.ndarray, size: int) -> tuple:
    """Log probabilities of the trigrams; contexts and their log back-off weights; bigrams and theirs; log back-off
    weights of last characters; log probabilities of characters. Only what was seen has an entry."""
    a, rest = grams // (size * size), grams % (size * size)
    b = rest // size

    def level(context: np.ndarray, count: np.ndarray, lower: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
        count = count.astype(np.float64)
        d = _discounts(count)[np.minimum(count, 3).astype(int)]
        total = np.bincount(context, count, contexts)
        spare = np.bincount(context, d, contexts)
        weight = np.divide(spare, total, out=np.ones(contexts), where=total > 0)
        return (count - d) / total[context] + weight[context] * lower, weight

    # lower orders count distinct left neighbours
    bigram, n_left = np.unique(rest, return_counts=True)
    unigram, n_pairs = np.unique(bigram % size, return_counts=True)
    d1 = _discounts(n_pairs)[np.minimum(n_pairs, 3)]
    p1 = np.full(size, d1.sum() / n_pairs.sum() / size)
    p1[unigram] += (n_pairs - d1) / n_pairs.sum()
    p2, w2 = level(bigram // size, n_left, p1[bigram % size], size)
    contexts, place = np.unique(a * size + b, return_inverse=True)
    p3, w3 = level(place, counts, p2[np.searchsorted(bigram, rest)], len(contexts))
    return np.log(p3), contexts, np.log(w3), bigram, np.log(p2), np.log(w2), np.log(p1)


def dense(contexts, w3, bigram, p2, w2, p1) -> np.ndarray:
    """A (size * size) table of log back-off weights, followed by one of log bigram probabilities."""
    size = len(p1)
    weights, pairs = np.zeros(size * size), (w2[:, None] + p1[None, :]).ravel()
    weights[contexts], pairs[bigram] = w3, p2
    return np.concatenate((weights, pairs))


def kneser_ney(grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted trigram keys, their log probabilities, the dense table of what unseen ones cost).

    An unseen trigram (a, b, c) costs back-off(a, b) + log P(c | b).
    """
    p3, *lower = levels(grams, counts, size)
    return grams, p3, dense(*lower)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


class Model:
    """One language's model: sorted keys of all orders with their logs, searched by bisection or laid out as one table."""

    def __init__(self, letters: list[int], grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.alphabet = Alphabet(letters)
        self.keys = grams[order]
        self.logs, *self.sparse = levels(self.keys, counts[order], self.alphabet.size)

    def grams(self, text: str) -> np.ndarray:
        c, size = self.alphabet(text), self.alphabet.size
        return (c[:-2] * size + c[1:-1]) * size + c[2:]

    @property
    def table(self) -> np.ndarray:
        """Log probabilities of all trigrams of a small alphabet, laid out once per process from the sorted arrays."""
        table = self.__dict__.get("_table")
        if table is None:
            size = self.alphabet.size
            lower = self.lower if "lower" in self.__dict__ else dense(*self.sparse)
            back_off, bigrams = lower[: size * size].reshape(size, size, 1), lower[size * size :].reshape(1, size, size)
            table = (back_off + bigrams).astype(np.float32).ravel()
            table[self.keys] = self.logs
            self.__dict__["_table"] = table
        return table

    def searched(self, grams: np.ndarray) -> np.ndarray:
        """Log probabilities of trigrams by bisection."""
        size = self.alphabet.size
        contexts, w3, bigram, p2, w2, p1 = self.sparse
        pair = grams % (size * size)
        lower = _found(bigram, p2, pair, w2[pair // size] + p1[pair % size])
        return _found(self.keys, self.logs, grams, _found(contexts, w3, grams // size, 0.0) + lower)

    def mean_log(self, text: str) -> float:
        """Mean log probability of a text's characters and its end."""
        grams = self.grams(text)
        logs = self.table[grams] if self.alphabet.size <= DENSE else self.searched(grams)
        return float(logs.mean(dtype=np.float64))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_table"}


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Model]:
    """A model per language (null is a language of its own, ``""``), from its good texts, each counted once.

    All characters keep their identity: trigrams of code points are counted by Spark and become sorted arrays, which the
    driver and every executor hold, 16 bytes a distinct trigram and less for the lower orders.
    """
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                parts = [np.array([_END, _END], dtype=np.int64)]
                for t in filter(is_good, texts):
                    parts += [_points(t).astype(np.int64), parts[0]]
                c = np.concatenate(parts)
                a, b, c = c[:-2], c[1:-1], c[2:]
                inside = (b != _END) | ((a == _END) & (c != _END))  # not what spans two texts
                seen, n = np.unique(((a << 2 * _BITS) | (b << _BITS) | c)[inside], return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": seen, "n": n})

    counted = rows.mapInPandas(grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    models = {}
    for lang, g in counted.groupby("lang"):
        packed = g["gram"].to_numpy()
        points = [(packed >> shift) & ((1 << _BITS) - 1) for shift in (2 * _BITS, _BITS, 0)]
        letters = np.unique(points[2])
        letters = letters[letters != _END]
        size = len(letters) + 2
        a, b, c = (np.where(x == _END, _EDGE, np.searchsorted(letters, x) + 1).astype(np.int64) for x in points)
        models[lang] = Model(letters.tolist(), (a * size + b) * size + c, g["n"].to_numpy())
    return models


def bands(found: list[tuple[str, int, int, float, float]]) -> list[tuple[str, int, float, float]]:
    """(language, length class, middle, deviation) for all classes 0 to 31, from (language, class, texts, middle, deviation).

    A class with fewer than ``LEAST_TEXTS`` good texts takes the nearest one that has them, the shorter of two; deviations
    grow with the root of the ratio where that one's texts are longer. A language with no such class takes its largest.
    """
    out = []
    for lang in {f[0] for f in found}:
        own = [f[1:] for f in found if f[0] == lang]
        able = [f for f in own if f[1] >= LEAST_TEXTS] or [max(own, key=lambda f: (f[1], -f[0]))]
        for k in range(32):
            near, _, middle, deviation = min(able, key=lambda f: (abs(f[0] - k), f[0]))
            out.append((lang, k, middle, deviation * 2 ** (max(0, near - k) / 2)))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", band: float = BAND) -> DataFrame:
    """Statistics and verdict of every row: ``doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, mean_log, low, high, kept``.

    ``mean_log`` is the mean log probability of the text's characters under its language's model. A band is the median,
    plus and minus ``band`` robust standard deviations, of the distinct good texts (those the model learns from) of the
    language and of like length, by powers of two. Documents outside, and all that fail the fixed rules, are not kept.
    Null and empty texts have no words and fail; null languages share one model.
    """
    spark = docs.sparkSession
    models = spark.sparkContext.broadcast(fit(docs, text_col, lang_col))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = ", ".join(f"{n}: bigint" for n in names)

    @F.pandas_udf(f"struct<{schema}, mean_log: double, n_points: bigint, reference: boolean>")
    def measured(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        out = []
        for text, lang in zip(texts, langs, strict=True):
            model = models.value.get(lang)
            out.append((*statistics(text), model.mean_log(text) if text and model else 0.0, len(text), is_reference(text)))
        return pd.DataFrame(out, columns=[*names, "mean_log", "n_points", "reference"])

    text, lang = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(lang_col), F.lit(""))
    m = F.col("_m")
    failed = base_fails(m["n_words"], m["n_repeat_words"])
    rows = kept(docs.select(F.col(id_col).alias("doc_id"), lang.alias("_lang"), F.xxhash64(text).alias("_text"), measured(text, lang).alias("_m"))
                .select("doc_id", "_lang", "_text", "_m.*", failed.alias("base_failed"))
                .withColumn("_class", F.floor(F.log2(F.greatest("n_points", F.lit(1)))).cast("int")), "rules")
    good = rows.where(~F.col("base_failed") & F.col("reference")).groupBy("_lang", "_class", "_text").agg(F.min("mean_log").alias("mean_log"))
    middle = good.groupBy("_lang", "_class").agg(F.percentile_approx("mean_log", 0.5, 10_000).alias("_mid"))
    spread = good.join(middle, ["_lang", "_class"]).groupBy("_lang", "_class", "_mid").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(F.abs(F.col("mean_log") - F.col("_mid")), 0.5, 10_000).alias("_mad"))
    found = [(r["_lang"], r["_class"], r["n"], r["_mid"], SIGMA * r["_mad"]) for r in spread.collect()]  # a row a language and class
    banded = spark.createDataFrame(bands(found), "_lang string, _class int, _mid double, _deviation double")
    width = F.greatest(band * F.col("_deviation"), F.lit(LEAST_WIDTH))
    inside = F.abs(F.col("mean_log") - F.col("_mid")) <= width
    return (rows.join(banded, ["_lang", "_class"], "left")
            .select("doc_id", F.nullif("_lang", F.lit("")).alias("lang"), *names, "base_failed", "mean_log",
                    (F.col("_mid") - width).alias("low"), (F.col("_mid") + width).alias("high"),
                    (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept")))


@query("op9_perplexity_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "lang", "mean_log", "low", "high")
