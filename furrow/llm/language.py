"""Languages of a text as a mixture: expectation-maximisation over character n-grams, and a penalised choice of the set."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import fold, query, release, table

UNKNOWN = "und"
BUCKETS = 1 << 16
SMOOTHING = 0.5
STEPS = 12
PENALTY = 6.0  # log n times this for each further language
CELLS = 1_000_000  # of the likelihood table worked on at once
_POINTS = sys.maxunicode + 1
_SPACE = 32

_LUT: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case letter of each code point, a space for what is no letter; built once per process."""
    if not _LUT:
        lut = np.full(_POINTS, _SPACE, dtype=np.uint32)
        for p in range(_POINTS):
            c = chr(p)
            if c.isalpha():
                lut[p] = ord(c.lower()[0])
        _LUT.append(lut)
    return _LUT[0]


def trigrams(text: str) -> np.ndarray:
    """Buckets of a text's character trigrams; runs of other characters than letters count as one space. Empty without letters."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    letters = _letters()[points] if len(points) else points
    padded = np.concatenate((np.array([_SPACE], np.uint32), letters, np.array([_SPACE], np.uint32)))
    padded = padded[np.append(True, (padded[1:] != _SPACE) | (padded[:-1] != _SPACE))]
    if len(padded) < 3:
        return np.empty(0, dtype=np.int64)
    h = padded[:-2] * np.uint32(0x9E3779B1) + padded[1:-1] * np.uint32(0x85EBCA77) + padded[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.int64)


class Model:
    """Likelihoods of the n-gram buckets under each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.likelihood = (smooth / smooth.sum(axis=1, keepdims=True) * BUCKETS).astype(np.float32).T.copy()  # of 1 on average

    def mixtures(self, texts: list[str]) -> list[tuple[str, float, list[str]]]:
        """(language, its proportion, the chosen set by falling proportion) of each text."""
        out, batch, size, most = [], [], 0, max(1, CELLS // max(1, len(self.languages)))
        for text in texts:
            values, counts = np.unique(trigrams(text), return_counts=True) if text and self.languages else ((), ())
            batch.append((values, counts))
            size += len(values)
            if size >= most:
                out += self._batch(batch)
                batch, size = [], 0
        return out + self._batch(batch)

    def _batch(self, batch: list) -> list[tuple[str, float, list[str]]]:
        out: list = [(UNKNOWN, 0.0, [])] * len(batch)
        rows = [i for i, (v, _) in enumerate(batch) if len(v)]
        if not rows:
            return out
        lengths = np.array([len(batch[i][0]) for i in rows])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        like = self.likelihood[np.concatenate([batch[i][0] for i in rows])]
        count = np.concatenate([batch[i][1] for i in rows]).astype(np.float32)
        total = np.add.reduceat(count.astype(np.float64), starts)
        alone = np.add.reduceat(np.log(like) * count[:, None], starts, axis=0, dtype=np.float64)
        share, whole = self._em(like, count, starts, lengths, total)
        cost = PENALTY * np.log(total + 1)
        order = np.argsort(-share, axis=1, kind="stable")
        for k, i in enumerate(rows):
            top, chosen = int(alone[k].argmax()), None
            if whole[k] - alone[k, top] > cost[k]:  # else no set of more languages can pay
                part = slice(starts[k], starts[k] + lengths[k])
                best = alone[k, top]
                for n in range(2, len(self.languages) + 1):
                    own = order[k, :n]
                    s, ll = self._em(like[part][:, own], count[part], np.array([0]), lengths[k : k + 1], total[k : k + 1])
                    if ll[0] - (n - 1) * cost[k] <= best:
                        break
                    best, chosen = ll[0] - (n - 1) * cost[k], sorted(zip(-s[0], own.tolist(), strict=True))
            names = [top] if chosen is None else [j for _, j in chosen]
            out[i] = self.languages[names[0]], min(1.0, float(share[k, names[0]])), [self.languages[j] for j in names]
        return out

    @staticmethod
    def _em(like: np.ndarray, count: np.ndarray, starts: np.ndarray, lengths: np.ndarray, total: np.ndarray):
        share = np.full((len(starts), like.shape[1]), 1 / like.shape[1])
        for _ in range(STEPS):
            mixed = like * np.repeat(share.astype(np.float32), lengths, axis=0)
            mixed *= (count / mixed.sum(axis=1))[:, None]
            share = np.add.reduceat(mixed, starts, axis=0, dtype=np.float64) / total[:, None]
        mixed = (like * np.repeat(share.astype(np.float32), lengths, axis=0)).sum(axis=1)
        return share, np.add.reduceat(np.log(mixed) * count, starts, dtype=np.float64)


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts every text that has a language; a model has ``BUCKETS`` numbers for each language."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                counts, held, size = own.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64)), [], 0
                for t in texts:
                    held.append(trigrams(t))
                    size += len(held[-1])
                    if size >= CELLS // 4:
                        counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
                        held, size = [], 0
                if held:
                    counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
                del held, texts
            del pdf
            release()
        for lang, counts in own.items():
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": counts[seen]})

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = known.mapInPandas(counted, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    matrix = np.zeros((len(languages), BUCKETS))
    for k, lang in enumerate(languages):
        part = counts[counts["lang"] == lang]
        matrix[k, part["bucket"].to_numpy()] = part["n"].to_numpy()
    return Model(languages, matrix)


def languages(text: Column, model: Model, spark: SparkSession) -> Column:
    """(lang, share, languages) of a text; ``und``, 0 and an empty set for null and for texts without a letter."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang:string,share:double,languages:array<string>>")
    def mixed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(sent.value.mixtures(texts.tolist()), columns=["lang", "share", "languages"])
            del texts
            release()

    return mixed(text)


def identify(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang_pred, score, languages`` of every row of ``docs``; ``lang_col`` is read of ``training`` alone.

    Repeated rows and null ids are answered one by one; nothing learnt (an empty training table) leaves all ``und``.
    """
    model = fit(training, text_col, lang_col)
    return docs.select(F.col(id_col).alias("doc_id"), languages(F.col(text_col), model, docs.sparkSession).alias("_l")).select(
        "doc_id", F.col("_l.lang").alias("lang_pred"), F.col("_l.share").alias("score"), F.col("_l.languages"))


def in_known_language(docs: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang", least: float = 0.3) -> DataFrame:
    """Rows of ``docs``, all columns kept, whose main language is known and holds ``least`` of the text."""
    model = fit(training, text_col, lang_col)
    columns, found = docs.columns, "_found"
    while found in columns:
        found += "_"
    # the columns stand as they are, so that a text is not carried twice
    known = docs.withColumn(found, languages(F.col(text_col), model, docs.sparkSession))
    return known.where((F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.share") >= least)).select(*[F.col(f"`{c}`") for c in columns])


@query("op6_mixture_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = identify(docs, docs.where(~held_out))
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "languages")
