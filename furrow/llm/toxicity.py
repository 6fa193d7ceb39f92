"""Toxicity by multiple-instance learning: sentences are scored, a noisy-or joins them, labels are of whole documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import fold, kept, query, table

TRAINING_DOCUMENTS = 10_000  # at most, of either label
LEAST_DOCUMENTS = 5
LEAST_Z = 4.0
MOST_WORDS = 4_096
STEPS, RATE, RIDGE = 400, 0.05, 1e-4
OFFENDING = 0.5

_ENDS = b".!?\n"
_TABLE = bytes(ord("\n") if b in _ENDS else b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() or b in b"'_-" else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Lower-case words of the text's bytes, one sentence per line, every byte in its place."""
    return text.encode().translate(_TABLE)


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def sentences(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The text's score, and (start, end, score) of sentences that hold a weighted word, in code points."""
        data = plain(text)
        calm = -np.logaddexp(0.0, self.bias)  # log probability that a sentence without such words does no harm
        if self.weights.keys().isdisjoint(data.split()):
            return 1 - float(np.exp(calm)), []  # as in training, one sentence
        found, harmless, at, whole = [], 0.0, 0, text.encode()
        for sentence in data.split(b"\n"):
            words = {w for w in sentence.split() if w in self.weights}
            if words:
                z = self.bias + sum(self.weights[w] for w in sorted(words))
                harmless -= np.logaddexp(0.0, z)
                start = len(whole[:at].decode(errors="ignore"))
                found.append((start, start + len(whole[at : at + len(sentence)].decode(errors="ignore")), float(1 / (1 + np.exp(-z)))))
            at += len(sentence) + 1
        return 1 - float(np.exp(harmless)), found


def _noisy_or(docs: pd.DataFrame, n_words: int) -> tuple[np.ndarray, float]:
    """Word weights and bias that maximise the labels' likelihood; ``docs``: y, weight, bags (word numbers by sentence)."""
    y, weight = docs["y"].to_numpy(dtype=float), docs["weight"].to_numpy(dtype=float)
    weight = weight / weight.sum()
    doc_of, sentence_of, word = [], [], []
    for d, bags in enumerate(docs["bags"]):
        for bag in bags if len(bags) else [()]:  # a text without weighted words counts as one such sentence
            sentence_of += [len(doc_of)] * len(bag)
            word += list(bag)
            doc_of.append(d)
    doc_of, sentence_of, word = (np.array(x, dtype=np.int64) for x in (doc_of, sentence_of, word))
    w, b = np.zeros(n_words), -3.0
    m, v = np.zeros(n_words + 1), np.zeros(n_words + 1)
    for step in range(1, STEPS + 1):
        z = b + np.bincount(sentence_of, w[word], len(doc_of))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(doc_of, -np.logaddexp(0.0, z), len(y)))
        some = np.maximum(1 - none, 1e-9)
        g = weight[doc_of] * p * np.where(y[doc_of] > 0, none[doc_of] / some[doc_of], -1.0)
        grad = np.append(np.bincount(word, g[sentence_of], n_words) - RIDGE * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w + move[:-1], b + move[-1]
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = TRAINING_DOCUMENTS) -> Model:
    """Learn from up to ``rows`` labelled documents of either label, picked by a hash of the id.

    Words found in at least five of them and clearly oftener under label 1 are weighted. Repeated labels of an id count
    once, as the highest; null labels not at all. Without labels of both kinds every text scores the share of label 1.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    totals = dict(known.groupBy("y").count().collect())
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows) for y in (0, 1)]
    texts = kept(
        docs.join(picked[0].unionByName(picked[1]), F.col(id_col) == F.col("_id"))
        .select("_id", "y", F.coalesce(F.col(text_col), F.lit("")).alias("text")), "toxic-sample")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for y, text in zip(pdf["y"], pdf["text"], strict=True):
                counts[y].update(set(plain(text).split()))
        for y, c in counts.items():
            yield pd.DataFrame({"word": list(c), "n0": [n * (1 - y) for n in c.values()], "n1": [n * y for n in c.values()]})

    have = dict(texts.groupBy("y").count().collect())
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if not (have.get(0) and have.get(1)):
        return Model({}, bias)
    d0, d1 = have[0] + 1.0, have[1] + 1.0
    p, q = (F.col("n1") + 0.5) / d1, (F.col("n0") + 0.5) / d0
    z = (p - q) / F.sqrt((F.col("n0") + F.col("n1") + 1) / (d0 + d1) * (1 / d0 + 1 / d1))
    chosen = (texts.mapInPandas(words, "word binary, n0 bigint, n1 bigint").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
              .where(F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
              .orderBy(F.desc("z"), "word").limit(MOST_WORDS).collect())
    number = {bytes(r["word"]): i for i, r in enumerate(chosen)}
    if not number:
        return Model({}, bias)
    sent = spark.sparkContext.broadcast(number)

    @F.pandas_udf("array<array<int>>")
    def bags(texts: pd.Series) -> pd.Series:
        def of(text: str) -> list[list[int]]:
            found = [sorted({sent.value[w] for w in s.split() if w in sent.value}) for s in plain(text).split(b"\n")]
            return [b for b in found if b]

        return texts.map(of)

    weight = F.when(F.col("y") == 1, F.lit(totals[1] / have[1])).otherwise(F.lit(totals[0] / have[0]))
    sample = texts.select("_id", "y", weight.alias("weight"), bags("text").alias("bags")).toPandas().sort_values("_id", ignore_index=True)
    w, b = _noisy_or(sample, len(number))
    return Model({word: float(w[i]) for word, i in number.items()}, b)


def toxicity(text: Column, model: Model) -> Column:
    """(score, sentences) of a text: noisy-or of its sentences, and start, end and score of those of 0.5 or more."""

    @F.pandas_udf("struct<score:double,sentences:array<struct<start:bigint,end:bigint,score:double>>>")
    def scored(texts: pd.Series) -> pd.DataFrame:
        out = [model.sentences(t or "") for t in texts]
        found = [[{"start": s, "end": e, "score": p} for s, e, p in spans if p >= OFFENDING] for _, spans in out]
        return pd.DataFrame({"score": [s for s, _ in out], "sentences": found})

    return scored(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id, score, sentences`` of every row of ``docs``, learnt from ``labels``; null texts score as empty ones."""
    model = fit(docs, labels, id_col, text_col, label_col)
    return docs.select(F.col(id_col).alias("doc_id"), toxicity(F.col(text_col), model).alias("_t")).select("doc_id", "_t.*")


@query("op10_noisy_or_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_documents(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences")
