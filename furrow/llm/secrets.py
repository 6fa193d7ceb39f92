"""Secrets in texts: fixed patterns, and strings that a random-string Markov model explains better than an ordinary one."""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import query, release, table

# fixed patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS = 6, 20

TRAINING_DOCUMENTS = 20_000
DIGESTS = 8  # random strings for each of them
LEAST_CANDIDATE = 12  # shorter ones are no longer than a mistyped word
LEAST_UNTAUGHT = 16
MARGIN = 12.0
MASK = "[SECRET]"

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_CANDIDATE},}}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
_DIGIT = re.compile("[0-9]")
_CODE = np.full(128, 0, dtype=np.int64)
for _i, _c in enumerate(_SYMBOLS):
    _CODE[ord(_c)] = _i + 1
_SIZE = len(_SYMBOLS) + 1  # 0 stands for the edge of a string


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the fixed patterns, by start and then kind."""
    spans = []
    lowered = text.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    spans.sort()
    return spans


def _may_be_random(string: str) -> bool:
    """Long strings with a digit are no samples of ordinary ones: they may be secrets that no fixed pattern names."""
    return len(string) >= LEAST_UNTAUGHT and _DIGIT.search(string) is not None


def _transitions(strings: list[str]) -> np.ndarray:
    counts = np.zeros(_SIZE * _SIZE, dtype=np.int64)
    if strings:
        codes = _CODE[np.frombuffer(("\x01" + "\x01".join(strings) + "\x01").encode("ascii"), dtype=np.uint8)]
        counts += np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE)
    return counts


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAINING_DOCUMENTS) -> np.ndarray:
    """Log-likelihood ratios (random over ordinary) of each pair of neighbouring characters.

    Learnt from about ``rows`` documents picked by a hash of the id. Random: values that the fixed patterns find in them,
    and base64 digests of their ids. Ordinary: their other words of four characters and more, but for those that are
    long and hold a digit. Both with add-one smoothing.
    An empty table leaves the digest-free uniform models, whose ratios are 0.
    """
    every = max(1, math.ceil(docs.count() / rows))
    sample = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(every)) == 0).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        random, ordinary = np.zeros(_SIZE * _SIZE, dtype=np.int64), np.zeros(_SIZE * _SIZE, dtype=np.int64)
        for pdf in batches:
            found, words = [], []
            for doc_id, text in zip(pdf["id"], pdf["text"], strict=True):
                found += [base64.b64encode(hashlib.sha256(f"{doc_id}/{k}".encode()).digest()).decode().rstrip("=") for k in range(DIGESTS)]
                spans = base_spans(text)
                found += [text[v:end].replace(".", "") for _, _, end, v in spans]
                for _, _, end, v in reversed(spans):
                    text = text[:v] + " " * (end - v) + text[end:]
                words += [w for w in _WORD.findall(text) if not _may_be_random(w)]
            random += _transitions(found)
            ordinary += _transitions(words)
            del pdf, found, words
            release()
        pair = np.flatnonzero(random + ordinary)
        yield pd.DataFrame({"pair": pair, "random": random[pair], "ordinary": ordinary[pair]})

    counted = sample.mapInPandas(count, "pair bigint, random bigint, ordinary bigint").groupBy("pair").sum("random", "ordinary")
    both = np.ones((2, _SIZE * _SIZE))
    for pair, random, ordinary in counted.collect():  # at most 68 * 68 pairs
        both[:, pair] += random, ordinary
    both = both.reshape(2, _SIZE, _SIZE)
    logs = np.log(both / both.sum(axis=2, keepdims=True))
    return logs[0] - logs[1]


def likelihood_ratio(ratios: np.ndarray, string: str) -> float:
    codes = _CODE[np.frombuffer(string.encode("ascii"), dtype=np.uint8)]
    return float(ratios[codes[:-1], codes[1:]].sum())


def all_spans(text: str, ratios: np.ndarray, margin: float = MARGIN) -> list[tuple[int, int, int, int]]:
    """The fixed patterns' spans, and strings whose ratio is over ``margin``.

    The models judge every string of ``LEAST_CANDIDATE`` characters and more, whatever it is made of. A string that reaches beyond a fixed span
    inside it is a span besides; one inside a fixed span, or next to an assignment's, is that span's already.
    """
    spans = base_spans(text)
    more = []
    for m in _CANDIDATE.finditer(text):
        s, e = m.span()
        met = [(a, k, b) for a, k, b, _ in spans if a < e and s < b]
        if any(k == 0 or (a <= s and e <= b) for a, k, b in met):
            continue
        if likelihood_ratio(ratios, m.group()) > margin:
            more.append((s, 3, e, s))
    return sorted(spans + more)


SPANS = "array<struct<start:bigint,kind:int,end:bigint,value_start:bigint>>"


def secret_spans(text: Column, ratios: np.ndarray, margin: float = MARGIN) -> Column:
    """Array of (start, kind, end, value_start) in code points, end exclusive; null and empty texts have none."""

    @F.pandas_udf(SPANS)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("start", "kind", "end", "value_start")
        for texts in batches:
            yield pd.Series([[dict(zip(names, s, strict=True)) for s in all_spans(t, ratios, margin)] if t else [] for t in texts], dtype=object)
            del texts
            release()

    return spans(text)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``doc_id, spans``: one row per input row, repeated and null ids included, after training on the same table."""
    ratios = train(docs, id_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), secret_spans(F.col(text_col), ratios, margin).alias("spans"))


def masked_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                     margin: float = MARGIN) -> DataFrame:
    """All rows and columns of ``docs``; in texts, secret values give way to a mark, and ``chars_col`` follows."""
    ratios = train(docs, id_col, text_col)

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                spans, parts, at = (all_spans(text, ratios, margin) if text else []), [], 0
                for _, _, end, value in sorted(spans, key=lambda s: (s[3], s[2])):
                    if value >= at:
                        parts += [text[at:value], MASK]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]) if spans else text)
            yield pd.Series(out, dtype=object)
            del texts, out
            release()

    whole = docs.withColumn(text_col, masked(F.col(text_col)))
    return whole.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType)) if chars_col in docs.columns else whole


def digest(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op7_markov_secrets")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))
