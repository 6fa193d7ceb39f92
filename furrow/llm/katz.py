"""A Katz back-off language model: Good-Turing discounted bigram counts with exactly normalised back-off weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import fold, kept, partitions, query, table, window_hashes, word_hashes
from furrow.session import scratch_path

BLOCK_CHARACTERS = 12_000_000
KEYS_A_SHARD = 1_500_000
DISCOUNTED = 5  # counts up to this one are discounted
END, START = np.uint64(0xE7D0C0DE5EED0001), np.uint64(0x57A27C0DE5EED002)
_OWNED, _SHARED = np.uint64(1 << 63), np.uint64(1 << 62)
_COUNT = _SHARED - np.uint64(1)


def squeezed(values: np.ndarray) -> bytes:
    """Little-endian numbers by byte planes, compressed."""
    little = np.ascontiguousarray(values.astype(values.dtype.newbyteorder("<")))
    return zstandard.ZstdCompressor(level=1).compress(little.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def unsqueezed(blob: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(np.dtype(dtype).newbyteorder("<")).ravel().astype(dtype)


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their steps."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unsqueezed_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueezed(blob, "u8"), dtype=np.uint64)


@dataclass
class Discounts:
    """Good-Turing factors of counts 1 to ``DISCOUNTED``; larger counts keep theirs.

    Katz's factors where the counts of counts allow them (each in (0, 1)), for as many counts as possible; failing that,
    half a count is taken from each.
    """

    factors: np.ndarray

    @classmethod
    def of(cls, count_of: dict[int, int]) -> Discounts:
        for top in range(DISCOUNTED, 0, -1):
            n = [count_of.get(r, 0) for r in range(top + 2)]
            if not all(n[1:]):
                continue
            tail = (top + 1) * n[top + 1] / n[1]
            d = [1.0] + [((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if tail < 1 else -1.0 for r in range(1, top + 1)]
            if all(0 < x < 1 for x in d[1:]):
                return cls(np.array(d + [1.0] * (DISCOUNTED - top + 1)))
        return cls(np.array([1.0] + [1 - 0.5 / r for r in range(1, DISCOUNTED + 1)] + [1.0]))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return counts * self.factors[np.minimum(counts, DISCOUNTED + 1).astype(np.int64)]


@dataclass
class Unigrams:
    """What scoring needs of the lowest order: totals and discounts. Unknown words share what the discounts leave."""

    tokens: int
    types: int
    discounts: Discounts
    kept_mass: float
    texts: int

    @property
    def total(self) -> float:
        return self.tokens + (self.kept_mass >= self.tokens)  # one count more where nothing would be left

    @property
    def unknown(self) -> float:
        return 1 - self.kept_mass / self.total

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts(counts) / self.total, self.unknown)

    def base_log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


class Block:
    """Some texts as numbers of the block's words, and their word pairs."""

    def __init__(self, row, training_counts: bool = True):
        self.words = unsqueezed_keys(row.vocabulary)
        self.tokens = unsqueezed(row.tokens, "u4").astype(np.int64)
        self.ends = np.cumsum(unsqueezed(row.lengths, "u4").astype(np.int64))
        self.train = np.repeat(unsqueezed(row.train, "u1").astype(bool), np.diff(self.ends, prepend=0))
        self.own = np.bincount(self.tokens[self.train], minlength=len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs: history (one past the words: start of a text), word, training count; and each token's pair."""
        start = len(self.words)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.concatenate(([0], self.ends[:-1]))] = start
        code, place = np.unique(before * (start + 1) + self.tokens, return_inverse=True)
        return code // (start + 1), code % (start + 1), np.bincount(place[self.train], minlength=len(code)), place


def _bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """Store a frame in the shared folder as a table bucketed by a column, so that grouping by it moves nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    own = f"{name}_{path.rsplit('-', 1)[-1]}"
    df.write.format("parquet").bucketBy(partitions(spark), by).option("path", path).saveAsTable(own)
    return spark.table(own)


def _blocks(docs: DataFrame, id_col: str, text_col: str, train: Column) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))

    def block(number: int, ids: list, texts: list[str], train: list[bool]) -> pd.DataFrame:
        hashes, first = word_hashes(texts)
        vocabulary, tokens = np.unique(np.insert(hashes, first[1:], END), return_inverse=True)
        return pd.DataFrame([{
            "block": number, "ids": ids, "train": squeezed(np.array(train, dtype=np.uint8)), "lengths": squeezed((np.diff(first) + 1).astype(np.uint32)),
            "vocabulary": squeezed_keys(vocabulary), "tokens": squeezed(tokens.astype(np.uint32)), "n_words": len(vocabulary), "n_tokens": len(tokens)}])

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, ([], [], [])
        for pdf in batches:
            for row in zip(pdf["id"], pdf["text"], pdf["train"], strict=True):
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                size += len(row[1])
                if size >= BLOCK_CHARACTERS:
                    yield block(number, *held)
                    number, size, held = number + 1, 0, ([], [], [])
        if held[0]:
            yield block(number, *held)

    schema = "block bigint, ids array<string>, train binary, lengths binary, vocabulary binary, tokens binary, n_words bigint, n_tokens bigint"
    return _bucketed(rows.mapInPandas(gather, schema), "katz_blocks", "block")


def _slices(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Runs of sorted keys by shard: equal ranges of the key."""
    bounds = np.searchsorted((keys >> np.uint64(33)).astype(np.int64), [(s << 31) // shards for s in range(shards + 1)])
    for s, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            yield s, slice(a, b)


REQUEST = "shard int, block bigint, keys binary, counts binary"
ANSWER = "kind string, shard int, block bigint, counts binary"


def _summed(requests: DataFrame, name: str) -> DataFrame:
    """Sums each key's counts over all blocks, shard by shard, and stores the table of totals by shard and block.

    ``kind`` is ``answer`` (for one block, the totals of its keys in its order; bits mark a key that this block is the
    first to have counted, so the marked ones make up the whole table, and one that others have too) or ``counts`` (how
    many keys have each of the counts 1 to 6, how many keys there are, and their sum). Keys that one block alone has come
    with a negative shard; their totals are the block's own.
    """

    def tallied(totals: np.ndarray) -> bytes:
        small = np.bincount(totals[totals <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
        return squeezed(np.concatenate((small, [len(totals), totals.sum()])).astype(np.uint64))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, shard, at, out = pdf.sort_values("block"), int(pdf["shard"].iloc[0]), 0, []
        if shard < 0:  # pairs of one block alone, already complete
            for r in pdf.itertuples():
                out.append(("counts", shard, None, tallied(unsqueezed(r.counts, "u4").astype(np.int64))))
            return pd.DataFrame(out, columns=["kind", "shard", "block", "counts"])
        keys = [unsqueezed_keys(k) for k in pdf["keys"]]
        counts = [unsqueezed(c, "u4") for c in pdf["counts"]]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        each = np.concatenate(counts)
        totals = np.bincount(place, each, len(distinct)).astype(np.int64)
        counted = np.flatnonzero(each)
        _, first = np.unique(place[counted], return_index=True)
        answer = totals.astype(np.uint64)[place]
        answer[counted[first]] |= _OWNED
        answer[np.bincount(place)[place] > 1] |= _SHARED
        for block, k in zip(pdf["block"], keys, strict=True):
            out.append(("answer", shard, block, squeezed(answer[at : at + len(k)])))
            at += len(k)
        seen = totals > 0
        out.append(("counts", shard, None, tallied(totals[seen])))
        return pd.DataFrame(out, columns=["kind", "shard", "block", "counts"])

    return kept(requests.groupBy("shard").applyInPandas(add, ANSWER), name)


def _statistics(summed: DataFrame) -> tuple[dict[int, int], int, int]:
    """Counts of counts 1 to 6, distinct keys and the sum of counts."""
    total = np.zeros(DISCOUNTED + 4, dtype=np.int64)
    for r in summed.where("kind = 'counts'").select("counts").toLocalIterator():  # nine numbers a shard
        total += unsqueezed(r["counts"], "u8").astype(np.int64)
    return {r: int(total[r]) for r in range(1, DISCOUNTED + 2)}, int(total[-2]), int(total[-1])


def _answers(pdf: pd.DataFrame) -> np.ndarray:
    pdf = pdf.sort_values("shard")
    return np.concatenate([unsqueezed(c, "u8") for c in pdf["counts"]]) if len(pdf) else np.empty(0, dtype=np.uint64)


def _by_kind(answers: pd.DataFrame, kind: str) -> pd.DataFrame:
    return answers[answers["of"] == kind]


def _word_totals(answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of the block's words, and which of its words (and the start, last) other blocks have too."""
    got = _answers(answers)
    return (got & _COUNT).astype(np.int64), np.append((got & _SHARED) > 0, True)


def _exchanged(totals: np.ndarray, shared: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Which pairs other blocks may have too: both words known, and neither in this block alone."""
    known = np.append(totals > 0, True)
    return known[h] & known[w] & shared[h] & shared[w]


def _keys(block: Block, h: np.ndarray, w: np.ndarray) -> np.ndarray:
    words = np.append(block.words, START)
    both = np.stack((words[h], words[w]), axis=1).ravel()
    return window_hashes(both, 2)[::2]


def _pair_totals(block: Block, totals: np.ndarray, shared: np.ndarray, answers: pd.DataFrame):
    """The block's pairs with their counts in all training texts, and whether this block is to account for them."""
    h, w, own, place = block.pairs()
    sent = _exchanged(totals, shared, h, w)
    order = np.argsort(_keys(block, h[sent], w[sent]), kind="stable")
    got = _answers(answers)
    count, mine = own.astype(np.int64), own > 0
    back = np.flatnonzero(sent)[order]
    count[back] = (got & _COUNT).astype(np.int64)
    mine[back] = (got & _OWNED) > 0
    return h, w, count, mine, place


def _seen_mass(discounts: Discounts, unigrams: Unigrams, totals: np.ndarray, h, w, count, mine, size: int):
    """For each history: discounted counts of its followers that the block accounts for, and their lower-order mass."""
    seen = mine & (count > 0)
    lower = unigrams.probability(totals)
    # without entries numpy counts in whole numbers, whatever the weights
    return (np.bincount(h[seen], discounts(count[seen]), size).astype(np.float64), np.bincount(h[seen], lower[w[seen]], size).astype(np.float64))


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row's whole text; the model learns where ``train`` holds.

    A text's tokens are its words, A-Z in lower case, and one end; null is empty, so it has the end alone. ``score`` adds
    log10 P(word | word before): d(c) c / c(h) for a pair seen c times after a history seen c(h) times, with Good-Turing
    d, else a(h) P(word); a(h) spreads exactly what h's pairs leave over the words not seen after h. P(word) is
    Good-Turing discounted as well, and what that leaves is the probability of all unknown words together. Where
    discounts leave nothing, the history (or the vocabulary) gets one count more.

    Texts become blocks of word numbers. Each block sends its distinct words, and then its word pairs, once, by ranges of
    their hash, to where they are added up, and gets totals back; no key is hot, however frequent a word or pair is.
    Repeated rows count as often as they occur. Without training texts every word is unknown and scores 0.
    """
    spark = docs.sparkSession
    blocks = _blocks(docs, id_col, text_col, train)
    id_type = docs.schema[id_col].dataType.simpleString()
    sizes = blocks.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum(F.size("ids"))).first()
    word_shards, pair_shards = (max(4, int(n or 0) // KEYS_A_SHARD) for n in sizes[:2])

    def word_requests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                b = Block(row)
                yield pd.DataFrame([{"shard": s, "block": row.block, "keys": squeezed_keys(b.words[k]), "counts": squeezed(b.own[k].astype(np.uint32))}
                                    for s, k in _slices(b.words, word_shards)])

    words = _summed(blocks.mapInPandas(word_requests, REQUEST), "katz-words")
    counts, types, tokens = _statistics(words)
    discounts = Discounts.of(counts)
    freed = sum(r * n * (1 - discounts.factors[r]) for r, n in counts.items() if r <= DISCOUNTED)
    unigrams = Unigrams(tokens, types, discounts, tokens - freed, _count_texts(blocks))
    word_answers = words.where("kind = 'answer'").select(F.lit("words").alias("of"), "shard", "block", "counts")

    def with_answers(*answers: DataFrame):
        both = answers[0]
        for a in answers[1:]:
            both = both.unionByName(a)
        return blocks.groupBy("block").cogroup(both.groupBy("block"))

    def pair_requests(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples():
            b = Block(row)
            totals, shared = _word_totals(answers)
            h, w, own_counts, _ = b.pairs()
            sent = _exchanged(totals, shared, h, w)
            keys, n = _keys(b, h[sent], w[sent]), own_counts[sent]
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order].astype(np.uint32)
            out += [(s, row.block, squeezed_keys(keys[k]), squeezed(n[k])) for s, k in _slices(keys, pair_shards)]
            alone = ~sent & (own_counts > 0)
            out.append((-1 - row.block % pair_shards, row.block, None, squeezed(own_counts[alone].astype(np.uint32))))
        return pd.DataFrame(out, columns=["shard", "block", "keys", "counts"])

    pairs = _summed(with_answers(word_answers).applyInPandas(pair_requests, REQUEST), "katz-pairs")
    pair_counts, _, _ = _statistics(pairs)
    pair_discounts = Discounts.of(pair_counts)
    pair_answers = pairs.where("kind = 'answer'").select(F.lit("pairs").alias("of"), "shard", "block", "counts")

    def history_masses(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples():
            b = Block(row)
            totals, shared = _word_totals(_by_kind(answers, "words"))
            h, w, count, mine, _ = _pair_totals(b, totals, shared, _by_kind(answers, "pairs"))
            kept_mass, lower = _seen_mass(pair_discounts, unigrams, totals, h, w, count, mine, len(b.words) + 1)
            wide = np.flatnonzero(shared)
            names = np.append(b.words, START)[wide]
            order = np.argsort(names, kind="stable")
            names, wide = names[order], wide[order]
            out += [(s, row.block, squeezed_keys(names[k]), squeezed(kept_mass[wide[k]]), squeezed(lower[wide[k]])) for s, k in _slices(names, word_shards)]
        return pd.DataFrame(out, columns=["shard", "block", "keys", "mass", "lower"])

    def history_sums(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        keys = [unsqueezed_keys(k) for k in pdf["keys"]]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        out, at = [], 0
        mass = np.bincount(place, np.concatenate([unsqueezed(x, "f8") for x in pdf["mass"]]))[place]
        lower = np.bincount(place, np.concatenate([unsqueezed(x, "f8") for x in pdf["lower"]]))[place]
        for block, k in zip(pdf["block"], keys, strict=True):
            out.append(("histories", int(pdf["shard"].iloc[0]), block, squeezed(mass[at : at + len(k)]), squeezed(lower[at : at + len(k)])))
            at += len(k)
        return pd.DataFrame(out, columns=["of", "shard", "block", "counts", "lower"])

    masses = with_answers(word_answers, pair_answers).applyInPandas(history_masses, "shard int, block bigint, keys binary, mass binary, lower binary")
    histories = kept(masses.groupBy("shard").applyInPandas(history_sums, "of string, shard int, block bigint, counts binary, lower binary"), "katz-histories")

    def scored(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples():
            b = Block(row)
            totals, shared = _word_totals(_by_kind(answers, "words"))
            h, w, count, mine, place = _pair_totals(b, totals, shared, _by_kind(answers, "pairs"))
            mass, lower = _seen_mass(pair_discounts, unigrams, totals, h, w, count, mine, len(b.words) + 1)
            wide = np.flatnonzero(shared)
            wide = wide[np.argsort(np.append(b.words, START)[wide], kind="stable")]
            told = _by_kind(answers, "histories").sort_values("shard")
            if len(wide):
                mass[wide] = np.concatenate([unsqueezed(x, "f8") for x in told["counts"]])
                lower[wide] = np.concatenate([unsqueezed(x, "f8") for x in told["lower"]])
            seen_before = np.append(totals, unigrams.texts).astype(np.float64)
            whole = seen_before + (mass >= seen_before)  # one count more where the discounts leave nothing
            with np.errstate(divide="ignore", invalid="ignore"):
                back_off = np.where(seen_before > 0, (1 - mass / whole) / (1 - lower), 1.0)
                log = np.where(count > 0, np.log10(pair_discounts(count) / whole[h]), np.log10(back_off[h] * unigrams.probability(totals)[w]))
            starts = np.concatenate(([0], b.ends[:-1]))
            out.append(pd.DataFrame({
                "doc_id": row.ids, "n_tokens": np.diff(b.ends, prepend=0), "n_known": np.add.reduceat((totals[b.tokens] > 0).astype(np.int64), starts),
                "train_tokens": unigrams.tokens, "base_score": np.add.reduceat(unigrams.base_log10(totals)[b.tokens], starts),
                "score": np.add.reduceat(log[place], starts)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    padded = [a.withColumn("lower", F.lit(None).cast("binary")) for a in (word_answers, pair_answers)]
    scores = with_answers(*padded, histories).applyInPandas(
        scored, "doc_id string, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return scores.withColumn("doc_id", F.col("doc_id").cast(id_type))


def _count_texts(blocks: DataFrame) -> int:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n": [int(unsqueezed(t, "u1").sum()) for t in pdf["train"]]})

    return blocks.select("train").mapInPandas(count, "n bigint").agg(F.sum("n")).first()[0] or 0


@query("op1_katz_backoff")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 1
    scores = score_texts(docs, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
