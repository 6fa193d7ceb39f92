"""Best-fit-decreasing packing of tokenised documents into sequences."""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, mix64, query, release, table

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
PIECES_A_GROUP = 4096
BATCH_CHARACTERS = 1 << 20  # tokenised at once; the result is the same for any number
KNOWN_UNITS, KNOWN_IDS = 1 << 18, 1 << 21  # that an encoder remembers at most

# texts of these characters only, without runs of white space, fall into pieces that are encoded alone
_ODD = re.compile("[^\n -~À-ÖØ-öø-ɏ]")
_CUT, _STRANGE = 1, 2


def _pair_kinds() -> np.ndarray:
    """What a byte is after another (256 * byte + byte before): the start of a unit, or strange, so that the text goes whole."""
    after, before = np.divmod(np.arange(1 << 16), 256)
    letter = np.array([chr(b).isalnum() and b < 128 or b >= 128 for b in range(256)])
    mark = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)])
    white = np.array([chr(b) in " \n" for b in range(256)])
    control = np.array([(b < 32 and b != 10) or b == 127 for b in range(256)])
    # a unit starts at white space, and at a mark after a letter or digit, where pieces of the vocabulary end anyway
    cut_here = white[after] | (mark[after] & letter[before])
    return (_CUT * cut_here + _STRANGE * (control[after] | (white[after] & white[before]))).astype(np.uint8)


_PAIR_KINDS = _pair_kinds()
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_LONG_UNIT = 64


def unit_hashes(joined: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans without zero bytes, eight bytes at a time; ``joined`` ends in eight spare bytes."""
    words = np.ndarray((len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))
    out = words[starts] & _LOW_BYTES[np.minimum(lengths, 8)]
    more = np.flatnonzero(lengths > 8)
    for at in range(8, _LONG_UNIT, 8):
        more = more[lengths[more] > at]
        if not len(more):
            break
        out[more] = mix64(out[more]) + (words[starts[more] + at] & _LOW_BYTES[np.minimum(lengths[more] - at, 8)])
    for k in np.flatnonzero(lengths > _LONG_UNIT).tolist():
        span = joined[starts[k] : starts[k] + lengths[k]]
        out[k] = int.from_bytes(hashlib.blake2b(span, digest_size=8).digest(), "little")
    return mix64(out)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE vocabulary.

    Ids are those of ``tokenizers`` for the vocabulary file. Common texts fall into units, a word with the space or line
    end before it or the marks behind it, that are encoded alone: the distinct units of a batch are found by their 64-bit
    hashes, and those not met before go through the same vocabulary as merge ranks. The ids of the first
    ``KNOWN_UNITS`` units are remembered. Texts with uncommon characters or runs of white space go to ``tokenizers`` whole.
    """

    def __init__(self, path: str, batch_characters: int = BATCH_CHARACTERS):
        import public_tokenizers
        import tiktoken

        self.path, self.batch_characters = path, batch_characters
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.token_bytes[i] = len(token)
        # remembered units: hashes in order, and where in the ids each one's begin and how many they are
        self.hashes, self.first, self.many = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype="<u4")

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        at = 0
        while at < len(texts):
            start, size = at, 0
            while at < len(texts) and (at == start or size < self.batch_characters):
                size += len(texts[at] or "")
                at += 1
            yield from self._chunk(texts[start:at])

    def _chunk(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        filled = [t for t in texts if t]
        plain, ids, bounds = self._units(filled) if filled else ([], None, None)
        k = 0
        for text in texts:
            if not text:
                yield np.empty(0, dtype="<u4")
                continue
            if plain[k]:
                yield ids[bounds[k] : bounds[k + 1]]
            else:
                yield np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
            k += 1

    def _units(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which texts are plain, the ids of those in a row, and where each text's begin (one entry more at the end)."""
        parts = [t.encode() for t in texts]
        begins = np.cumsum([0] + [len(p) for p in parts])
        joined = b"".join([*parts, bytes(8)])
        del parts
        data = np.frombuffer(joined, dtype=np.uint8, count=int(begins[-1]))
        kinds = np.empty(len(data), dtype=np.uint8)
        kinds[0] = _PAIR_KINDS[256 * int(data[0])]
        kinds[1:] = _PAIR_KINDS[np.ndarray((len(data) - 1,), dtype="<u2", buffer=joined, strides=(1,))]
        plain = self._plain(texts, joined, data, begins, kinds)
        kinds[begins[:-1]] |= _CUT
        starts = np.flatnonzero(kinds & _CUT)
        del kinds
        lengths = np.diff(starts, append=len(data))
        units = np.diff(np.append(np.searchsorted(starts, begins[:-1]), len(starts)))
        if not plain.all():
            stay = np.repeat(plain, units)
            starts, lengths, units = starts[stay], lengths[stay], units * plain
        unit, distinct = pd.factorize(unit_hashes(joined, starts, lengths))
        example = np.empty(len(distinct), dtype=np.int64)
        example[unit[::-1]] = np.arange(len(unit))[::-1]
        first, many, pool = self._ids(distinct, joined, starts[example], lengths[example])
        counts = many[unit]
        sums = np.append(0, np.cumsum(counts))
        ids = pool[np.repeat(first[unit] - sums[:-1], counts) + np.arange(sums[-1])]
        return plain, ids, sums[np.append(0, np.cumsum(units))]

    def _plain(self, texts: list[str], joined: bytes, data: np.ndarray, begins: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Whether each text has common characters only, no run of white space and none at its ends, and no special token."""
        edges = data[begins[:-1]], data[begins[1:] - 1]
        plain = ~np.logical_or.reduce([(e == 32) | (e == 10) for e in edges])
        # a strange pair over a border is white space at the end of the text before and at the start of this one
        plain[np.searchsorted(begins, np.flatnonzero(kinds & _STRANGE), side="right") - 1] = False
        for k, text in enumerate(texts):
            if plain[k] and not text.isascii() and _ODD.search(text):
                plain[k] = False
        for s in self.special:
            if s.encode() in joined:
                plain &= np.array([s not in t for t in texts])
        return plain

    def _ids(self, hashes: np.ndarray, joined: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where they begin, how many, a pool) of the ids of distinct units."""
        order = np.argsort(hashes)
        row = np.empty(len(hashes), dtype=np.int64)
        row[order] = np.searchsorted(self.hashes, hashes[order])  # faster in order
        known = np.zeros(len(hashes), dtype=bool)
        inside = row < len(self.hashes)
        known[inside] = self.hashes[row[inside]] == hashes[inside]
        first, many = np.empty(len(hashes), dtype=np.int64), np.empty(len(hashes), dtype=np.int64)
        first[known], many[known] = self.first[row[known]], self.many[row[known]]
        new = np.flatnonzero(~known)
        if not len(new):
            return first, many, self.ids
        # the new units, a line end (one id) after each, are encoded in one go and told apart by their lengths in bytes
        spans = [joined[s : s + n] for s, n in zip(starts[new].tolist(), lengths[new].tolist(), strict=True)]
        flat = self.words.encode_to_numpy(b"\n".join([*spans, b""]).decode(), disallowed_special=()).astype("<u4")
        joined_at = np.cumsum(lengths[new] + 1) - (lengths[new] + 1)
        offsets = np.cumsum(self.token_bytes[flat]) - self.token_bytes[flat]
        at = np.searchsorted(offsets, joined_at)
        first[new], many[new] = len(self.ids) + at, np.append(at[1:], len(flat)) - at - 1
        pool = np.concatenate((self.ids, flat))
        if len(self.hashes) + len(new) <= KNOWN_UNITS and len(pool) <= KNOWN_IDS:
            every = np.concatenate((self.hashes, hashes[new]))
            order = np.argsort(every)
            self.hashes, self.ids = every[order], pool
            self.first, self.many = np.concatenate((self.first, first[new]))[order], np.concatenate((self.many, many[new]))[order]
        return first, many, pool


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than ``capacity``."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(text: Column, path: str | None = None, capacity: int = CAPACITY, batch_characters: int = BATCH_CHARACTERS) -> Column:
    """Array of (start, length, ids_crc32) of a text's pieces; the end id closes every text, null is empty."""

    @F.pandas_udf("array<struct<start:bigint,length:bigint,ids_crc32:bigint>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, end = Encoder(path or tokenizer_path(), batch_characters), END_ID.to_bytes(4, "little")
        for texts in batches:
            out = []
            for ids in encode(texts.tolist()):
                data, parts = memoryview(np.ascontiguousarray(ids)).cast("B"), cut(len(ids) + 1, capacity)
                crcs = [zlib.crc32(data[4 * s : 4 * (s + n)]) for s, n in parts]
                crcs[-1] = zlib.crc32(end, crcs[-1])  # the end id closes the last piece
                out.append([{"start": s, "length": n, "ids_crc32": c} for (s, n), c in zip(parts, crcs, strict=True)])
            yield pd.Series(out)
            del out, texts
            release()

    return pieces(text)


class CapacityTree:
    """Open bins by what is left in them: a segment tree over 0..capacity whose nodes count the bins below."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, left: int, by: int) -> None:
        node = self.leaves + left
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, left: int, number: int) -> None:
        self.bins[left].append(number)
        self._add(left, 1)

    def pop_tightest(self, need: int) -> tuple[int, int] | None:
        """(what is left, bin) of the open bin with the least room that still takes ``need``."""
        node, count = self.leaves + need, self.count
        while not count[node]:
            while node & 1:  # climb until a right neighbour exists
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        left = node - self.leaves
        number = self.bins[left].pop()
        self._add(left, -1)
        return left, number


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item; items in the order given should not grow."""
    tree, out, opened = CapacityTree(capacity), [], 0
    for n in lengths:
        found = tree.pop_tightest(n)
        left, number = found or (capacity, opened)
        opened += found is None
        out.append((number, capacity - left))
        tree.push(left - n, number)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, pieces_a_group: int = PIECES_A_GROUP) -> DataFrame:
    """Adds ``sequence_id, offset`` to ``pieces`` (``uid`` unique, ``length`` from 0 to ``capacity``, else an error).

    Pieces that fill a sequence stand alone. The others are dealt by a hash of ``uid`` to groups of about
    ``pieces_a_group``, whose number grows with the input, and each group is packed by itself: longest first, into the
    open sequence with the least room that is enough. A group leaves one sequence partly filled more than a packing of all
    pieces together might. A sequence is named by the ``uid`` of its first piece. An empty table gives no rows.
    """
    lone = F.col("length") == capacity
    n = pieces.where(~lone).count()
    groups = max(1, n // pieces_a_group)
    schema = f"{pieces._jdf.schema().toDDL()}, sequence_id bigint, offset bigint"

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True).drop(columns="_group")
        places = best_fit_decreasing(pdf["length"].tolist(), capacity)
        first: dict[int, int] = {}
        for uid, (number, _) in zip(pdf["uid"].tolist(), places, strict=True):
            first.setdefault(number, uid)
        return pdf.assign(sequence_id=[first[b] for b, _ in places], offset=[o for _, o in places])

    group = F.pmod(F.xxhash64("uid"), F.lit(groups))
    rest = pieces.where(~lone).withColumn("_group", group).groupBy("_group").applyInPandas(packed, schema)
    return pieces.where(lone).withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")}).unionByName(rest)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   capacity: int = CAPACITY, batch_characters: int = BATCH_CHARACTERS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every input row's pieces and their places.

    Null and empty texts are the end id alone. Equal rows and rows that repeat an id are packed one by one; null ids are
    kept. Texts longer than ``capacity`` ids are cut, the first piece taking what is left over.
    """
    pieces = kept(  # ids travel as text: null ones would turn a batch's whole numbers into floats
        docs.select(F.col(id_col).cast("string").alias("doc_id"), token_pieces(F.col(text_col), path, capacity, batch_characters).alias("_pieces"))
        .select("doc_id", F.posexplode_outer("_pieces").alias("piece", "_p"))  # none is empty; a plain one would tokenise twice, to filter first
        .select("doc_id", "piece", "_p.start", "_p.length", "_p.ids_crc32", F.monotonically_increasing_id().alias("uid")), "pieces")
    return pack(pieces, capacity).drop("uid").withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
