"""Byte-level BPE encoding and decoding over a published rank file.

A pre-token (one match of the split pattern) is looked up whole: a minimal perfect hash over the vocabulary's byte
strings gives one slot, whose string either equals the pre-token or proves it absent. Absent ones start as a linked list
of bytes; a heap holds the rank of every neighbouring pair, and the lowest rank, leftmost first, is joined until none is
left. Both tiers depend on the pre-token alone, so results are remembered in a bounded table per Python worker.
"""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import kept, text_of, without

#: Entries of each table of results; a full table is emptied.
REMEMBERED = 1_000_000
#: Longer strings are computed each time, so the table's bytes are bounded too.
REMEMBERED_CHARS = 64
_MASK = 0xFFFFFFFFFFFFFFFF
_RUN = re.compile(r"\s[\s]").search


class PerfectHash:
    """A minimal perfect hash in levels: keys alone in their cell of a level stay there, the others go on to the next.

    A key's slot is the number of occupied cells before its own, so n keys have the slots 0 to n-1. Any other string
    gets some slot or none (-1); the caller compares the string kept at the slot.
    """

    def __init__(self, keys: list[bytes], spread: float = 2.0):
        left = self.digests(keys)
        if len(np.unique(left)) < len(left):
            raise ValueError("two keys share a 64-bit digest")
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # occupied, slots before each cell
        used = 0
        while len(left):
            cells = self.cells(left, len(self.levels), max(1, int(spread * len(left))))
            alone = np.bincount(cells, minlength=max(1, int(spread * len(left)))) == 1
            self.levels.append((alone, used + np.cumsum(alone) - alone))
            used += int(alone.sum())
            left = left[~alone[cells]]

    @staticmethod
    def digests(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))

    @staticmethod
    def cells(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = (digests ^ (digests >> np.uint64(29))) * np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & _MASK)
        return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        digests, out = self.digests(keys), np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, before) in enumerate(self.levels):
            cells = self.cells(digests[open_], level, len(alone))
            found = alone[cells]
            out[open_[found]] = before[cells[found]]
            open_ = open_[~found]
        return out


class Coder:
    """Encodes and decodes with one vocabulary; `special` maps strings that stand for one id wherever they occur."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int] | None = None):
        self.ranks, self.special = ranks, special or {}
        self.split = regex.compile(pattern)
        # A space after a character that is no white space always begins a new pre-token.
        self.cut = regex.compile(r"(?<=\S)(?= )")
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.hash = PerfectHash(list(ranks))
        self.at = [b""] * len(ranks)
        for token, slot in zip(ranks, self.hash.slots(list(ranks)).tolist(), strict=True):
            self.at[slot] = token
        self.packed = [pack("<I", ranks[t]) for t in self.at]
        self.token = {i: t for t, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.words: dict[bytes, bytes] = {}  # by pre-token
        self.known: dict[str, bytes] = {}  # by chunk led by a space, without that space
        self.first: dict[str, bytes] = {}  # by chunk that starts a line
        self.feed = self.learn(["\n"])[0]

    def merged(self, word: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself."""
        n, rank = len(word), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        # An entry is rank, start and end of a pair in one number, so the smallest is the lowest rank, leftmost.
        bits = n.bit_length()
        both, low = 2 * bits, (1 << bits) - 1
        heap = [
            r << both | i << bits | i + 2 for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None
        ]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            end, i = entry & low, entry >> bits & low
            middle = after[i]
            if middle < 0 or middle >= end or after[middle] != end:
                continue  # one of the two has been joined with another since
            after[i], after[middle] = end, -1
            if end < n:
                before[end] = i
                if (r := rank(word[i : (far := after[end])])) is not None:
                    heappush(heap, r << both | i << bits | far)
            if (left := before[i]) >= 0 and (r := rank(word[left:end])) is not None:
                heappush(heap, r << both | left << bits | end)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : after[i]]])
            i = after[i]
        return out

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of chunks that end where a pre-token ends."""
        words = [[w.encode("utf-8", "surrogatepass") for w in self.split.findall(c)] for c in chunks]
        if len(self.words) > REMEMBERED:
            self.words = {}
        found, at, packed = self.words, self.at, self.packed
        every = list(set().union(*words).difference(found))
        for word, slot in zip(every, self.hash.slots(every).tolist(), strict=True):
            if slot >= 0 and at[slot] == word:
                found[word] = packed[slot]
            else:
                ids = self.merged(word)
                found[word] = pack(f"<{len(ids)}I", *ids)
        done = [found[ws[0]] if len(ws) == 1 else b"".join([found[w] for w in ws]) for ws in words]
        for word in every:
            if len(word) > REMEMBERED_CHARS:
                del found[word]
        return done

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        if self.marks is None:
            return self._encode(texts)
        parts = [self.marks.split(t) for t in texts]
        plain = iter(self._encode([p for ps in parts for p in ps[::2]]))
        return [
            b"".join(pack("<I", self.special[p]) if k % 2 else next(plain) for k, p in enumerate(ps)) for ps in parts
        ]

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Pre-tokens end before a space that follows no white space, and around a lone line feed, so texts are cut
        there and equal chunks are encoded once."""
        for table in (self.known, self.first):
            if len(table) > REMEMBERED:
                table.clear()
        lines: list[tuple[str, list[str]]] = []
        ends = []
        for text in texts:
            if _RUN(text):
                head, *body = self.cut.split(text)
                lines.append((head, [p[1:] for p in body]))
            else:
                for line in text.split("\n"):
                    head, *body = line.split(" ")
                    lines.append((head, body))
            ends.append(len(lines))
        late = self.remember(self.known, set().union(*(body for _, body in lines)), " ")
        late_first = self.remember(self.first, {head for head, _ in lines}, "")
        get = self.known.__getitem__
        done = [self.first[head] + b"".join(map(get, body)) for head, body in lines]
        for chunk in late:
            del self.known[chunk]
        for chunk in late_first:
            del self.first[chunk]
        return [self.feed.join(done[i:j]) for i, j in zip([0, *ends], ends, strict=False)]

    def remember(self, table: dict[str, bytes], chunks: set[str], lead: str) -> list[str]:
        """Put the chunks, each led by `lead`, into the table; those too long to stay there are returned."""
        new = list(chunks.difference(table))
        table.update(zip(new, self.learn([lead + c for c in new] if lead else new), strict=True))
        return [c for c in new if len(c) > REMEMBERED_CHARS]

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: one base64 string and one number a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _coder(spark, path: str, pattern: str, special: dict[str, int] | None):
    """A function that gives the worker's coder; the ranks are read on the driver and broadcast (a fixed file)."""
    ranks = read_ranks(path)
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks single bytes, {missing[0]} for one")
    name = hashlib.sha256(repr((sorted(ranks.items()), pattern, special)).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(ranks)
    return lambda: kept(f"bpe {name}", lambda: Coder(sent.value, pattern, special))


def encoder(spark, path: str, pattern: str, special: dict[str, int] | None = None):
    """A function Column -> Column: packed ids of a text column (null gives null)."""
    coder = _coder(spark, path, pattern, special)

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        done = iter(coder().encode_batch([t for t in given if t is not None]))
        return pa.array([None if t is None else next(done) for t in given], type=pa.binary())

    return ids


def decoder(spark, path: str, pattern: str, special: dict[str, int] | None = None):
    """A function Column -> Column: the bytes that packed ids stand for (null gives null)."""
    coder = _coder(spark, path, pattern, special)

    @F.arrow_udf("binary")
    def data(packed: pa.Array) -> pa.Array:
        decode = coder().decode
        return pa.array([None if p is None else decode(p) for p in packed.to_pylist()], type=pa.binary())

    return data


def encode(
    docs: DataFrame, path: str, pattern: str, special: dict[str, int] | None = None, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Add `out`, the ids of each whole text as packed little-endian unsigned 32-bit integers (see `unpacked`).

    Row by row, without a shuffle: repeated rows give repeated results, an empty table an empty one. A null or empty
    text has no ids (an empty string of bytes). Other columns stay; one that is called `out` is replaced.
    """
    ids = encoder(docs.sparkSession, path, pattern, special)
    return without(docs, [out]).withColumn(out, ids(text_of(text)))


def decode(
    docs: DataFrame, path: str, pattern: str, special: dict[str, int] | None = None, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add `out`, the bytes that the packed ids stand for. Null ids give null, no ids no bytes; an id that the
    vocabulary lacks fails the job. Other columns stay; one that is called `out` is replaced."""
    data = decoder(docs.sparkSession, path, pattern, special)
    return without(docs, [out]).withColumn(out, data(F.col(ids)))


def token_count(ids: str | Column = "ids") -> Column:
    """The number of packed ids."""
    return (F.octet_length(F.col(ids) if isinstance(ids, str) else ids) / 4).cast("long")


def unpacked(ids: str = "ids") -> Column:
    """Packed ids as an array of long."""
    at = F.sequence(F.lit(0), (F.octet_length(ids) / 4).cast("int") - 1)
    byte = lambda i, k: F.conv(F.hex(F.substring(F.col(ids), i * 4 + k, F.lit(1))), 16, 10).cast("long")
    return F.when(F.octet_length(ids) == 0, F.array().cast("array<long>")).otherwise(
        F.transform(at, lambda i: byte(i, 1) + byte(i, 2) * 256 + byte(i, 3) * 65536 + byte(i, 4) * 16777216)
    )
