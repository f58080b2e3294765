"""Packing token pieces into sequences of one size.

Only the histogram of piece lengths is planned: best-fit decreasing over counts, in which a run of equal bins is one
entry. The plan says which ranks within a length go to which run of sequences. Its size depends on the sequence size
alone, so it is broadcast; pieces get their rank within their length from counts per bucket, without a global order, and
take their slots by a join on length and rank.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from icuflow.llm.bpe import Coder
from icuflow.llm.common import ROW, kept, text_of, with_row_key, written

Slot = tuple[int, int, int, int, int, int]  # length, first rank, rank after the last, first sequence, per sequence, offset


def plan(counts: dict[int, int], size: int) -> list[Slot]:
    """Best-fit decreasing over `counts` (pieces by length). Sequences are numbered from 0."""
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> runs (first sequence, sequences)
    slots: list[Slot] = []
    opened = 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a piece of {length} tokens does not fit into {size}")
        rank, count = 0, counts[length]
        while rank < count:
            free = min((r for r, runs in room.items() if r >= length and runs), default=size)
            per = free // length
            if runs := room.get(free):
                first, bins = runs.pop()
            else:
                first, bins = opened, -(-(count - rank) // per)
                opened += bins
            # The tightest room is filled before the next, so a sequence takes as many as it has room for.
            full = min(bins, (count - rank) // per)
            if full:
                slots.append((length, rank, rank + full * per, first, per, size - free))
                room[free - per * length].append((first, full))
                rank += full * per
            if full < bins and rank < count:
                some = count - rank
                slots.append((length, rank, count, first + full, some, size - free))
                room[free - some * length].append((first + full, 1))
                rank, full = count, full + 1
            if full < bins:
                room[free].append((first + full, bins - full))
    return slots


class LibraryCoder(Coder):
    """The same chunks and tables, with new chunks encoded by a library that reads the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int]):
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        super().__init__(ranks, pattern, special)

    def learn(self, chunks: list[str]) -> list[bytes]:
        encode = self.library.encode_ordinary
        return [np.array(encode(c), dtype="<u4").tobytes() for c in chunks]


def read_tokenizer(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks and added strings of a byte-level BPE tokenizer file whose ids follow its merges."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    # Bytes that are no visible character are written as the characters from 256 on, in their order.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    added = {t["content"]: t["id"] for t in whole["added_tokens"]}
    vocabulary = whole["model"]["vocab"]
    ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
    if [vocabulary["".join(p)] for p in pairs] != list(range(256, 256 + len(pairs))):
        raise ValueError("ids don't follow the merges")
    return ranks, added


def tokenizer(spark: SparkSession, path: str, pattern: str) -> Callable[[list[str]], Iterator[bytes]]:
    """A function for tasks: texts to packed ids, as the tokenizers library gives them without special tokens around a
    text; an added string inside a text is its id. The driver reads the file and broadcasts its ranks."""
    ranks, added = read_tokenizer(path)
    name = hashlib.sha256(repr((sorted(ranks.items()), sorted(added.items()), pattern)).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(ranks)
    build = partial(_library_coder, sent, pattern, added)
    return lambda texts: kept(f"pack {name}", build).encode_batch(texts)


def _library_coder(sent, pattern: str, added: dict[str, int]) -> LibraryCoder:
    return LibraryCoder(sent.value, pattern, added)


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of `length` tokens: all of `size`, but for the first."""
    first = length if length <= size else length % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, length, size)]


def pieces(encode: Callable[[list[str]], list[bytes]], end_id: int, size: int, with_ids: bool) -> Callable[[Column], Column]:
    """A function Column -> Column: a text's pieces (piece, start, length, ids_crc32 and, if wanted, packed ids)."""
    kind = "piece: int, start: long, length: long, ids_crc32: long" + ", ids: binary" * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.list_(pa.struct(fields + [("ids", pa.binary())] * with_ids))

    @F.arrow_udf(f"array<struct<{kind}>>")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for packed in encode(texts.to_pylist()):
            packed += end
            own = []
            for number, (start, length) in enumerate(cuts(len(packed) // 4, size)):
                ids = packed[4 * start : 4 * (start + length)]
                row = {"piece": number, "start": start, "length": length, "ids_crc32": zlib.crc32(ids)}
                own.append(row | {"ids": ids} if with_ids else row)
            out.append(own)
        return pa.array(out, type=arrow)

    return cut


def pack(
    docs: DataFrame, path: str, pattern: str, size: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per piece: the document's id, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`.

    A document is its text's ids and then `end_id`; one longer than `size` is cut into pieces of `size` tokens, of which
    the first may be shorter. Sequences are numbered from 0 and filled from 0 without gaps.

    A null or empty text is the end id alone. Every row is packed, repeated rows as often as they occur; equal lengths
    are dealt by bucket, then id, text hash and piece. An empty table gives an empty one. Only the id is kept of the
    other columns. Pieces are written once to the shared folder before they are counted.
    """
    spark = docs.sparkSession
    cut = pieces(tokenizer(spark, path, pattern), end_id, size, with_ids=False)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_row_key(docs.select(doc_id, text), doc_id, text)
    cut_rows = rows.select(doc_id, *ROW, F.inline(cut(text_of(text)))).withColumn(
        "_bucket", F.pmod(F.xxhash64(*ROW, "piece"), F.lit(buckets))
    )
    cut_rows = written(cut_rows)
    counted = cut_rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    counted = written(counted)  # `size` times the buckets at most
    # One row per length: `size` rows at most.
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    names = ("length", "first", "after", "sequence", "per", "place")
    slots = spark.createDataFrame(plan(histogram, size), ", ".join(f"{n} long" for n in names))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("length", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*ROW, "piece")
    ranked = cut_rows.withColumn("_in", F.row_number().over(inside)).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_in") - 1)
    at = F.col("_rank") - F.col("first")
    return (
        ranked.join(F.broadcast(slots), "length")
        .where((F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("after")))
        .select(
            doc_id,
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("sequence") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
            (F.col("place") + at % F.col("per") * F.col("length")).cast("long").alias("offset"),
        )
    )


def sequences(
    docs: DataFrame, placed: DataFrame, path: str, pattern: str, size: int = 1024, end_id: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """The packed sequences themselves: `sequence_id` and `ids` (packed), from documents with unique ids and their
    placing by `pack` with the same parameters."""
    cut = pieces(tokenizer(docs.sparkSession, path, pattern), end_id, size, with_ids=True)
    own = docs.select(doc_id, F.inline(cut(text_of(text)))).select(doc_id, "piece", "ids")
    part = F.struct("offset", "ids")
    joined = placed.select(doc_id, "piece", "sequence_id", "offset").join(own, [doc_id, "piece"])
    return joined.groupBy("sequence_id").agg(
        F.aggregate(
            F.array_sort(F.collect_list(part)), F.lit(b""), lambda a, p: F.concat(a, p["ids"])
        ).alias("ids")
    )
