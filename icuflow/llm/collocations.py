"""Phrase collocations from weighted acyclic automata of n-gram counts.

Every task numbers the words of its texts, sorts their n-grams and builds a count transducer of them: an acyclic
automaton over words in which the states with equal arcs are one, and the weight of an arc is the count of the n-gram
that it ends. These shards are written. Keys at even distances in them cut the order of all n-grams into ranges of about
equal work, however frequent a word or phrase is; each shard is cut at these keys, and the parts of a range are united,
weights summed. A part also carries the n-grams that are prefixes of its range's first key, so that in each range every
n-gram can be composed with the automaton to give the counts of its own prefixes.

That gives the first parts of phrases. For their last parts the frequent n-grams go through the same steps with their
words reversed, where suffixes are prefixes. Both results meet by phrase.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icuflow.llm.common import text_of, written

#: Words from which a task builds one shard, and n-grams of all shards that a range holds.
SHARD, RANGE = 1_000_000, 1_000_000
#: Keys from which the borders of a range are taken; words of a shard of texts to a phrase of a reversed one.
MARKS, DENSER = 8, 12
#: Bytes whose words are numbered at once.
CHUNK = 1 << 20
#: A-Z in lower case, tabs as spaces, and what ends a piece as a byte that no text has: fixed values.
ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"
TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + END * len(ENDS))
_U64 = np.uint64


@dataclass
class Grams:
    """N-grams in order, by length: of each its prefix's place, its last word's place in `words`, and its count."""

    words: list[bytes]
    parents: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    def __len__(self) -> int:
        return sum(map(len, self.labels))

    def phrase(self, depth: int, place: int) -> tuple[bytes, ...]:
        found = []
        for d in range(depth, -1, -1):
            found.append(self.words[self.labels[d][place]])
            place = int(self.parents[d][place])
        return tuple(reversed(found))

    def marks(self, apart: int) -> list[bytes]:
        """Longest n-grams that stand so many n-grams of any length apart, from a place on that differs between shards."""
        depth = max((d for d, x in enumerate(self.labels) if len(x)), default=0)
        step = max(1.0, apart * len(self.labels[depth]) / max(1, len(self)))
        first = step * (crc32(b" ".join(self.words[:9]) + str(len(self)).encode()) / 2**32)
        return [b" ".join(self.phrase(depth, int(x))) for x in np.arange(first, len(self.labels[depth]), step)]


def _narrow(x: np.ndarray) -> np.ndarray:
    """The numbers in 32 bits if they fit."""
    return x.astype(np.int32) if int(x.max(initial=0)) < 1 << 31 else x


def counted(numbers: np.ndarray, words: list[bytes], most: int) -> Grams:
    """The n-grams of up to `most` words in a sequence of numbers of words, -1 where a piece ends."""
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words) + 1, dtype=np.int64)
    rank[order], rank[-1] = np.arange(len(words)), -1
    own = rank[numbers]
    node, base = own, max(1, len(words))
    weight = np.bincount(own[own >= 0], minlength=len(words))
    out = Grams([words[k] for k in order], [np.zeros_like(weight)], [np.arange(len(words))], [weight])
    for depth in range(1, most):
        place = np.flatnonzero((node[:-1] >= 0) & (own[depth:] >= 0)) if len(own) > depth else np.zeros(0, dtype=np.int64)
        key, at, n = np.unique(node[place] * base + own[place + depth], return_inverse=True, return_counts=True)
        out.parents.append(_narrow(key // base))
        out.labels.append(_narrow(key % base))
        out.weights.append(_narrow(n))
        node = np.full(max(0, len(own) - depth), -1, dtype=np.int64)
        node[place] = at
    return out


def united(parts: Sequence[Grams]) -> Grams:
    """All n-grams of the parts, the counts of equal ones summed."""
    words = sorted(set().union(*[p.words for p in parts]))
    number = {w: k for k, w in enumerate(words)}
    named = [np.fromiter(map(number.__getitem__, p.words), dtype=np.int64, count=len(p.words)) for p in parts]
    above = [np.zeros(1, dtype=np.int64)] * len(parts)
    out, base = Grams(words, [], [], []), max(1, len(words))
    for depth in range(len(parts[0].labels)):
        keys = [a[p.parents[depth]] * base + n[p.labels[depth]] for a, p, n in zip(above, parts, named, strict=True)]
        # Each part is in order already, which this sort makes use of.
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        joined = joined[order]
        new = np.ones(len(joined), dtype=bool)
        new[1:] = joined[1:] != joined[:-1]
        starts = np.flatnonzero(new)
        weights = np.concatenate([p.weights[depth].astype(np.int64) for p in parts])[order]
        place = np.empty(len(joined), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        above = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        out.parents.append(joined[starts] // base)
        out.labels.append(joined[starts] % base)
        out.weights.append(np.add.reduceat(weights, starts) if len(starts) else weights)
    return out


def borders(grams: Grams, key: Sequence[bytes]) -> tuple[list[int], list[int]]:
    """For each length the place of the first n-gram not below `key`, and that of the first one a part from there on
    takes: one less where a prefix of the key stands before it."""
    cut, begin, path = [], [], 0
    for depth in range(len(grams.labels)):
        label = grams.labels[depth]
        if path is None or depth >= len(key):
            at = int(np.searchsorted(grams.parents[depth], cut[-1])) if depth else 0
            path = None
            cut.append(at)
            begin.append(at)
            continue
        low, high = (0, len(label)) if not depth else np.searchsorted(grams.parents[depth], [path, path + 1]).tolist()
        wanted = bisect_left(grams.words, key[depth])
        at = low + int(np.searchsorted(label[low:high], wanted))
        there = at < high and label[at] == wanted and grams.words[wanted] == key[depth]
        prefix = there and depth + 1 < len(key)
        path = at if there else None
        cut.append(at + prefix)
        begin.append(at)
    return cut, begin


def parts(grams: Grams, keys: Sequence[Sequence[bytes]]) -> Iterator[tuple[int, Grams]]:
    """Number and n-grams of each range that the ascending keys cut, prefixes of its first key included."""
    cuts = [([0] * len(grams.labels),) * 2, *[borders(grams, key) for key in keys], ([len(x) for x in grams.labels],) * 2]
    for number in range(len(keys) + 1):
        begin, end = cuts[number][1], cuts[number + 1][0]
        if all(b >= e for b, e in zip(begin, end, strict=True)):
            continue
        some = [slice(b, max(b, e)) for b, e in zip(begin, end, strict=True)]
        used = np.unique(np.concatenate([x[s] for x, s in zip(grams.labels, some, strict=True)]))
        above = [0, *begin[:-1]]
        yield (
            number,
            Grams(
                [grams.words[k] for k in used.tolist()],
                [x[s] - a for x, s, a in zip(grams.parents, some, above, strict=True)],
                [_narrow(np.searchsorted(used, x[s])) for x, s in zip(grams.labels, some, strict=True)],
                [x[s] for x, s in zip(grams.weights, some, strict=True)],
            ),
        )


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def registered(parent: np.ndarray, n: int, arcs: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States for the sorted arcs of n parents, equal ones once: each parent's state (from 1, 0 without arcs), where the
    arcs of each state start, and which of the given arcs they are."""
    sizes = np.bincount(parent, minlength=n)
    begin = np.cumsum(sizes) - sizes
    owner = np.flatnonzero(sizes)
    mark = np.zeros(len(parent), dtype=_U64)
    for column in arcs:
        mark = _scrambled(mark + column.astype(_U64) * _U64(0x9E3779B97F4A7C15) + _U64(1))
    total = np.add.reduceat(mark, begin[owner]) if len(owner) else mark
    _, first, state = np.unique(total, return_index=True, return_inverse=True)
    like = owner[first[state]]
    other = np.repeat(begin[like] - begin[owner], sizes[owner]) + np.arange(len(parent))
    if (sizes[like] != sizes[owner]).any() or any((column[other] != column).any() for column in arcs):
        # Two different states have one hash: none is shared.
        first = state = np.arange(len(owner))
    target = np.zeros(n, dtype=np.int64)
    target[owner] = state + 1
    kept = owner[first]
    start = np.concatenate([[0], np.cumsum(sizes[kept])])
    return target, start, np.repeat(begin[kept] - start[:-1], sizes[kept]) + np.arange(start[-1])


def _packed(x: np.ndarray) -> np.ndarray:
    """The numbers in the narrowest unsigned type that holds them."""
    most = int(x.max(initial=0))
    return x.astype(next(t for t in ("u1", "<u2", "<u4", "<u8") if most < 1 << 8 * np.dtype(t).itemsize))


def transducer(grams: Grams) -> bytes:
    """The minimal acyclic automaton of the n-grams, by depth: where the arcs of its states start, their words, counts and
    targets. States are closed in the order of the n-grams, the deepest first."""
    arrays, target = [], np.zeros(len(grams.labels[-1]), dtype=np.int64)
    for depth in range(len(grams.labels) - 1, -1, -1):
        arcs = (grams.labels[depth], grams.weights[depth], target)
        above = len(grams.labels[depth - 1]) if depth else 1
        target, start, index = registered(grams.parents[depth], above, arcs)
        arrays = [np.diff(start), *[x[index] for x in arcs], *arrays]
    small = [_packed(x) for x in arrays]
    text = b" ".join(grams.words)
    head = np.array([len(small), len(grams.words), len(text), *[y for x in small for y in (x.dtype.itemsize, len(x))]], dtype="<i8")
    return b"".join([head.tobytes(), text, *[x.tobytes() for x in small]])


def spelled(packed: bytes) -> Grams:
    """The n-grams of a transducer, by walking it from the root a word at a time, all paths at once."""
    n, n_words, n_text = np.frombuffer(packed, "<i8", 3).tolist()
    shape = np.frombuffer(packed, "<i8", 2 * n, 24).reshape(n, 2).tolist()
    at = 24 + 16 * n
    words = packed[at : at + n_text].split(b" ") if n_words else []
    at, arrays = at + n_text, []
    for width, length in shape:
        arrays.append(np.frombuffer(packed, f"<u{width}", length, at))
        at += width * length
    out, state = Grams(words, [], [], []), np.ones(1, dtype=np.int64)
    for depth in range(n // 4):
        sizes, label, weight, target = arrays[4 * depth : 4 * depth + 4]
        # State 0 has no arcs; the root is state 1 if it has any.
        start = np.concatenate([[0, 0], np.cumsum(sizes, dtype=np.int64)])
        sizes = np.concatenate([[0], sizes.astype(np.int64)]) if len(sizes) else np.zeros(2, dtype=np.int64)
        own = sizes[state]
        index = np.repeat(start[state] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        out.parents.append(np.repeat(np.arange(len(state), dtype=np.int32), own))
        out.labels.append(_narrow(label[index]))
        out.weights.append(_narrow(weight[index]))
        state = target[index]
    return out


def _sent(grams: Grams) -> bytes:
    """The transducer, compressed: a task holds some of them in its JVM too."""
    packed = transducer(grams)
    return len(packed).to_bytes(8, "little") + pa.compress(packed, codec="zstd", asbytes=True)


def _received(sent: bytes) -> Grams:
    size = int.from_bytes(sent[:8], "little")
    return spelled(pa.decompress(sent[8:], decompressed_size=size, codec="zstd", asbytes=True))


def composed(grams: Grams) -> list[np.ndarray]:
    """For each length a matrix: of every n-gram the counts of its prefixes, shortest first, itself last."""
    out = [grams.weights[0][:, None]]
    for depth in range(1, len(grams.labels)):
        out.append(np.hstack([out[-1][grams.parents[depth]], grams.weights[depth][:, None]]))
    return out


SHARDS = "lang string, words long, marks array<binary>, counts binary"
FOUND = "lang string, phrase string, size int, a long, parts array<long>, longest long"


_SHARDS = pa.schema([("lang", pa.string()), ("words", pa.int64()), ("marks", pa.list_(pa.binary())), ("counts", pa.binary())])
_PARTS = pa.schema([("lang", pa.string()), ("range", pa.int64()), ("counts", pa.binary())])
_FOUND = pa.schema(
    [("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("a", pa.int64()), ("parts", pa.list_(pa.int64())), ("longest", pa.int64())]
)


def _shard(lang: str, words: int, grams: Grams, apart: int) -> pa.RecordBatch:
    row = {"lang": lang, "words": words, "marks": grams.marks(apart), "counts": _sent(grams)}
    return pa.RecordBatch.from_pylist([row], schema=_SHARDS)


def _numbered(text: bytes, numbers: defaultdict) -> list[np.ndarray]:
    """Numbers of the words of a text, some of it at a time, cut where a word ends."""
    out, at = [], 0
    while at < len(text):
        end = len(text) if at + CHUNK >= len(text) else text.find(b" ", at + CHUNK)
        end = len(text) if end < 0 else end
        words = text[at:end].replace(END, b" \xff ").split()
        out.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        at = end
    return out


def _text_shards(most: int, most_words: int, apart: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard for each language and `most_words` words of a task, or the document that passes them."""

    def fresh() -> tuple[defaultdict, list]:
        numbers: defaultdict = defaultdict(count().__next__)
        numbers[END] = -1
        return numbers, []

    def shard(lang: str) -> pa.RecordBatch:
        numbers, found = held.pop(lang)
        words = [w for w in numbers if w != END]
        every = np.concatenate(found)
        return _shard(lang, int((every >= 0).sum()), counted(every, words, most), apart)

    held: dict[str, tuple[defaultdict, list]] = {}
    size = 0
    for batch in batches:
        texts = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts[lang].append(text.encode().translate(TABLE))
        for lang, some in texts.items():
            numbers, found = held.setdefault(lang, fresh())
            # A piece ends where a text does.
            new = _numbered((b" \xff ".join(some)) + b" \xff ", numbers)
            found += new
            size += sum(map(len, new))
        if size >= most_words:
            for lang in list(held):
                yield shard(lang)
            size = 0
    for lang in list(held):
        yield shard(lang)


def _phrase_shards(most: int, most_phrases: int, apart: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard for each language and `most_phrases` phrases of a task, with the words of every phrase reversed."""
    held: dict[str, list[tuple[tuple[bytes, ...], int]]] = defaultdict(list)
    size = 0

    def shard(lang: str) -> pa.RecordBatch:
        return _shard(lang, 0, from_counts(held.pop(lang), most), apart)

    for batch in batches:
        for lang, phrase, a in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            held[lang].append((tuple(phrase.encode().split(b" ")[::-1]), a))
        size += batch.num_rows
        if size >= most_phrases:
            for lang in list(held):
                yield shard(lang)
            size = 0
    for lang in list(held):
        yield shard(lang)


def from_counts(rows: Sequence[tuple[tuple[bytes, ...], int]], most: int) -> Grams:
    """N-grams with given counts. A prefix that is not among them is there with count 0: another shard has its count."""
    words = sorted({w for gram, _ in rows for w in gram})
    number = {w: k for k, w in enumerate(words)}
    out, base = Grams(words, [], [], []), max(1, len(words))
    label = np.full((len(rows), most), -1, dtype=np.int64)
    for k, (gram, _) in enumerate(rows):
        label[k, : len(gram)] = [number[w] for w in gram]
    weight = np.array([a for _, a in rows], dtype=np.int64)
    size = (label >= 0).sum(axis=1)
    node = np.zeros(len(rows), dtype=np.int64)
    for depth in range(most):
        there = np.flatnonzero(size > depth)
        key, at = np.unique(node[there] * base + label[there, depth], return_inverse=True)
        own = np.zeros(len(key), dtype=np.int64)
        ends = size[there] == depth + 1
        np.add.at(own, at[ends], weight[there[ends]])
        out.parents.append(key // base)
        out.labels.append(key % base)
        out.weights.append(own)
        node = np.full(len(rows), -1, dtype=np.int64)
        node[there] = at
    return out


def _cut(keys: dict[str, list[tuple[bytes, ...]]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of every shard, one transducer each."""
    for batch in batches:
        for lang, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for number, part in parts(_received(packed.as_py()), keys.get(lang, [])):
                row = {"lang": lang, "range": number, "counts": _sent(part)}
                yield pa.RecordBatch.from_pylist([row], schema=_PARTS)


def _unite(keys: dict[str, list[tuple[bytes, ...]]], least: int, key: tuple, table: pa.Table) -> pa.Table:
    """The n-grams of a range with a count of `least` or more: a, the counts of their prefixes, and that of their most
    frequent continuation. Of a prefix of the range's first key the continuation alone is given, without a."""
    lang, number = key[0].as_py(), key[1].as_py()
    grams = united([_received(x.as_py()) for x in table.column("counts")])
    own = borders(grams, keys[lang][number - 1])[0] if number else [0] * len(grams.labels)
    rows = []
    for depth, (weight, prefixes) in enumerate(zip(grams.weights, composed(grams), strict=True)):
        longest = np.zeros(len(weight), dtype=np.int64)
        if depth + 1 < len(grams.weights):
            more = grams.weights[depth + 1]
            np.maximum.at(longest, grams.parents[depth + 1], np.where(more >= least, more, 0))
        here = np.arange(len(weight)) >= own[depth]
        for k in np.flatnonzero((here & (weight >= least)) | (~here & (longest > 0))).tolist():
            phrase = b" ".join(grams.phrase(depth, k)).decode()
            counts = {"a": int(weight[k]), "parts": prefixes[k].tolist()} if here[k] else {"a": None, "parts": None}
            rows.append({"lang": lang, "phrase": phrase, "size": depth + 1, "longest": int(longest[k]), **counts})
    return pa.Table.from_pylist(rows, schema=_FOUND)


def _looked_up(shards: DataFrame, least: int) -> DataFrame:
    """The columns of FOUND for the n-grams of written shards: cut into ranges, united, composed with their prefixes.

    The keys that cut the order are collected, MARKS for a range, as for a range partitioning.
    """
    marks = shards.select("lang", F.explode("marks").alias("mark")).collect()
    every = defaultdict(list)
    for row in marks:
        every[row["lang"]].append(tuple(bytes(row["mark"]).split(b" ")))
    keys = {lang: sorted(set(sorted(found)[MARKS - 1 :: MARKS])) for lang, found in every.items()}
    cut = shards.select("lang", "counts").mapInArrow(partial(_cut, keys), "lang string, range long, counts binary")
    unite = partial(_unite, keys, least)
    # More partitions than ranges, so that few of them meet in a task.
    ranges = sum(map(len, keys.values())) + shards.select("lang").distinct().count()
    parts = max(2 * ranges, int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = cut.repartition(parts, "lang", "range")
    return cut.groupBy("lang", "range").applyInArrow(lambda key, table: unite(key, table), FOUND)


#: The score of the lowest cut of a phrase: the smallest score, then the smallest first part.
_LOWEST = """array_min(transform(sequence(1, size - 1), k -> named_struct(
  'score', (cast(1000000 as decimal(7, 0)) * cast(a as decimal(19, 0)) * cast(a as decimal(19, 0)))
    div (cast(first[k - 1] as decimal(19, 0)) * cast(last[size - k - 1] as decimal(19, 0))),
  'k', k, 'l', first[k - 1], 'r', last[size - k - 1])))"""


def mine(
    docs: DataFrame,
    least: int = 10,
    most: int = 3,
    inside: int = 50,
    first: int = 2000,
    text: str = "text",
    lang: str = "lang",
    shard: int = SHARD,
    span: int = RANGE,
) -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n, score: for each language its `first` phrases of 2 to `most` words by
    score, count a and phrase.

    A-Z are lower-cased; `.,;:!?` and line ends end a piece, spaces and tabs a word; phrases lie inside a piece. A phrase
    counts from `least` occurrences on (overlapping ones too). Its score is floor(1000000 * a * a / (l * r)) for the cut
    into a first part that occurs l times and a last part that occurs r times with the lowest score, of equal ones that
    with the shorter first part. Phrases inside a longer one of at least `least` occurrences and `inside` per cent of
    theirs are left out. n are the words of the language. Null and empty texts have no words; a null language is `und`;
    repeated rows count as often as they come; an empty table gives an empty result. Other columns are not used.

    `shard` and `span` set the words of a shard and the n-grams of a range: the memory of a task, not the result.
    """
    apart = max(1, span // MARKS)
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), text_of(text).alias("text"))
    shards = written(given.mapInArrow(partial(_text_shards, most, shard, apart), SHARDS), rows_a_file=4)
    ahead = written(_looked_up(shards, least))
    frequent = ahead.where("a IS NOT NULL").select("lang", "phrase", "a")
    back = written(frequent.mapInArrow(partial(_phrase_shards, most, max(1, shard // DENSER), apart), SHARDS), rows_a_file=4)
    behind = _looked_up(back, least)
    mirrored = F.array_join(F.reverse(F.split("phrase", " ", -1)), " ")
    none = F.lit(None).cast("array<long>")
    both = (
        ahead.select("lang", "phrase", "size", "a", F.col("parts").alias("first"), none.alias("last"), "longest")
        .unionByName(
            behind.select("lang", mirrored.alias("phrase"), "size", "a", none.alias("first"), F.col("parts").alias("last"), "longest")
        )
        .where("size > 1")
        .groupBy("lang", "phrase")
        .agg(*[F.max(c).alias(c) for c in ("size", "a", "first", "last", "longest")])
        .where((F.col("a").isNotNull()) & (F.col("longest") * 100 < F.col("a") * inside))
    )
    scored = both.select("lang", "phrase", "a", F.expr(_LOWEST).alias("cut")).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The first of the parts of a language hold its first, so no task orders all phrases of a language: many parts, then four.
    part = lambda n: F.pmod(F.xxhash64("phrase", F.lit(n)), F.lit(n))
    rank = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(*order)).cast("long")
    some = scored
    for n in (int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4):
        some = some.withColumn("part", part(n)).withColumn("rank", rank("part")).where(F.col("rank") <= first).drop("part", "rank")
    ranked = some.withColumn("rank", rank()).where(F.col("rank") <= first)
    words = shards.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
