"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, at least three periods long, that no neighbouring word extends. At
the scales t = 8, 16, 32, ... the windows of t words are hashed, and a position i is selected if of the windows that
begin at i .. i + t, those of period t / 3 or less left out, the first or the last has the smallest hash. Selection
depends on the 2 t words from i on alone, so it is the same wherever they recur, and only inside highly periodic regions
do more than t positions pass without one. A run of period 3 t / 2 .. 3 t - 1 therefore has a selected position whose
context recurs one period later: pairs of equal contexts at such distances propose periods, and every proposal is
extended word by word. Regions of a period below 12 are detected separately, by comparing words so far apart; they are
the small periods that the scales omit, and they and the runs found so far are the highly periodic windows of a scale.

The documents of an Arrow batch are laid end to end with a word of its own behind each, which no period can cross.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import text_of, without

#: The first scale; periods below three halves of it are compared directly.
FIRST = 8
#: Equal contexts of a scale t are more than t / 3 apart, so fewer than nine lie within 3 t.
NEXT = 8
#: Words that are laid end to end at once; a longer document is taken alone.
LAID = 1 << 20
_U64 = np.uint64
_GOLD = _U64(0x9E3779B97F4A7C15)
_NONE = _U64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A scramble of 64-bit integers."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _doubled(ids: np.ndarray, scale: int) -> np.ndarray:
    """Hashes of windows of 2 * scale words from those of `scale` words."""
    return _mixed(ids[:-scale] * _GOLD + ids[scale:])


def _right(words: np.ndarray, i: int, j: int) -> int:
    """How many words from i and from j > i on are alike."""
    total, size = 0, 64
    while True:
        there = words[j + total : j + total + size]
        differ = words[i + total : i + total + len(there)] != there
        if differ.any():
            return total + int(differ.argmax())
        total += len(there)
        if len(there) < size:
            return total
        size *= 2


def _left(words: np.ndarray, i: int, j: int) -> int:
    """How many words before i and before j > i are alike."""
    total, size = 0, 64
    while True:
        size = min(size, i - total)
        differ = words[i - total - size : i - total] != words[j - total - size : j - total]
        if differ.any():
            return total + int(differ[::-1].argmax())
        total += size
        if total == i:
            return total
        size *= 2


def _stretches(words: np.ndarray, period: int) -> np.ndarray:
    """Rows (start, end, period) of the longest stretches of this period that are three periods long."""
    same = np.zeros(len(words) - period + 2, dtype=np.int8)
    same[1:-1] = words[:-period] == words[period:]
    edges = np.flatnonzero(np.diff(same))
    start, end = edges[::2], edges[1::2]
    fine = end - start >= 2 * period
    return np.stack([start[fine], end[fine] + period, np.full(fine.sum(), period)], axis=1)


def _periodic(known: np.ndarray, scale: int, size: int) -> np.ndarray:
    """Whether the window of `scale` words from each of `size` positions on has a period of a third of it or less."""
    start, end, period = known[(known[:, 2] <= scale // 3) & (known[:, 1] - known[:, 0] >= scale)].T
    steps = np.zeros(size + 1, dtype=np.int64)
    inside = start < size
    np.add.at(steps, start[inside], 1)
    np.add.at(steps, np.minimum(end - scale + 1, size)[inside], -1)
    return np.cumsum(steps[:-1]) > 0


def selected(ids: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """The synchronising set: positions whose first or last window of this scale has the smallest hash around."""
    own = np.where(periodic, _NONE, ids)
    low, width = own, 1
    while width < scale:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:-1], own[scale:])
    return np.flatnonzero((low != _NONE) & ((low == own[:-scale]) | (low == own[scale:])))


def _proposed(place: np.ndarray, context: np.ndarray, least: int, most: int) -> np.ndarray:
    """Rows (distance, position) of equal contexts that are `least` to `most` apart, ascending."""
    order = np.lexsort((place, context))
    place, context = place[order], context[order]
    found = [np.zeros((0, 2), dtype=np.int64)]
    for k in range(1, NEXT + 1):
        alike = context[k:] == context[:-k]
        if not alike.any():
            break
        apart = place[k:] - place[:-k]
        fine = alike & (apart >= least) & (apart <= most)
        found.append(np.stack([apart[fine], place[:-k][fine]], axis=1))
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def _extended(words: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the proposals that are three periods long, each stretch once."""
    found, last, until = [], 0, 0
    for period, place in proposed.tolist():
        if period == last and place < until:
            continue
        start = place - _left(words, place, place + period)
        end = place + period + _right(words, place, place + period)
        last, until = period, end - period
        if end - start >= 3 * period:
            found.append((start, end, period))
    return np.array(found, dtype=np.int64).reshape(-1, 3)


def _runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in documents laid end to end, longest first, each with a word of its own
    behind it; `sizes` are their words with that one."""
    ends = np.cumsum(sizes)
    # Only documents of three periods can have a run: they are the first ones.
    upto = lambda period: int(ends[n - 1]) if (n := int((sizes > 3 * period).sum())) else 0
    known = [np.zeros((0, 3), dtype=np.int64)]
    for period in range(1, 3 * FIRST // 2):
        if size := upto(period):
            known.append(_stretches(words[:size], period))
    scale, ids = 1, _mixed(words.astype(_U64) + _GOLD)
    while size := upto(3 * max(scale, FIRST) // 2):
        ids = ids[: size - scale + 1]
        context = _doubled(ids, scale)
        if scale >= FIRST:
            every = np.concatenate(known)
            place = selected(ids, _periodic(every, scale, len(ids)), scale)
            proposed = _proposed(place, context[place], 3 * scale // 2, 3 * scale - 1)
            known.append(_extended(words[:size], proposed))
        ids, scale = context, 2 * scale
    # A stretch also has the multiples of its period: the smallest counts.
    every = np.concatenate(known)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), dtype=bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    return every[new]


def find(documents: Sequence[np.ndarray], least: int) -> list[np.ndarray]:
    """For each document, given as numbers of its words, rows (start, length, period) of its runs of at least `least`
    words, by start and period."""
    out = [np.zeros((0, 3), dtype=np.int64)] * len(documents)
    order = sorted((k for k in range(len(documents)) if len(documents[k]) >= max(3, least)), key=lambda k: -len(documents[k]))
    first = 0
    while first < len(order):
        last, total = first + 1, len(documents[order[first]])
        while last < len(order) and total + len(documents[order[last]]) <= LAID:
            total += len(documents[order[last]])
            last += 1
        some = order[first:last]
        sizes = np.array([len(documents[k]) + 1 for k in some])
        top = 1 + max(int(documents[k].max()) for k in some)
        words = np.concatenate([np.append(documents[k], top + n) for n, k in enumerate(some)])
        found = _runs(words, sizes)
        found = found[found[:, 1] - found[:, 0] >= least]
        starts = np.cumsum(sizes) - sizes
        owner = np.searchsorted(starts, found[:, 0], side="right") - 1
        for n in np.unique(owner).tolist():
            start, end, period = found[owner == n].T
            rows = np.stack([start - starts[n], end - start, period], axis=1)
            out[some[n]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
        first = last
    return out


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs.tolist():
        kept[start + period : start + length] = False
    return b" ".join(w for w, k in zip(words, kept.tolist(), strict=True) if k)


def _finder(least: int):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    @F.arrow_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def made(texts: pa.Array) -> pa.Array:
        # Splitting bytes cuts at the space and 09 to 0D alone.
        split = [t.encode().split() for t in texts.to_pylist()]
        number = count()
        numbers: dict[bytes, int] = {}
        for words in split:
            for word in words:
                if word not in numbers:
                    numbers[word] = next(number)
        own = [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in split]
        rows = [
            {
                "n_words": len(words),
                "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()],
                "collapsed": _collapsed(words, runs).decode(),
            }
            for words, runs in zip(split, find(own, least), strict=True)
        ]
        return pa.array(rows, type=kind)

    return made


def detect(docs: DataFrame, least: int = 24, text: str = "text") -> DataFrame:
    """Add n_words, `runs` (start, length and period in words, by start and period) and `collapsed`, the words without
    those that a run contains after its first period, joined by one space.

    Words are what spaces and the characters 09 to 0D part. A run is at least `least` words and three periods long. A
    null or empty text has no words, no runs and an empty `collapsed`. Rows are taken one by one, repeated ones alike,
    whatever their id; an empty table gives an empty one. Other columns stay, except those of the names added.
    """
    found = _finder(least)(text_of(text))
    given = without(docs, [x for x in ("n_words", "runs", "collapsed", "_llm_runs") if x != text])
    return given.withColumn("_llm_runs", found).select(*given.columns, "_llm_runs.*")
