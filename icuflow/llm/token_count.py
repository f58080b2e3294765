"""Token counts by a published piece model (byte-pair merges with byte fallback), without making the tokens.

Texts are cut into pre-tokens: a piece never holds a space sign after another character, so no merge crosses there.
The pre-tokens of a batch lie one after another in flat numpy arrays. In each round every sequence merges its pair of
best rank, all sequences at once; sequences without a pair are done, and what they hold is counted.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuflow.llm.common import kept, text_of, without

#: Entries of each table of remembered counts; a full table is emptied. Longer strings are counted each time.
REMEMBERED = 1_000_000
REMEMBERED_CHARS = 64
#: Characters that are merged together; more are done in turns.
TOGETHER = 400_000
SPACE = "▁"
_NONE = np.iinfo(np.int32).max
_APART = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
_ODD = re.compile(f"  |^ | $|{SPACE}").search
#: Texts on which a model must agree with its library before it is used.
PROBES = ("", " ", "a", "  a  b ", "Ab c\nd\n\n e", "é中\U0001f600x", "a\x00b\t", f"{SPACE}x", "<s>a</s>", "aaaaaaaaa", "1 22 333")


class PieceCounter:
    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        odd = (library.is_control, library.is_unknown, library.is_byte, library.is_unused)
        scores = {library.id_to_piece(i): library.get_score(i) for i in range(len(library)) if not any(f(i) for f in odd)}
        crossing = re.compile(f"[^{SPACE}]{SPACE}").search
        if not any(map(library.is_byte, range(len(library)))) or any(map(crossing, scores)):
            raise ValueError("a piece model with byte fallback, whose pieces have the space sign in front, is needed")
        symbols = list(scores) + sorted({c for p in scores for c in p} - set(scores))
        ids = {s: i for i, s in enumerate(symbols)}
        steps = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        ranks = np.array([steps[scores[s]] if s in scores else _NONE for s in symbols], dtype=np.int32)
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for s, i in ids.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        self.width = len(symbols) + 1
        pairs = [
            (ids[p[:k]] * self.width + ids[p[k:]], i)
            for p, i in ids.items()
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ]
        keys, made = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T
        self.keys, self.made = keys, made.astype(np.int32)
        self.made_rank = ranks[made]
        self.shared = np.bincount(ranks[ranks != _NONE], minlength=len(steps)) > 1  # pieces of one rank
        self.joined = {k: (int(r), int(i)) for k, r, i in zip(keys.tolist(), self.made_rank, self.made, strict=True)}
        # After a merge into `p`, a pair with `p` could come before p's own rank.
        self.doubtful = np.zeros(len(steps), dtype=bool)
        for part in (keys // self.width, keys % self.width):
            sooner = part[(self.made_rank < ranks[part]) & (ranks[part] != _NONE)]
            self.doubtful[ranks[sooner]] = True
        self.is_piece = np.append(ranks != _NONE, False)  # the last for -1
        self.feed_apart = self.char[10] < 0
        self.led: dict[str, int] = {}  # by pre-token led by one space sign, without it
        self.bare: dict[str, int] = {}
        wrong = [p for p, n in zip(PROBES, self.count(list(PROBES)), strict=True) if n != len(library.encode(p))]
        if wrong:
            raise ValueError(f"the model treats {wrong[0]!r} otherwise")

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of joining neighbours; _NONE where they don't join."""
        key = left.astype(np.int64) * self.width + right
        key[(left < 0) | (right < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.made_rank[at], _NONE), self.made[at]

    def merge(self, words: list[str]) -> np.ndarray:
        """Tokens of each non-empty pre-token."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbol = self.char[points]
        weight = np.where(
            self.is_piece[symbol], 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
        )
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbol), _NONE, dtype=np.int32)
        into = np.zeros(len(symbol), dtype=np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], into[inner] = self.pair(symbol[inner], symbol[inner + 1])
        out = np.zeros(len(words), dtype=np.int64)
        while len(word):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            each = np.repeat(best, np.diff(starts, append=len(word)))
            if (done := each == _NONE).any():
                out += np.bincount(word[done], weights=weight[done], minlength=len(words)).astype(np.int64)
                going = ~done
                word, symbol, weight, rank, into, each = (x[going] for x in (word, symbol, weight, rank, into, each))
                if not len(word):
                    break
            if (tied := self.shared[each]).any():
                starts = np.flatnonzero(tied & (np.diff(word, prepend=-1) != 0))
                ends = np.searchsorted(word, word[starts], side="right")
                for i, j in zip(starts.tolist(), ends.tolist(), strict=True):
                    out[word[i]] += self.in_turn(symbol[i:j].tolist(), weight[i:j].tolist())
                word, symbol, weight, rank, into, each = (x[~tied] for x in (word, symbol, weight, rank, into, each))
                if not len(word):
                    break
            chosen = np.flatnonzero(rank == each)
            # Of pairs that overlap, every other one, counted from the left.
            fresh = np.diff(chosen, prepend=-2) > 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
            if (doubtful := self.doubtful[rank[chosen]]).any():
                chosen = chosen[self.until_better(chosen, doubtful, word, symbol, rank, into)]
            symbol[chosen], weight[chosen] = into[chosen], 1
            keep = np.ones(len(word), dtype=bool)
            keep[chosen + 1] = False
            place = np.cumsum(keep) - 1
            word, symbol, weight, rank, into = (x[keep] for x in (word, symbol, weight, rank, into))
            chosen = place[chosen]
            touched = np.unique(np.concatenate([chosen, chosen - 1]))
            touched = touched[touched >= 0]
            last = np.append(word[1:] != word[:-1], True)[touched]
            rank[touched[last]] = _NONE
            touched = touched[~last]
            rank[touched], into[touched] = self.pair(symbol[touched], symbol[touched + 1])
        return out

    def in_turn(self, symbol: list[int], weight: list[int]) -> int:
        """The count of one sequence whose best pairs make different pieces of one rank: merged one at a time."""
        n, get, width = len(symbol), self.joined.get, self.width
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and min(symbol[i], symbol[j]) >= 0 and (hit := get(symbol[i] * width + symbol[j])):
                heappush(heap, (hit[0], i, hit[1], symbol[i], symbol[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, new, left, right = heappop(heap)
            j = after[i]
            if j >= n or symbol[i] != left or symbol[j] != right:
                continue
            symbol[i], symbol[j], weight[i], weight[j] = new, -2, 1, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i, after[i])
            offer(before[i], i)
        return sum(weight)

    def until_better(self, chosen, doubtful, word, symbol, rank, into) -> np.ndarray:
        """Which of the merges go ahead: in each sequence those up to the first that makes a pair of better rank."""
        at, last = chosen[doubtful], len(word) - 1
        own, new = rank[at], into[at]
        right, left = np.minimum(at + 2, last), np.maximum(at - 1, 0)
        after, _ = self.pair(new, symbol[right])
        follows = np.isin(at - 2, at)  # the neighbour on the left has just been merged too
        before, _ = self.pair(np.where(follows, into[np.maximum(at - 2, 0)], symbol[left]), new)
        after[(at + 2 > last) | (word[right] != word[at])] = _NONE
        before[(at < 1) | (word[left] != word[at])] = _NONE
        stop = np.zeros(len(chosen), dtype=bool)
        stop[doubtful] = np.minimum(after, before) <= own
        # Merges after a stop in the same sequence wait.
        stopped = np.cumsum(stop) - stop
        first = np.flatnonzero(np.diff(word[chosen], prepend=-1))
        return stopped == np.repeat(stopped[first], np.diff(first, append=len(chosen)))

    def remember(self, table: dict[str, int], words: set[str], lead: str) -> list[str]:
        """Put the words, each led by `lead`, into the table; those too long to stay there are returned."""
        new = sorted(words.difference(table), key=len)
        first = size = 0
        for k, w in enumerate(new):
            size += len(w) + len(lead)
            if size >= TOGETHER or k == len(new) - 1:
                part = new[first : k + 1]
                table.update(zip(part, self.merge([lead + x for x in part]).tolist(), strict=True))
                first, size = k + 1, 0
        return [w for w in new if len(w) > REMEMBERED_CHARS]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, as the library's encode() would give."""
        for table in (self.led, self.bare):
            if len(table) > REMEMBERED:
                table.clear()
        self.led[""] = self.bare[""] = 0
        plans = []
        for text in texts:
            if not text:
                plans.append((0, [], []))
            elif _ODD(text):
                plans.append((0, [], _APART(SPACE + text.replace(" ", SPACE))))
            elif self.feed_apart:
                lines = [line.split(" ") for line in text.split("\n")]
                # The sign in front of a text stands alone where a line feed follows at once.
                alone = not lines[0][0]
                extra = len(lines) - 1 + alone + sum(1 for x in lines for w in x[1:] if not w)
                heads = [x[0] for x in lines[1:]]
                plans.append((extra, [lines[0][0], *(w for x in lines for w in x[1:])], heads))
            else:
                plans.append((0, text.split(" "), []))
        late = self.remember(self.led, set().union(*(led for _, led, _ in plans)), SPACE)
        late_bare = self.remember(self.bare, set().union(*(bare for _, _, bare in plans)), "")
        led, bare = self.led.__getitem__, self.bare.__getitem__
        out = [n + sum(map(led, a)) + sum(map(bare, b)) for n, a, b in plans]
        for w in late:
            del self.led[w]
        for w in late_bare:
            del self.bare[w]
        return out


def _model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def counter(spark, path: str):
    """A function Column -> Column: the tokens of a text column (null gives null). The driver reads the model and
    broadcasts it (a fixed file)."""
    model = _model(path)
    name, sent = hashlib.sha256(model).hexdigest(), spark.sparkContext.broadcast(model)

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        own = kept(f"pieces {name}", partial(PieceCounter, sent.value))
        given = texts.to_pylist()
        done = iter(own.count([t for t in given if t is not None]))
        return pa.array([None if t is None else next(done) for t in given], type=pa.int64())

    return tokens


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """Add `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens) of each whole text.

    Row by row, without a shuffle: repeated rows give repeated results, an empty table an empty one. A null text counts
    as empty: 0 bytes, 0 tokens. Other columns stay; those of the three names are replaced.
    """
    counted = without(docs, [x for x in ("n_bytes", "n_tokens", "over_limit") if x != text])
    counted = counted.withColumn("n_bytes", F.octet_length(text_of(text)).cast("long"))
    counted = counted.withColumn("n_tokens", counter(docs.sparkSession, path)(text_of(text)))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
