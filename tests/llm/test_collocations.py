"""Collocations against brute force: many shards and ranges, odd rows, exact scores; the automata by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from icuflow.llm import collocations, queries
from icuflow.llm.collocations import Grams, borders, counted, from_counts, mine, parts, spelled, transducer, united

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, most=3, inside=50, first=2000):
    counts, out = {}, []
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, most + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        hidden = set()
        for g, c in candidates.items():
            for size in range(2, len(g)):
                for i in range(len(g) - size + 1):
                    if 100 * c >= inside * f[g[i : i + size]]:
                        hidden.add(g[i : i + size])
        found = []
        for g, a in candidates.items():
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            if g not in hidden:
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def prose(draw, n, words=60):
    """Text of few words, some of them much more frequent than others."""
    out = []
    for _ in range(n):
        out.append(f"W{int(draw.paretovariate(0.6)) % words}" + draw.choice(["", "", "", "", "", ",", ".", "\n", "\t"]))
    return " ".join(out)


@pytest.mark.parametrize(("shard", "span", "most"), [(3_000_000, 2_000_000, 3), (900, 400, 3), (300, 60, 3), (900, 100, 2), (900, 150, 5)])
def test_any_number_of_shards_and_ranges(spark, shard, span, most):
    draw = random.Random(span)
    rows = [(prose(draw, draw.randint(0, 90)), draw.choice(["en", "en", "en", "de", None])) for _ in range(300)]
    # A third of all rows are one text; another passage is very frequent too.
    rows += [("the hot passage of them all. the hot passage", "en")] * 150
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    assert got(mine(docs, 10, most, shard=shard, span=span)) == brute(rows, 10, most)


ODD = [
    "", None, " \t ", ".,;:!?", "one", "a b", "A b.", "a\x0bb\x0cc\rd", "é 中 é 中", "É é", "x\x00y x\x00y", "a\x85b a\xa0b", "a a a a a a a a",
    "w " * 400_000, "v" * 3_000_000, " ".join(f"u{i % 700}" for i in range(200_000)),
]


def test_odd_rows(spark):
    rows = [(t, lang) for t in ODD for lang in ("en", None, "und")] + [(ODD[5], "en")] * 12 + [(ODD[8], "fr")] * 11
    docs = spark.createDataFrame([(t, g, "clash", 1) for t, g in rows], "text string, lang string, phrase string, n int")
    assert got(mine(docs)) == brute(rows)
    assert got(mine(docs, 2, 3, 100, 7, shard=100, span=80)) == brute(rows, 2, 3, 100, 7)
    assert mine(docs.where("false")).collect() == []
    assert mine(docs.where("text = ''")).collect() == []


def test_scores_beyond_64_bits(spark):
    rows = [("en", 3, 4 * 10**12, [9 * 10**12, 5 * 10**12, 4 * 10**12], [8 * 10**12, 7 * 10**12, 4 * 10**12])]
    df = spark.createDataFrame(rows, "lang string, size int, a long, first array<long>, last array<long>")
    cut = df.selectExpr(f"{collocations._LOWEST} AS c").select("c.*").first()
    want = min((10**6 * rows[0][2] ** 2 // (rows[0][3][k - 1] * rows[0][4][2 - k]), k) for k in (1, 2))
    assert (cut["score"], cut["k"]) == want


def listed(grams: Grams):
    return {grams.phrase(d, k): int(w) for d, weights in enumerate(grams.weights) for k, w in enumerate(weights.tolist())}


def sample(seed, n=4000):
    draw = random.Random(seed)
    return np.array([min(40, int(draw.paretovariate(0.8))) - 2 for _ in range(n)], dtype=np.int64), [f"w{k * 7919 % 100}".encode() for k in range(40)]


def test_transducers_keep_and_sum_counts():
    shards = [counted(*sample(s), 3) for s in range(4)]
    for grams in shards:
        assert listed(spelled(transducer(grams))) == listed(grams)
        keys = [grams.phrase(d, k) for d in range(3) for k in range(len(grams.labels[d]))]
        for d in range(3):
            own = [grams.phrase(d, k) for k in range(len(grams.labels[d]))]
            assert own == sorted(own) and len(set(own)) == len(own)
        assert len(set(keys)) == len(grams)
    total = Counter()
    for grams in shards:
        total.update(listed(grams))
    assert listed(united([spelled(transducer(g)) for g in shards])) == total
    empty = counted(np.zeros(0, dtype=np.int64), [], 3)
    assert listed(spelled(transducer(empty))) == {} and listed(united([empty, empty])) == {}


def test_equal_states_are_shared():
    rows = [((f"a{i}".encode(), b"x", b"y"), 5) for i in range(500)] + [((f"a{i}".encode(), b"x"), 9) for i in range(500)]
    grams = from_counts(rows, 3)
    # One state behind every first word, one behind every second: three arcs beside those of the root.
    packed = transducer(grams)
    sizes = np.frombuffer(packed, "<i8", 2 * 12, 24).reshape(12, 2)[:, 1]
    assert sizes.tolist() == [1, 500, 500, 500, 1, 1, 1, 1, 1, 1, 1, 1]
    assert listed(spelled(packed)) == listed(grams)


def test_ranges_hold_every_gram_once_and_the_prefixes_of_their_key():
    draw = random.Random(4)
    grams = counted(*sample(9), 3)
    every = listed(grams)
    absent = [(b"w1", b"zz"), (b"w0a",), (b"zzz",), (b"",), (b"w14", b"w14", b"w0"), (b"w19", b"a", b"b")]
    keys = sorted({*draw.sample(sorted(every), 25), *absent})
    found = {}
    for number, part in parts(grams, keys):
        low = keys[number - 1] if number else ()
        cut = borders(part, low)[0] if number else [0, 0, 0]
        for d, weights in enumerate(part.weights):
            for k, w in enumerate(weights.tolist()):
                gram = part.phrase(d, k)
                assert every[gram] == w
                if k >= cut[d]:
                    assert gram not in found and gram >= low and (number == len(keys) or gram < keys[number])
                    found[gram] = w
                else:
                    assert gram == low[: len(gram)]
        assert all(low[:n] in listed(part) for n in range(1, len(low)) if low[:n] in every)
    assert found == every


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()]
    found = queries.op11_collocations(spark, SF)
    assert got(found) == brute(rows)
    assert all(kind == "bigint" for name, kind in found.dtypes if name not in ("lang", "phrase"))
