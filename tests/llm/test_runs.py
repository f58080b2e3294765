"""Periodic runs against brute force: random words, nested repeats, odd rows, very long texts."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from icuflow.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute(words, least=24):
    """(start, length, period) of every run, one period after the other."""
    n, best = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 3 * q):
                best.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(draw):
    n, k = draw.randint(0, 260), draw.choice([1, 2, 3, 4, 30])
    words = [draw.randrange(k) for _ in range(n)]
    for _ in range(draw.randint(0, 3) if n else 0):
        a, p = draw.randrange(n), draw.randint(1, max(1, n // 3))
        part = words[a : a + p]
        words = words[:a] + (part * 8)[: int(len(part) * draw.uniform(2.5, 6))] + words[a + p :]
    return words * draw.randint(1, 4) if draw.random() < 0.2 else words


@pytest.mark.parametrize("least", [24, 9, 1])
def test_random_words(least):
    draw = random.Random(least)
    documents = [repetitive(draw) for _ in range(250)]
    found = runs.find([np.array(d, dtype=np.int64) for d in documents], least)
    total = 0
    for words, rows in zip(documents, found, strict=True):
        assert [tuple(r) for r in rows.tolist()] == brute(words, least)
        total += len(rows)
    assert total > 300


def test_every_period_at_its_least_length():
    for q in (1, 2, 7, 8, 11, 12, 13, 15, 16, 23, 24, 25, 47, 48, 95, 96, 97, 191, 383, 384):
        unit = list(range(1000, 1000 + q))
        enough = max(24, 3 * q)
        words = [1, 2, 3] + (unit * 30)[:enough] + [4, 5] + (unit * 30)[: enough - 1] + [6]
        found = runs.find([np.array(words, dtype=np.int64)], 24)[0].tolist()
        assert found == [[3, enough, q]]


def test_words_that_repeat_only_in_parts():
    # Fibonacci words are full of runs of every Fibonacci period, none of which is long enough below three periods.
    a, b = [0], [0, 1]
    while len(b) < 2500:
        a, b = b, b + a
    inner = ([7, 7, 7, 8] * 5 + [9]) * 5
    for words in (b, b[:900] * 4, inner, [1] * 500 + inner * 3 + [1] * 500):
        found = runs.find([np.array(words, dtype=np.int64)], 24)[0]
        assert [tuple(r) for r in found.tolist()] == brute(words)


def test_a_synchronising_set_is_consistent_and_dense():
    draw = random.Random(2)
    words = np.array([draw.randrange(3) for _ in range(400)] + [1] * 200 + [draw.randrange(3) for _ in range(400)])
    words = np.concatenate([words, words])
    scale, ids = 1, runs._mixed(words.astype(np.uint64))
    while scale < 16:
        ids, scale = runs._doubled(ids, scale), 2 * scale
    known = np.concatenate([runs._stretches(words, q) for q in range(1, 12)])
    place = set(runs.selected(ids, runs._periodic(known, scale, len(ids)), scale).tolist())
    context = {}
    for i in range(len(words) - 2 * scale + 1):
        assert context.setdefault(tuple(words[i : i + 2 * scale]), i in place) == (i in place)
    for i in range(len(words) - 3 * scale):
        window = words[i : i + 3 * scale - 1]
        periodic = any((window[q:] == window[:-q]).all() for q in range(1, scale // 3 + 1))
        assert periodic == (not place & set(range(i, i + scale)))


ODD = [
    "", None, " ", "\n\t ", "one", "a " * 23, "a " * 24, "\ta\n" * 30, "a b\x0bc\x0c" * 9, "a\x85b\xa0c " * 30, "é 中 " * 20 + "x",
    "x" * 3_000_000, " ".join(f"w{i % 5000}" for i in range(400_000)), " ".join(["z"] * 300_000), "a b " * 13 + "a c " * 13,
]


def test_odd_rows(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(6, ODD[6], "clash", 1), (None, ODD[6], "clash", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, collapsed string, RUNS int")
    found = runs.detect(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        own = [(x["start"], x["length"], x["period"]) for x in r["runs"]]
        long = {12: [(0, 400_000, 5000)], 13: [(0, 300_000, 1)]}.get(r["doc_id"])
        assert own == (brute(words) if long is None else long)
        assert r["n_words"] == len(words) and r["collapsed"] == collapsed(words, own)
    assert runs.detect(docs.where("false")).count() == 0


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    got = queries.op12_periodic_runs(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        words = planted(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        found = brute(words)
        best = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == digest("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r["collapsed_sha256"] == digest(collapsed(words, found))


def test_query_on_odd_rows(spark):
    zero = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(zero[0], None), (zero[1], "one"), (zero[2], "a b c d " * 40), (1, "a b c d " * 40), (None, "a b " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = queries.run_digests(runs.detect(queries.made_periodic(docs))).collect()
    for r in got:
        text = {**dict(rows[:4]), None: rows[4][1]}[r["doc_id"]] or ""
        words = text.split() if r["doc_id"] is None else planted(r["doc_id"], text.split())
        found = brute(words)
        assert r["n_runs"] == len(found) and r["collapsed_sha256"] == digest(collapsed(words, found))
    kinds = dict(queries.run_digests(runs.detect(docs)).dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))
