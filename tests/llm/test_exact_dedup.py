"""Exact dedup against brute force: odd rows, hot and cold groups, an index that is opened again."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from icuflow.llm import exact_dedup, queries
from icuflow.llm.exact_dedup import DigestIndex, dedupe

KIND = "doc_id long, text string, digest string, kept int"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    """(id, keep_id, group_size) of every row, and the rows that stay, by text."""
    groups = defaultdict(list)
    for key, text in rows:
        groups[normal(text)].append(key)
    first = {t: min((k for k in ids if k is not None), default=None) for t, ids in groups.items()}
    each = sorted(((k, first[normal(t)], len(groups[normal(t)])) for k, t in rows), key=repr)
    return each, sorted(first.values(), key=repr)


def given(spark, rows):
    return spark.createDataFrame([(k, t, "clash", 0) for k, t in rows], KIND)


ODD = [
    (1, "a b"), (2, "a  b"), (3, "a\n\t b"), (4, " a b"), (5, "a b "), (6, None), (7, ""), (8, " "), (9, "\n\n"), (9, "\n\n"),
    (10, "A b"), (11, "a\x85b"), (12, "a\xa0b"), (13, "x" * 2_000_000), (14, "x" * 2_000_000), (None, "a b"), (None, "lone"),
    (None, "lone"), (15, "same id, one"), (15, "same id, two"), (16, "é  中"), (17, "é\x0b中"), (18, "é\x1c中"),
]


@pytest.mark.parametrize("hot_part", [0.0, 1.0])
def test_odd_rows_by_either_join(spark, hot_part, monkeypatch):
    monkeypatch.setattr(DigestIndex.resolve, "__defaults__", (hot_part,))
    got = dedupe(given(spark, ODD)).collect()
    each, stay = expected(ODD)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == each
    assert sorted((r["doc_id"] for r in got if r["kept"]), key=repr) == stay
    digest = {(r["doc_id"], bytes(r["digest"])) for r in got}
    assert digest == {(k, hashlib.sha256(normal(t).encode()).digest()) for k, t in ODD}


def test_empty_table(spark):
    assert dedupe(given(spark, [])).collect() == []


def test_a_third_of_all_rows_alike(spark):
    draw = random.Random(5)
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {draw.randrange(300)}") for i in range(3000)]
    draw.shuffle(rows)
    got = dedupe(given(spark, rows).repartition(7)).collect()
    each, stay = expected(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == each
    assert sorted((r["doc_id"] for r in got if r["kept"]), key=repr) == stay


def test_an_index_is_opened_again_and_grows(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = dedupe(given(spark, [(5, "a"), (6, "b"), (7, "b")]), DigestIndex(spark, path, 3))
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in first.collect()} == {(5, 5, True), (6, 6, True), (7, 6, False)}
    again = DigestIndex(spark, path, 3)
    later = dedupe(given(spark, [(1, "a"), (2, "c"), (3, "c"), (9, "b")]), again)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in later.collect()}
    # What the index has stays, although smaller ids come later.
    assert got == {1: (5, 2, False), 2: (2, 2, True), 3: (2, 2, False), 9: (6, 3, False)}
    assert again.kept.count() == 3


def test_the_anti_join_moves_neither_side(spark):
    index = DigestIndex(spark, buckets=4)
    index.append(exact_dedup.digests(given(spark, ODD)))
    new = index.seen.drop("n", "batch").join(index.kept.select("digest").hint("merge"), "digest", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op13_exact_dedup(spark, folder)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = found.collect()
    each, stay = expected(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == each
    assert sorted((r["doc_id"] for r in got if r["kept"]), key=repr) == stay
    text = dict(rows)
    assert all(r["text_sha256"] == hashlib.sha256(normal(text[r["doc_id"]]).encode()).hexdigest() for r in got)
    assert found.where(F.col("kept") != (F.col("doc_id") == F.col("keep_id"))).count() == 0
