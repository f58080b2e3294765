"""The pipeline's stages, each against brute force on its own input."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from icuflow.llm import secrets
from test_corpus import brute_classes, spans_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "docs")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    for _, _, after in stages[:-1]:
        assert after.columns == corpus_pipeline.COLUMNS
        assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_quality_keeps_the_good(spark, stages):
    _, before, after = stages[0]
    kept = texts(after)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in texts(before) if labels.get(i) == 1]
    assert all(i in kept for i in good)
    bad = [i for i in texts(before) if labels.get(i) == 0]
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_lines(stages):
    _, before, after = stages[1]
    docs = texts(before)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for i, t in docs.items():
        for x in {key(x) for x in t.split("\n")}:
            held.setdefault(x, []).append(i)
    gone = {x: max(own) for x, own in held.items() if len(x) >= 40 and len(own) >= 5}
    assert texts(after) == {
        i: "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i) for i, t in docs.items()
    }


def test_near_copies(stages):
    _, before, after = stages[2]
    docs = texts(before)
    assert texts(after) == {i: docs[i] for i, c in brute_classes(docs).items() if i == c}


def test_secrets(stages):
    _, before, after = stages[3]
    left = texts(after)
    assert left.keys() == texts(before).keys()
    for i, t in texts(before).items():
        marked = list(t)
        for start, end, _ in spans_of(t):
            marked[start:end] = "\0" * (end - start)
        assert left[i] == re.sub("\0+", "[secret]", "".join(marked))
    assert secrets.scan(after).where("size(secrets) > 0").count() == 0


def test_packing(spark, stages):
    _, before, after = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = after.collect()
    for i, t in texts(before).items():
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_near_copies_of_shared_and_missing_ids(spark):
    base = [f"w{i}" for i in range(80)]
    near, clean = " ".join([*base[:79], "x"]), " ".join(f"v{i}" for i in range(80))
    alone = " ".join(f"u{i}" for i in range(80))
    rows = [(1, " ".join(base)), (5, near), (5, clean), (None, near), (None, alone), (None, alone), (7, "same"), (7, "same"), (8, "same")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == corpus_pipeline.COLUMNS
    left = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert left == sorted([(1, " ".join(base)), (5, clean), (None, alone), (7, "same")], key=repr)


PROSE = "The committee met on Tuesday to discuss the plan for the old harbour, and most of the members agreed with it. "
SECRET = "password: abcdefgh12345678"
ODD = [
    (1, None), (2, ""), (2, ""), (3, " \n\n"), (4, PROSE * 4), (4, PROSE * 4), (None, PROSE * 4), (5, PROSE * 4 + "x"), (6, "é中\U0001f600\x00"),
    (7, f"{SECRET}\nno secret"), (None, SECRET), (8, "\n".join(["one line that very many documents share, word for word"] * 3)),
    *[(i, f"one line that very many documents share, word for word\nand a line of document {i}") for i in range(9, 16)],
    (16, "word " * 200_000), (16, "another text of the same id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents, with extra columns whose names stages and operators use for their own."""
    rows = [(i, t, "en", "web", 0, "clash", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, secrets int")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_documents_and_none(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, odd, SF)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert last or got.columns == corpus_pipeline.COLUMNS
    rows = got.collect()
    ids = sorted((r["doc_id"] for r in rows), key=repr)
    every = sorted((i for i, _ in ODD), key=repr)
    if name == "quality classifier":
        assert not {1, 2, 3} & set(ids) and len(ids) <= len(every)
        # Copies meet one fate, whatever their ids.
        assert ids.count(4) in (0, 2) and (None in ids) >= (4 in ids)
    elif name == "line dedup":
        assert ids == every and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in rows)
        left = {r["doc_id"]: r["text"] for r in rows}
        assert left[9] == "and a line of document 9" and left[15].startswith("one line") and left[8] == "" and left[1] == ""
    elif name == "minhash near-dedup":
        texts = [r["text"] or "" for r in rows]
        assert len(set(texts)) == len(texts) and ids.count(4) == 1 and 5 not in ids and ids.count(16) == 2
        assert min(i for i, t in ODD if not t) in ids and 2 not in ids
    elif name == "secret scan":
        assert ids == every
        left = {r["doc_id"]: r["text"] for r in rows}
        assert left[7] == "[secret]\nno secret" and left[1] == left[2] == "" and left[16] is not None
    else:
        assert sorted({i for i in ids if i is not None}) == sorted({i for i, _ in ODD if i is not None})
        assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1 and sum(r["length"] for r in rows if r["doc_id"] == 2) == 2
        used = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
        assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(used, used[1:], strict=False))
    assert stage(spark, odd.where("false"), SF).count() == 0
