"""Near-duplicate classes by weighted minhash: signatures, bands, and verified multiset overlap.

A document is the multiset of its word shingles. Its BagMinHash signature comes from Poisson processes: each shingle has
one per weight interval [0, 1), [1, 2), [2, 4), ..., and each point of a process has a time, a slot of the signature and
one of the interval's units of weight, all equally likely. A slot holds the earliest point whose unit the shingle's count
reaches, so two documents agree in a slot with the probability of their weighted Jaccard similarity. Processes run only
until every slot is filled.

Equal texts are one node. Nodes that share a band are a group of candidates. Every member is compared with its group's
leader, so a group of n near copies costs n comparisons, not their square. Members that are not in their leader's class
then go through an exact prefix filter against all members of such groups: no link between candidates is lost, and what
a group shares but is too little for a link, such as a common passage, brings no pairs. Classes are connected components.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from icuflow.llm.common import looked_up, text_of, without, written

BANDS, ROWS = 24, 6
#: Holders of an element that are met at once.
HOLDERS = 256
_U64 = np.uint64
_GOLD = _U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Hashes of the runs of `words` lower-cased words; a shorter text that has words is one run."""
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, text.lower().split()), dtype=np.uint64)
    n = min(words, len(own))
    if not n:
        return own
    total = np.full(len(own) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        total = total * _GOLD + mix(own[k : len(own) - n + 1 + k])
    return mix(total)


def multiset(text: str, words: int) -> np.ndarray:
    """The shingles with their occurrences numbered, so that common elements of two sorted arrays are the overlap."""
    found = np.sort(shingles(text, words))
    if not len(found):
        return found
    starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    place = np.arange(len(found)) - np.repeat(starts, np.diff(starts, append=len(found)))
    return np.sort(mix(found + place.astype(np.uint64) * _GOLD))


def signature(elements: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """The earliest time in each slot."""
    until = (np.log(slots) + 2) / counts.sum()
    while True:
        out = np.full(slots, np.inf)
        start, width = 0, 1
        while (reach := counts > start).any():
            _points(out, elements[reach], counts[reach], start, width, until)
            start, width = start + width, max(1, start + width)
        if out.max() <= until:
            return out
        until *= 2


def _points(out: np.ndarray, elements: np.ndarray, counts: np.ndarray, start: int, width: int, until: float) -> None:
    """Enter the points up to time `until` of the processes on the weights from `start` to `start + width`."""
    slots = len(out)
    seed = mix(elements + _U64((width + (start > 0)) * 0xD6E8FEB86659FD93 % (1 << 64)))
    time, number = np.zeros(len(seed)), 0
    while len(seed):
        # Some points of each process at a time: many where there are few processes.
        some = max(1, 2 * slots // len(seed))
        drawn = mix(seed[:, None] + np.arange(number, number + some, dtype=np.uint64) * _GOLD)
        share = ((drawn >> _U64(11)).astype(np.float64) + 1) / (1 << 53)
        # One sum from the first point on, so that its last bits do not depend on how many points come at a time.
        times = np.cumsum(np.hstack([time[:, None], -np.log(share) / (slots * width)]), axis=1)[:, 1:]
        place = mix(drawn ^ _GOLD)
        unit = start + (place >> _U64(32)).astype(np.int64) % width
        there = (times <= until) & (unit < counts[:, None])
        np.minimum.at(out, (place[there] & _U64(0xFFFFFFFF)).astype(np.int64) % slots, times[there])
        going = times[:, -1] <= until
        seed, counts, time, number = seed[going], counts[going], times[going, -1], number + some


def bands(text: str, words: int, number: int, rows: int) -> tuple[int, list[int]]:
    """A text's shingles counted, and one key for each band of its signature (none for a text without words)."""
    found = shingles(text, words)
    if not len(found):
        return 0, []
    elements, counts = np.unique(found, return_counts=True)
    slots = signature(elements, counts, number * rows).view(np.uint64).reshape(number, rows)
    key = np.arange(number, dtype=np.uint64)
    for k in range(rows):
        key = mix(key * _GOLD + slots[:, k])
    return len(found), key.view(np.int64).tolist()


def _bands(words: int, number: int, rows: int):
    kind = pa.struct([("weight", pa.int64()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<weight: long, bands: array<long>>")
    def made(texts: pa.Array) -> pa.Array:
        own = [bands(t, words, number, rows) for t in texts.to_pylist()]
        return pa.array([{"weight": w, "bands": b} for w, b in own], type=kind)

    return made


def _multisets(words: int):
    @F.arrow_udf("binary")
    def made(texts: pa.Array) -> pa.Array:
        return pa.array([multiset(t, words).tobytes() for t in texts.to_pylist()], type=pa.binary())

    return made


def _similarity():
    @F.arrow_udf("double")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
            a, b = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
            both = np.concatenate([a, b])
            both.sort(kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            out.append(common / (len(a) + len(b) - common))
        return pa.array(out, type=pa.float64())

    return similar


def components(links: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node reached) for every node of the links (a, b).

    Links are drawn to the smallest neighbour, from the larger ones and then from the smaller ones, until each node is
    linked to its root alone. Every pass is written to the shared folder.
    """

    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("links"))

    def drawn(edges: DataFrame) -> DataFrame:
        return edges.where(F.col("a") != F.col("b")).distinct()

    edges = written(drawn(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    known = None
    while True:
        count = edges.count()
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        # A node with very many links is broadcast to them.
        low = smallest(both).select("u", F.least("u", "m").alias("m"), "links")
        met = looked_up(both.where(F.col("v") > F.col("u")), low, "u", "links", 2 * count, "inner")
        large = written(drawn(met.select(F.col("v").alias("a"), F.col("m").alias("b"))))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        near = smallest(down)
        edges = written(
            drawn(
                looked_up(down, near, "u", "links", large.count(), "inner")
                .select(F.col("v").alias("a"), F.col("m").alias("b"))
                .unionByName(near.select(F.col("u").alias("a"), F.col("m").alias("b")))
            )
        )
        # Two passes alike in number and sum of hashes are the same set.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        known = now


def _compared(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Columns a, b and `similar`, the similarity of their multisets, for the pairs (a, b) that could reach `least`."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    # Sizes alone rule out pairs before any set is moved.
    both = pairs.where(F.least("w_a", "w_b") >= F.lit(least) * F.greatest("w_a", "w_b")).select("a", "b").distinct()
    both = both.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", _similarity()("set_a", "set_b").alias("similar"))


def _resolve(member: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """`node` and `root` of the nodes that are linked to another, from the groups (band, key) of candidate nodes.

    A group's leader is the member that shares most bands with others; all members are compared with it. What that
    leaves open goes through `_rest`.
    """
    group = ["band", "key"]
    order = F.struct((-F.col("central")).alias("rank"), "node")
    lead = member.groupBy(*group).agg(F.min(F.struct(order.alias("order"), "weight")).alias("lead"))
    lead = written(lead.select(*group, F.col("lead.order.node").alias("b"), F.col("lead.weight").alias("w_b")))
    own = (F.col("node").alias("a"), F.col("weight").alias("w_a"))
    pairs = member.select(*group, *own).join(lead, group).where(F.col("a") != F.col("b"))
    links = written(_compared(pairs, sets, least).where(F.col("similar") >= least).select("a", "b"))
    root = components(links)
    placed = member.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    home = lead.join(root.withColumnRenamed("node", "b"), "b", "left").select(*group, F.coalesce("root", "b").alias("home"))
    # Members outside their leader's class may be linked to one another, or to others than the leader. A group of two
    # has nothing left to compare.
    out = placed.join(home, group).where(F.col("root") != F.col("home")).where(F.col("n") > 2)
    out = written(out.select(*group, "node").distinct())
    if out.isEmpty():
        return root
    near = placed.join(out.select(*group).distinct(), group, "left_semi").select("node", "root", "weight").distinct()
    near = written(near.join(out.select("node", F.lit(True).alias("open")).distinct(), "node", "left"))
    rest = _rest(near, sets, least)
    return root if rest.isEmpty() else components(links.unionByName(rest))


def _rest(near: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Every link (a, b) between an open node and a node of another root, by prefix filtering, which is exact.

    Two sets that are `least` similar share that part of either, so they also share one of the elements that come first
    in either set, if as many come first as can be missing, and one more. The rarest elements come first: what very many
    nodes share, such as a common passage, is at the end and brings no two nodes together. Elements that come first under
    one root alone, such as what a large cluster has in common, are left out before any join; of the others those with many
    holders are met in parts.
    """

    @F.arrow_udf("array<long>")
    def numbers(packed: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(p, dtype=np.int64) for p in packed.to_pylist()], type=pa.list_(pa.int64()))

    element = near.join(sets, "node").select("node", F.explode(numbers("set")).alias("element"))
    element = written(element)
    often = element.groupBy("element").agg(F.count(F.lit(1)).alias("often")).where(F.col("often") > 1)
    # An element of one node comes first too, but brings nothing together: only its place counts.
    placed = element.join(often, "element", "left").join(near, "node")
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.col("often").asc_nulls_first(), "element"))
    missing = F.col("weight") - F.ceil(F.col("weight") * F.lit(least) - 1e-9)
    prefix = placed.withColumn("place", first).where((F.col("place") <= missing + 1) & F.col("often").isNotNull())
    names = ("node", "root", "weight", "open", "place")
    prefix = written(prefix.select("element", *names))
    mixed = prefix.groupBy("element").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("holders"), F.count("open").alias("asking")
    )
    mixed = written(mixed.where((F.col("low") != F.col("high")) & (F.col("asking") > 0)).select("element", "holders"))
    held = looked_up(prefix, mixed, "element", "holders", prefix.count(), "inner")
    # One side of an element with many holders is dealt over parts, the other goes to each of them.
    parts = F.ceil(F.col("holders") / F.lit(HOLDERS)).cast("int")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in names]
    asking = held.where("open").select("element", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), *side("a"))
    there = held.select("element", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), *side("b"))
    both = asking.join(there, ["element", "part"])
    # If this is the first common element, what follows it in the shorter rest is all that can be common.
    needed = F.lit(least / (1 + least)) * (F.col("weight_a") + F.col("weight_b"))
    left = F.least(F.col("weight_a") - F.col("place_a"), F.col("weight_b") - F.col("place_b")) + 1
    size = left >= needed - 1e-9
    # A pair of open nodes comes from both sides; one is enough.
    once = F.col("open_b").isNull() | (F.col("node_a") < F.col("node_b"))
    pairs = both.where((F.col("root_a") != F.col("root_b")) & once & size).select(
        F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.col("weight_a").alias("w_a"), F.col("weight_b").alias("w_b")
    )
    return written(_compared(pairs, sets, least).where(F.col("similar") >= least).select("a", "b"))


def classes(
    docs: DataFrame, similarity: float = 0.8, words: int = 5, number: int = BANDS, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per row of `docs`: its id and `class_id`, the smallest id of the documents it is a near copy of, through
    any chain of links.

    Equal texts are copies, also those without words. Null texts count as empty. Rows without an id are in their text's
    class, whose id is null only if none of its documents has one. Repeated rows are repeated. An empty table gives an
    empty one. Words are what white space parts, in lower case; a text of fewer words than a shingle is one shingle.
    Counted multisets of shingles are compared, and two documents are linked at `similarity` or more.
    """
    signed, named = _classed(docs, similarity, words, number, rows, text, doc_id)
    # A text that very many rows share is broadcast to them.
    found = looked_up(signed, written(named), "node", "copies", signed.count(), "inner")
    return found.select(F.col("_id").alias(doc_id), "class_id")


def firsts(
    docs: DataFrame, similarity: float = 0.8, words: int = 5, number: int = BANDS, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row of `docs` for each class: that of the smallest id, of rows that share this id that of the smallest hash, and
    one of repeated rows. In a class without ids it is a row of the smallest hash."""
    signed, named = _classed(docs, similarity, words, number, rows, text, doc_id)
    key = ["_key", "node"]
    row = signed.withColumn("_key", F.coalesce("_id", F.lit(-(2**63)))).groupBy(*key, F.col("_id").isNull().alias("_none"))
    row = row.agg(F.count(F.lit(1)).alias("_n")).groupBy("node").agg(F.min(F.struct("_none", *key, "_n")).alias("best"))
    best = row.join(named, "node").groupBy("root").agg(F.min("best").alias("best"))
    best = written(best.select("best._none", *[f"best.{c}" for c in key], "best._n"))
    own = docs.withColumn("_key", F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))))
    own = own.withColumn("_none", F.col(doc_id).isNull()).withColumn("node", F.unhex(F.md5(text_of(text))))
    found = own.join(best, [*key, "_none"])
    # Only rows that are repeated are brought together, and no more than one of each leaves a task.
    again = found.where(F.col("_n") > 1).dropDuplicates([*key, "_none"])
    return found.where(F.col("_n") == 1).unionByName(again).select(docs.columns)


def _classed(docs: DataFrame, similarity: float, words: int, number: int, rows: int, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """`_id` and `node` of every row; `node`, `root` and `class_id` of every text."""
    given = docs.select(F.col(doc_id).cast("long").alias("_id"), text_of(text).alias("_text"))
    given = given.withColumn("node", F.unhex(F.md5("_text")))
    signed = written(
        given.withColumn("_signed", _bands(words, number, rows)(F.col("_text"))).select("_id", "node", "_signed.*")
    )
    nodes = signed.groupBy("node").agg(
        F.min("_id").alias("least"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies")
    )
    member = nodes.select("node", "least", "weight", F.posexplode("bands").alias("band", "key"))
    shared = member.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    member = written(member.join(shared, ["band", "key"]))
    # How many candidates a node has, counted once for each band that they share.
    central = member.groupBy("node").agg(F.sum("n").alias("central"))
    member = written(member.join(central, "node"))
    wanted = member.select("node", F.col("least").alias("_id")).distinct()
    # A node's text comes from one of its rows, so copies are not brought together.
    here = [F.col("node"), F.coalesce("_id", F.lit(-(2**63))).alias("_key")]
    texts = given.select(*here, "_text").join(wanted.select(*here), ["node", "_key"], "left_semi")
    sets = written(texts.select("node", _multisets(words)("_text").alias("set")).dropDuplicates(["node"]))
    root = _resolve(member, sets, similarity)
    classed = (
        nodes.select("node", "least", "copies")
        .join(root, "node", "left")
        .select("node", "least", "copies", F.coalesce("root", "node").alias("root"))
    )
    smallest = classed.groupBy("root").agg(F.min("least").alias("class_id"))
    return signed.select("_id", "node"), classed.join(smallest, "root").select("node", "root", "class_id", "copies")
