"""Jaccard join of documents on word n-grams, by MinHash banding with exact verification.

Documents with equal n-gram sets form a class, and only one representative of a class goes on.
Representatives that share a band hash are candidates. The candidates of a pair are compared on
their full n-gram sets inside blocks of at most ``BLOCK`` documents, so no pair ever becomes a
row: a block gives per document the number of its links and one edge of a spanning forest.

Defined results: a null or word-free text is in a class of its own and has no link; a text with
fewer words than n has one n-gram, the whole text. Rows that share a doc_id count as one document
with several texts: each row gets the class of its own text, and an id counts once for each set it holds. A row with a null doc_id is not
compared (null class, no link). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, written
from telemill.llm.components import components
from telemill.llm.words import grams, mix, words_of
from telemill.operators.membership import pruned

BLOCK = 256
SEEDS = np.random.default_rng(7).integers(0, 1 << 64, (2, 4096), np.uint64)


def text_print(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text)


def choose_bands(threshold: float, recall: float, rows: int = 4) -> tuple[int, int]:
    """(bands, rows): the fewest bands that make a pair at the threshold a candidate with this probability."""
    bands = 1
    while 1 - (1 - threshold**rows) ** bands < recall:
        bands += 1
    return bands, rows


def ngram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    words = words_of(column)
    runs = grams(words.hashes, n)
    sets = []
    for begin, end in zip(words.offsets[:-1], words.offsets[1:]):
        count = end - begin
        sets.append(np.unique(runs[begin : end - n + 1]) if count >= n else grams(words.hashes[begin:end], count) if count else runs[:0])
    return sets


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A band hash per set and band; every set holds at least one n-gram."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    every, out = np.concatenate(sets), np.zeros((len(sets), bands), np.uint64)
    for band in range(bands):
        total = np.full(len(sets), band, np.uint64)
        for i in range(band * rows, band * rows + rows):
            total = mix(total + np.minimum.reduceat((every * (SEEDS[0, i] | np.uint64(1))) ^ SEEDS[1, i], starts))
        out[:, band] = total
    return out


def _sign(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        sets = ngram_sets(batch.column("text"), n)
        keep = [i for i, s in enumerate(sets) if len(s)]
        keys: list[bytes | None] = [None] * len(sets)
        hashes: list[np.ndarray | None] = [None] * len(sets)
        if keep:
            for i, bands_of in zip(keep, signatures([sets[i] for i in keep], bands, rows).view(np.int64)):
                keys[i], hashes[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), bands_of
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("print"), pa.array(keys, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
            ["doc_id", "print", "same", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        grams_of = [s.tobytes() for s in ngram_sets(batch.column("text"), n)]
        rest = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in rest), pa.array(grams_of, pa.binary())], [*rest, "grams"]
        )


def _compare(group: pa.Table, threshold: float) -> pa.Table:
    """Links between the nodes of two blocks, or within one block, that share a band."""
    ids = group.column("node").to_numpy()
    copies = group.column("copies").to_numpy()
    side = group.column("block").to_numpy() == group.column("low")[0].as_py()
    within = group.column("low")[0].as_py() == group.column("high")[0].as_py()
    sets = [np.frombuffer(s, np.uint64) for s in group.column("grams").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    bands = np.array(group.column("bands").to_pylist(), np.int64)
    left = np.flatnonzero(side)
    right = left if within else np.flatnonzero(~side)
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    if len(left) and len(right):
        every = np.concatenate([sets[i] for i in right])
        owner = np.repeat(np.arange(len(right)), sizes[right])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        for i in left:
            others = (bands[right] == bands[i]).any(axis=1)
            others &= right > i if within else True
            if not others.any():
                continue
            begin, end = np.searchsorted(every, sets[i]), np.searchsorted(every, sets[i], side="right")
            count = end - begin
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            shared = np.bincount(owner[at], minlength=len(right))
            linked = right[others & (shared >= threshold * (sizes[i] + sizes[right] - shared) - 1e-9)]
            links[i] += copies[linked].sum()
            links[linked] += copies[i]
            for j in linked:
                a, b = sorted((find(i), find(j)), key=lambda k: ids[k])
                root[b] = a
    hit = np.flatnonzero(links)
    return pa.table(
        {"node": pa.array(ids[hit], pa.int64()), "root": pa.array(ids[[find(i) for i in hit]], pa.int64()), "links": pa.array(links[hit], pa.int64())}
    )


def ngram_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) for each row of (doc_id, text).

    ``copy_of`` is the least id with the same n-gram set, ``class_id`` the least id that links
    lead to, ``n_links`` the number of other documents whose Jaccard index is at least the
    threshold. A pair at the threshold is found with probability ``recall``, others more surely.
    """
    found = joined(docs, n, threshold, recall)
    return found.select("doc_id", "class_id", "copy_of", "n_links")


def joined(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """The columns of ``ngram_join`` behind (print, same): the text's hash and the key of its n-gram set, which word-free texts lack."""
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("print", text_print(F.col("text")))
    signed = written(
        texts.mapInArrow(partial(_sign, n=n, bands=bands, rows=rows), "doc_id bigint, print bigint, same binary, bands array<bigint>"), "grams"
    )
    usable = signed.filter("doc_id IS NOT NULL AND same IS NOT NULL")
    classes = usable.groupBy("same").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"))
    reps = usable.join(classes, "same").filter("doc_id = rep").select("same", "rep", "print", "copies", "bands").dropDuplicates(["same"])
    # a set is a node, for an id may stand for several; the number of a stored row does not change when it is read again
    reps = written(reps.withColumn("node", F.monotonically_increasing_id()), "classes")

    banded = reps.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    near = components(banded.join(shared, "band").select(F.col("node").alias("u"), F.col("least").alias("v")), "near")
    near = written(near, "near")

    parts = near.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    members = (
        near.join(parts, "component")
        .join(reps, "node")
        .select(F.col("rep").alias("doc_id"), "print", "node", "component", "parts", "copies", "bands", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("block"))
    )
    members = written(members, "members")
    # texts of documents without a candidate are not shuffled, while the filter that tells them is small
    wanted = pruned(texts, members, "doc_id").join(members, ["doc_id", "print"]).dropDuplicates(["doc_id", "print"])
    schema = "node bigint, component bigint, parts int, copies bigint, bands array<bigint>, block int, grams binary"
    filled = wanted.select("node", "component", "parts", "copies", "bands", "block", "text").mapInArrow(partial(_sets, n=n), schema)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = filled.withColumn("other", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def compare(group: pa.Table) -> pa.Table:
        return _compare(group, threshold)

    blocked = dealt.drop("other", "parts").groupBy("component", "low", "high")
    compared = blocked.applyInArrow(compare, "node bigint, root bigint, links bigint")
    found = written(compared, "links")
    linked = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "linked")
    linked = linked.join(reps.select("node", "rep"), "node")
    linked = linked.join(linked.groupBy("component").agg(F.min("rep").alias("class")), "component").select("node", "class")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    ranked = (
        reps.join(links, "node", "left")
        .join(linked, "node", "left")
        .select("same", "rep", F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.coalesce("class", "rep"))
        .toDF("same", "rep", "n_links", "class_id")
    )
    return signed.select("doc_id", "print", "same").join(ranked, "same", "left").select(
        "doc_id", "print", "same",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("copy_of"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"),
    )
