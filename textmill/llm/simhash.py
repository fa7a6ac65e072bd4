"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of its word shingles' XXH64 values. Two
fingerprints link when they differ in at most ``radius`` bits. The candidate tables come
from a covering family: every bit position i gets a nonzero vector m(i) of radius + 1 bits,
and table v (each nonzero vector v) compares the positions with <m(i), v> = 1. At most
``radius`` differing positions span less than the whole space, so some v is orthogonal to
all of them and that table's masked keys are equal: no pair within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, stash, table
from .components import components

WIDTH = 64
#: Buckets with more fingerprints than this are split by a second covering family over
#: the bits that their table leaves free; smaller ones are compared in one task.
BUCKET = 2048


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """2^(radius+1) - 1 masks over ``bits`` of which any ``radius`` positions miss at least one."""
    size = 1 << (radius + 1)
    vector = {bit: 1 + k % (size - 1) for k, bit in enumerate(bits)}
    return [sum(1 << bit for bit in bits if (vector[bit] & v).bit_count() & 1) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def text_fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint. Null or wordless text gives 0."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[:n].tolist()
    stops = ends[-n:].tolist() if len(words) >= shingle else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype=np.uint64)
    set_bits = np.zeros(WIDTH, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int32)
    return _signed(int.from_bytes(np.packbits(set_bits * 2 > n, bitorder="little").tobytes(), "little"))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for every row of ``docs`` (doc_id, text); only these columns are read.

    Null, empty and wordless texts have fingerprint 0. Rows may repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [text_fingerprint(x.as_py(), shingle, seed) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.int64())], names=["doc_id", "fp"])

    return bounded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).mapInArrow(
        run, "doc_id long, fp long"
    )


def _local_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph of ``values`` that differ in at most ``radius`` bits."""
    if len(values) == 2:
        a, b = values
        return [(max(a, b), min(a, b))] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius else []
    signed = np.unique(np.array(values, dtype=np.int64))
    x, n = signed.view(np.uint64), len(signed)
    left = np.ones(n, dtype=bool)
    links: list[tuple[int, int]] = []
    for first in range(n):
        if not left[first]:
            continue
        left[first] = False
        todo = [first]
        while todo:
            near = np.nonzero(left & (np.bitwise_count(x ^ x[todo.pop()]) <= radius))[0]
            left[near] = False
            todo += near.tolist()
            links += [(int(signed[k]), int(signed[first])) for k in near]
    return links


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) inside the buckets (column fps: array of bounded length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {link for row in batch.column(0) for link in _local_links(row.as_py(), radius)}
            u, v = ([x[k] for x in found] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return buckets.select("fps").mapInArrow(run, "u long, v long")


def _mask_array(masks: list[int]):
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Links whose closure is that of all pairs of ``nodes.fp`` (distinct) within ``radius`` bits.

    A bucket gives the spanning forest of its own near pairs, so a group of n near copies
    makes at most n - 1 links in each table and never n squared. A bucket beyond BUCKET is
    dealt into the buckets of a covering family over its table's free bits (any pair within
    the radius that shares the bucket differs in free bits only, so it shares one of those),
    again and again until no bit is free or no bucket is too large.
    """
    spark = nodes.sparkSession
    level = [(m, [b for b in range(WIDTH) if not m >> b & 1]) for m in covering_masks(list(range(WIDTH)), radius)]
    members = nodes.select("fp", F.explode(_mask_array([m for m, _ in level])).alias("mask"))
    found = spark.createDataFrame([], "u long, v long")
    for _ in range(4):
        keyed = members.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        counts = stash(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
        most = counts.agg(F.max("n")).first()[0] or 0
        final = len(level[0][1]) <= 11
        small = keyed.join(counts.where(F.lit(final) | (F.col("n") <= BUCKET)), ["mask", "key"])
        buckets = small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps"))
        found = found.union(_bucket_links(buckets, radius))
        if most <= BUCKET or final:
            break
        finer = {m: [m | s for s in covering_masks(free, radius)] for m, free in level}
        large = keyed.join(counts.where(F.col("n") > BUCKET), ["mask", "key"])
        parents = spark.createDataFrame(
            [(_signed(m), [_signed(s) for s in sub]) for m, sub in finer.items()], "mask long, sub array<long>"
        )
        members = stash(
            large.join(F.broadcast(parents), "mask").select("fp", F.explode("sub").alias("mask")).distinct(), "simhash-split"
        )
        level = [(s, [b for b in range(WIDTH) if not s >> b & 1]) for sub in finer.values() for s in sub]
    return found.distinct()


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id reachable over links of at most ``radius`` bits,
    the row's own included. Rows of equal fingerprint are one class and are never paired.
    Null and wordless texts share fingerprint 0 and link like any other. Rows with a null
    doc_id get the least known doc_id of their class, or null. An empty table gives no rows.
    """
    prints = stash(fingerprints(docs, shingle, seed), "simhash-fp")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = stash(components(links(nodes.select("fp"), radius), "simhash-cc"), "simhash-roots")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return prints.join(classes, prints.fp == classes.class_fp).select("doc_id", "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of all documents."""
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
