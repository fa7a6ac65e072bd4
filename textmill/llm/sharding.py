"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Equal texts form a group that stays whole. A partial partition is a vector of shard sums;
differencing takes the two vectors of largest spread and adds them oppositely ordered,
until one is left. It runs inside hash buckets of groups, then inside buckets of the
buckets' final vectors, level by level, until so few are left that the driver combines
them. No task and not the driver ever sees more than a level's fan-in of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, discard, gapless_rank, stash, table

#: Partial partitions that are combined at a time: groups in a bucket, buckets in the next level's.
FAN_IN = 2_000


def differencing(vectors: Sequence[Sequence[int]], shards: int) -> tuple[list[list[int]], list[int]]:
    """Combine partial partitions until one is left.

    ``vectors[i]`` are the sums of partial partition i (up to ``shards`` of them). Returns
    for every input position the shard that it ends in, and the shards' sums. Ties go to
    the earlier partition, so the result depends on the input order alone.
    """
    parents: list[int] = []  # of a part: the part that it was added to
    first: list[int] = []
    heap: list[tuple[int, int, list[tuple[int, int]]]] = []
    for k, vector in enumerate(vectors):
        first.append(len(parents))
        parts = [(s, first[-1] + j) for j, s in enumerate(vector)]
        parents += [-1] * len(parts)
        parts = sorted(parts + [(0, -1)] * (shards - len(parts)), key=lambda p: -p[0])
        heap.append((parts[-1][0] - parts[0][0], k, parts))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        merged = []
        for (x, p), (y, q) in zip(a, reversed(b)):
            if p < 0 or q < 0:
                merged.append((x + y, max(p, q)))
            else:
                parents.append(-1)
                parents[p] = parents[q] = len(parents) - 1
                merged.append((x + y, len(parents) - 1))
        merged.sort(key=lambda p: -p[0])
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], count, merged))
        count += 1
    label = [-1] * len(parents)
    last = heap[0][2] if heap else []
    for shard, (_, part) in enumerate(last):
        if part >= 0:
            label[part] = shard
    for part in range(len(parents) - 1, -1, -1):
        if parents[part] >= 0:
            label[part] = label[parents[part]]
    return [
        [label[first[k] + j] for j in range(len(v))] for k, v in enumerate(vectors)
    ], [s for s, _ in last]


def combine(parts: DataFrame, shards: int) -> DataFrame:
    """Differencing inside every bucket of ``parts`` (bucket int, key string, sums array<long>).

    Gives (bucket, key, to, sums): ``to`` holds for each of the key's sums the part of the
    bucket's vector that it goes into; that vector is in ``sums`` of one row a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(bucket: int, rows: list[tuple[str, list[int]]]) -> pa.RecordBatch:
            own, sums = differencing([v for _, v in rows], shards)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket] * len(rows), pa.int32()),
                    pa.array([k for k, _ in rows], pa.string()),
                    pa.array(own, pa.list_(pa.int32())),
                    pa.array([sums if k == 0 else None for k in range(len(rows))], pa.list_(pa.int64())),
                ],
                names=["bucket", "key", "to", "sums"],
            )

        now, rows = None, []
        for batch in batches:
            for bucket, key, sums in zip(*(batch.column(n).to_pylist() for n in ("bucket", "key", "sums"))):
                if bucket != now and rows:
                    yield settle(now, rows)
                    rows = []
                now = bucket
                rows.append((key, sums))
        if rows:
            yield settle(now, rows)

    dealt = parts.repartition("bucket").sortWithinPartitions("bucket", F.desc(F.array_max("sums")), "key")
    return dealt.select("bucket", "key", "sums").mapInArrow(run, "bucket int, key string, to array<int>, sums array<long>")


def partition_groups(groups: DataFrame, shards: int, buckets: int) -> DataFrame:
    """(key, shard) for every row of ``groups`` (key string, weight long); keys are distinct."""
    spark = groups.sparkSession
    dealt = groups.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", F.array("weight").alias("sums"))
    levels = [stash(combine(dealt, shards), "shard-parts")]
    while True:
        vectors = levels[-1].where("sums IS NOT NULL").select("bucket", "sums")
        count = vectors.count()
        if count <= FAN_IN:
            break
        above = F.pmod(F.xxhash64("bucket"), F.lit(bucket_count(count, FAN_IN))).cast("int")
        levels.append(stash(combine(vectors.select(above.alias("bucket"), F.col("bucket").cast("string").alias("key"), "sums"), shards), "shard-level"))
    # One vector for each bucket of the last level: at most FAN_IN rows of ``shards`` numbers.
    last = sorted((r.bucket, list(r.sums)) for r in vectors.collect())
    to, _ = differencing([v for _, v in last], shards)
    rows = [(b, j, s) for (b, _), own in zip(last, to) for j, s in enumerate(own)]
    whole = F.broadcast(spark.createDataFrame(rows, "b int, p int, shard int"))
    for level in reversed(levels[1:]):
        below = level.select("bucket", F.col("key").cast("int").alias("below"), F.posexplode("to").alias("part", "goes"))
        whole = below.join(whole, (F.col("bucket") == F.col("b")) & (F.col("goes") == F.col("p"))).select(F.col("below").alias("b"), F.col("part").alias("p"), "shard")
        whole = whole.hint("merge")
    first = levels[0].select("bucket", "key", F.element_at("to", 1).alias("part"))
    return first.join(whole, (F.col("bucket") == F.col("b")) & (F.col("part") == F.col("p"))).select("key", "shard")


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text).

    Size is the text's UTF-8 bytes plus 1 (null: 1, its checksum that of no bytes). Equal
    texts share a shard; null counts as the empty text. Slots are gapless from 0 in each
    shard. Repeated rows are rows of one group; ties go by the checksum, so every run gives
    the same shards. Extra columns are left out. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stash(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("key"),
        ),
        "shard-rows",
    )
    groups = stash(rows.groupBy("key").agg(F.sum("size").alias("weight")), "shard-groups")
    parts = partition_groups(groups, shards, bucket_count(groups.count(), FAN_IN)).withColumnRenamed("key", "group_key")
    discard(groups)
    placed = rows.join(parts, rows.key == parts.group_key).drop("group_key", "key")
    many = bucket_count(rows.count() // shards, 5_000)
    return gapless_rank(placed, "shard", ["doc_id", "text_crc32", "size"], "slot", max(many, 64))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 of near-equal bytes."""
    got = shard_by_bytes(table(spark, sf_dir, "documents"), 16)
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
