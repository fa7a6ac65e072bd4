"""Helpers that the corpus operators share: reading, shared-folder tables, skew-free ranks."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import discard, shared_dir, stash

__all__ = ["bounded", "bucket_count", "discard", "free_names", "gapless_rank", "let", "lower_ascii", "shared_dir", "split_words", "stash", "table", "words_of"]

#: Words of the contracts: maximal runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder; only Spark's own readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame) -> DataFrame:
    """``df``, its session's Arrow batches held to BATCH_BYTES.

    A task that hands texts to Python holds a batch on both sides at once; a batch of
    thousands of very long texts would not fit beside a full heap.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", conf.get(key))
    if now is None or not 0 < int(now[1]) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """``wanted``, each with underscores before it until it is no column of ``taken`` (case aside)."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``use``, also inside other lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_words(text: Column, between: str) -> Column:
    """Parts of a text between the matches of ``between``, without the empty ends."""

    def inner(parts: Column) -> Column:
        head = (F.get(parts, F.lit(0)) == "").cast("int")
        tail = (F.get(parts, F.size(parts) - 1) == "").cast("int")
        return F.slice(parts, 1 + head, F.greatest(F.size(parts) - head - tail, F.lit(0)))

    return let(F.split(text, between), inner)


def words_of(text: Column) -> Column:
    """White-space separated words of a text; null has none."""
    return split_words(F.coalesce(text, F.lit("")), SPACE)


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z and nothing else. A text of ASCII alone takes the faster way."""
    ascii_only = F.octet_length(text) == F.length(text)
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(ascii_only, F.lower(text)).otherwise(slow)


def bucket_count(rows: int, per_bucket: int) -> int:
    """How many hash buckets keep about ``per_bucket`` rows in each, whatever the rows are."""
    return int(max(1, -(-rows // per_bucket)))


def gapless_rank(df: DataFrame, group: str, order: Sequence[str], out: str, buckets: int) -> DataFrame:
    """Number the rows of every group from 0 without gaps, though one group hold most rows.

    Rows are dealt into hash buckets of the order columns; a row's number is the count of
    its group's rows in earlier buckets plus its place in its own bucket. No task sees a
    whole group: the windows run over (group, bucket). The offsets table has one row for
    each (group, bucket) that occurs.
    """
    b = "__bucket"
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(group, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(group).alias("__g"), F.col(b).alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")
    )
    inside = Window.partitionBy(group, b).orderBy(*order)
    ranked = dealt.withColumn("__rn", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, (F.col(group) == F.col("__g")) & (F.col(b) == F.col("__b")))
    return joined.withColumn(out, (F.col("__off") + F.col("__rn")).cast("long")).drop("__g", "__b", "__off", "__rn", b)
