"""Positional operators: quotas, splits, cyclic assignment, interleaving, balanced samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import stash


def quota(rows: DataFrame, group: str, order: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group; rows without a group are not limited."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    # Apart from the rows without a group, so that Spark limits each partition's groups before the shuffle.
    limited = rows.where(F.col(group).isNotNull()).withColumn("__r", rank).where(F.col("__r") <= most).drop("__r")
    return limited.unionByName(rows.where(F.col(group).isNull()))


def numbered(rows: DataFrame, order: list[Column | str], out: str = "ord", group: list[str] | None = None) -> DataFrame:
    """Row numbers from 0, of all rows or inside each group, without a task that holds them all.

    Rows are sorted into ranges of (group, order); a row's number is the count of its group's
    rows in earlier ranges plus its place in its own. The sorted rows are stored once:
    ranges are sampled, and two reads of the unsorted rows could see different ones.
    """
    group = group or []
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(ranges, *group, *order).sortWithinPartitions(*group, *order)
    # The id holds the range in its upper 31 bits and the place in the lower 33.
    stored = stash(sorted_rows.withColumn("__mid", F.monotonically_increasing_id()), "numbered").withColumn("__part", F.shiftright("__mid", 33))
    parts = stored.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("__part").alias("__p"), *[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)],
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__off"),
    )
    same = F.col("__part") == F.col("__p")
    for k, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"__g{k}"))
    joined = stored.join(offsets if group else F.broadcast(offsets), same)
    return joined.withColumn(out, F.col("__off") + F.col("__mid")).select(*rows.columns, out)


def split_by_position(rows: DataFrame, order: str, fraction: float, group: str | None = None) -> DataFrame:
    """Column ``split``: the first floor(n * fraction) rows (of each group) are train, the rest eval."""
    if group is None:
        placed = numbered(rows, [order], "__ord").crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("__total"))))
    else:
        totals = rows.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__total"))
        placed = numbered(rows, [order], "__ord", [group]).join(totals, F.col(group).eqNullSafe(F.col("__group")))
    return placed.withColumn("split", F.when(F.col("__ord") < F.floor(F.col("__total") * fraction), "train").otherwise("eval")).select(*rows.columns, "split")


def cycle(rows: DataFrame, group: list[str], order: str, n: int, out: str) -> DataFrame:
    """The i-th row of a group takes variant i mod n."""
    return numbered(rows, [order], out, group).withColumn(out, (F.col(out) % n).cast("int"))


def interleave(rows: DataFrame, group: str, order: str, out: str = "round") -> DataFrame:
    """Round robin over groups: sort the result by (round, group)."""
    return numbered(rows, [order], out, [group]).withColumn(out, F.col(out).cast("int"))


def shuffled_cycle(rows: DataFrame, key: str, n: int, seed: int, group: str, out: str) -> DataFrame:
    """Balanced assignment of n values in hash order inside each group."""
    dealt = numbered(rows.withColumn("__hash", T.hash_order(seed, F.col(key))), ["__hash", key], out, [group])
    return dealt.withColumn(out, (F.col(out) % n).cast("int")).drop("__hash")


def balanced(rows: DataFrame, major: str, minor: str, key: str, seed: int, most: int) -> DataFrame:
    """Two-level balanced sample: round robin over major kinds, inside them over minor ones.

    Rank inside (major, minor) in hash order, then rank inside major by that rank, then the
    round robin takes the lowest ranks first. A rank beyond ``most`` is never taken, so Spark
    limits each partition's groups before it shuffles them.
    """
    inner = F.row_number().over(Window.partitionBy(major, minor).orderBy(T.hash_order(seed, F.col(key)), key))
    outer = F.row_number().over(Window.partitionBy(major).orderBy("__inner", minor, key))
    ranked = rows.withColumn("__inner", inner).where(F.col("__inner") <= most).withColumn("__outer", outer).where(F.col("__outer") <= most)
    return ranked.orderBy("__outer", major).limit(most).withColumnRenamed("__outer", "round").drop("__inner")


def keep_first(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of every key."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def modulo_join(left: DataFrame, right: DataFrame, left_ord: str, right_ord: str, n_right: int) -> DataFrame:
    """Pair row i with row i mod n of a catalog of ``n_right`` rows."""
    return left.join(right, F.col(left_ord) % n_right == F.col(right_ord))


def limit_after_first(rows: DataFrame, order: str, most: int) -> DataFrame:
    """A limit that stops after yielding: 0 still gives one row."""
    return rows.orderBy(order).limit(max(most, 1))


def resume(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the processed ones."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
