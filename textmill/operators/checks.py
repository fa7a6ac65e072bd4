"""Row checks, the metrics over them, coverage against a plan, and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def verify(rows: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite entries of the map column ``checks``; a null check counts as failed."""
    new = F.create_map(*[x for n, c in checks.items() for x in (F.lit(n), F.coalesce(c, F.lit(False)))])
    if "checks" in rows.columns:
        kept = F.map_filter("checks", lambda k, _: ~k.isin(*checks))
        new = F.map_concat(kept, new)
    return rows.withColumn("checks", new)


def metrics(rows: DataFrame) -> DataFrame:
    """(check_name, passed, failed, pass_rate) over the map column ``checks``."""
    each = rows.select(F.explode("checks").alias("check_name", "ok"))
    return each.groupBy("check_name").agg(
        F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.avg(F.col("ok").cast("double")).alias("pass_rate")
    )


def score_means(rows: DataFrame) -> DataFrame:
    """(score_name, mean, n) over the map column ``scores``; nulls are left out."""
    each = rows.select(F.explode("scores").alias("score_name", "value")).where("value IS NOT NULL")
    return each.groupBy("score_name").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def failures(rows: DataFrame, order: str, examples: int = 5) -> DataFrame:
    """(check_name, failed, examples): the first failing ids in row order, comma-joined.

    The first rows are picked by rank, so no group's failures are gathered.
    """
    bad = rows.select(F.col(order).alias("id"), F.explode("checks").alias("check_name", "ok")).where("NOT ok")
    counts = bad.groupBy("check_name").agg(F.count(F.lit(1)).alias("failed"))
    first = bad.withColumn("r", F.row_number().over(Window.partitionBy("check_name").orderBy("id"))).where(F.col("r") <= examples)
    listed = first.groupBy("check_name").agg(F.array_join(F.array_sort(F.collect_list("id")).cast("array<string>"), ",").alias("examples"))
    return counts.join(listed, "check_name")


def bucket_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def coverage(planned: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned against observed bucket counts: a full outer join with a verdict for each bucket."""
    p = bucket_counts(planned, keys).withColumnRenamed("n", "planned")
    o = bucket_counts(observed, keys).withColumnRenamed("n", "observed")
    joined = p.join(o, list(keys), "full_outer")
    verdict = (
        F.when(F.col("observed").isNull(), "missing")
        .when(F.col("planned").isNull(), "unexpected")
        .when(F.col("planned") != F.col("observed"), "mismatched")
        .otherwise("passed")
    )
    return joined.select(*keys, F.coalesce("planned", F.lit(0)).alias("planned"), F.coalesce("observed", F.lit(0)).alias("observed"), verdict.alias("verdict"))


def minimums(rows: DataFrame, key: str, least: Mapping[str, int]) -> DataFrame:
    """(key, n, least, passed): counts against minima; a bucket without rows counts 0."""
    want = rows.sparkSession.createDataFrame(list(least.items()), f"{key} string, least long")
    got = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    joined = want.join(got, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"), "least")
    return joined.withColumn("passed", F.col("n") >= F.col("least"))


def value_counts(rows: DataFrame, value: str, most: int) -> DataFrame:
    """The most frequent non-null values, count descending, then value."""
    return rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), value).limit(most)
