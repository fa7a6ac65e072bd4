"""Plans of rows: weighted profiles, grids, acceptance up to a target, resuming by count, counters of models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from . import sampling as S


def weighted_cycle(rows: DataFrame, order: str, profiles: Mapping[str, int], seed: int, out: str = "profile") -> DataFrame:
    """Profiles, each as often as its weight, in hash order, dealt to the rows in turn."""
    spark = rows.sparkSession
    repeated = spark.createDataFrame([(name, k) for name, weight in profiles.items() for k in range(weight)], f"{out} string, copy int")
    key = F.concat(F.col(out), F.lit("#"), F.col("copy").cast("string"))
    # As many rows as the configured weights add up to.
    listed = repeated.select(out, (F.row_number().over(Window.orderBy(T.hash_order(seed, key), key)) - 1).alias("__turn"))
    dealt = S.numbered(rows, [order], "__ord")
    return S.modulo_join(dealt, F.broadcast(listed), "__ord", "__turn", sum(profiles.values())).select(*rows.columns, out)


def grid(spark: SparkSession, axes: Mapping[str, Sequence[str]]) -> DataFrame:
    """All combinations of configured lists, numbered in their order from 0."""
    one = lambda name, values: spark.createDataFrame([(v, k) for k, v in enumerate(values)], f"{name} string, __{name} int")
    crossed = reduce(DataFrame.crossJoin, [one(name, values) for name, values in axes.items()])
    number = F.lit(0)
    for name, values in axes.items():
        number = number * len(values) + F.col(f"__{name}")
    return crossed.select(number.cast("long").alias("ord"), *axes)


def strict_accept(rows: DataFrame, passed: Column, order: str, target: int, out: str = "outcome") -> DataFrame:
    """Rows in order until ``target`` have passed: those are accepted, the failed before them rejected, the rest left out."""
    marked = rows.withColumn(out, F.when(F.coalesce(passed, F.lit(False)), "accepted").otherwise("rejected"))
    first = marked.where(F.col(out) == "accepted").orderBy(order).limit(target)
    stop = first.agg(F.count(F.lit(1)).alias("__n"), F.max(order).alias("__stop"))
    bounded = marked.crossJoin(F.broadcast(stop))
    return bounded.where((F.col("__n") < target) | (F.col(order) <= F.col("__stop"))).drop("__n", "__stop")


def resume_by_count(rows: DataFrame, done: DataFrame, order: str) -> DataFrame:
    """The rows after as many as are done: outputs are a prefix of the inputs, in order."""
    count = done.agg(F.count(F.lit(1)).alias("__done"))
    return S.numbered(rows, [order], "__ord").crossJoin(F.broadcast(count)).where(F.col("__ord") >= F.col("__done")).select(*rows.columns)


def parse_metrics(rows: DataFrame, parsed: Column, repaired: Column) -> DataFrame:
    """Counters of answers that parse as they are, after a repair, or not at all."""
    first, second = F.coalesce(parsed, F.lit(False)), F.coalesce(repaired, F.lit(False))
    marked = rows.select(first.alias("a"), second.alias("b"))
    return marked.agg(
        F.count(F.lit(1)).alias("parse_attempts"), F.count_if(F.col("a") | F.col("b")).alias("parse_successes"),
        F.count_if(~F.col("a") & ~F.col("b")).alias("parse_failures"), F.count_if(~F.col("a")).alias("repair_attempts"),
        F.count_if(~F.col("a") & F.col("b")).alias("repair_successes"), F.count_if(~F.col("a") & ~F.col("b")).alias("repair_failures"),
    )


def published_model(metrics: DataFrame, model: str, by: list[str]) -> DataFrame:
    """The one model that all of a group's metrics name, else null."""
    kinds = F.collect_set(model)
    return metrics.groupBy(*by).agg(F.when(F.size(kinds) == 1, F.get(kinds, F.lit(0))).alias("generation_model"))


def expecting_responses(rows: DataFrame, expects: Column, out: str = "check_responses") -> DataFrame:
    """Every row with whether any row expects a response: then all are checked for one."""
    return rows.crossJoin(F.broadcast(rows.agg(F.coalesce(F.bool_or(expects), F.lit(False)).alias(out))))


def annotate(rows: DataFrame, reasons: Column, hidden: str = "hidden") -> DataFrame:
    """Filter reasons inside the hidden struct."""
    return rows.withColumn(hidden, F.col(hidden).withField("filter_reasons", reasons))
