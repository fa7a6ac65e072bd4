"""Runs: content-addressed work units with manifests, reuse, status and comparison."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import matches, write_text

MANIFEST = "run_id string, pack string, spec_hash string, started_at string, finished_at string, error string, rows long"


def canonical_json(spec: Any) -> str:
    """Sorted keys, no spaces, other than ASCII as it is."""
    return json.dumps(spec, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def hash_spec(spec: Any) -> str:
    return hashlib.sha256(canonical_json(spec).encode()).hexdigest()


def new_run_id(spec: Any, now: datetime | None = None) -> str:
    """UTC stamp and eight hex digits of the spec's hash and the time."""
    now = now or datetime.now(UTC)
    tail = hashlib.sha256(f"{hash_spec(spec)}:{now.timestamp()}".encode()).hexdigest()[:8]
    return f"{now:%Y%m%dT%H%M%SZ}-{tail}"


def write_manifest(spark: SparkSession, root: str, manifest: dict[str, Any]) -> str:
    """One JSON document for each run, in the run's own folder, where the rows are."""
    path = f"{root}/{manifest['pack']}/{manifest['run_id']}/manifest.json"
    write_text(spark, path, json.dumps(manifest, sort_keys=True, ensure_ascii=False))
    return path


def resolve(spark: SparkSession, root: str, run_id: str) -> str:
    """The one folder of a run; none or several are an error."""
    found = matches(spark, f"{root}/*/{run_id}")
    if len(found) != 1:
        raise ValueError(f"{len(found)} folders of run {run_id} below {root}")
    return found[0]


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifests under ``root`` as rows; packs and runs are folders."""
    return spark.read.schema(MANIFEST).json(f"{root}/*/*/manifest.json")


def status() -> Column:
    return F.when(F.col("error").isNotNull(), "failed").when(F.col("finished_at").isNotNull(), "completed").otherwise("running")


def latest(runs: DataFrame) -> DataFrame:
    """For each (pack, spec_hash) the completed run that finished last."""
    done = runs.where(status() == "completed")
    best = F.max(F.struct("finished_at", "run_id")).alias("b")
    return done.groupBy("pack", "spec_hash").agg(best).select("pack", "spec_hash", F.col("b.run_id").alias("run_id"), F.col("b.finished_at").alias("finished_at"))


def compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, field, left_value, right_value) of the fields in which rows of equal key differ."""
    fields = [c for c in left.columns if c != key and c in right.columns]
    a = left.select(key, *[F.col(c).cast("string").alias(f"a_{c}") for c in fields])
    b = right.select(key, *[F.col(c).cast("string").alias(f"b_{c}") for c in fields])
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a_{c}").alias("left_value"), F.col(f"b_{c}").alias("right_value")) for c in fields])
    rows = a.join(b, key, "full_outer").select(key, F.explode(each).alias("d")).select(key, "d.*")
    return rows.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def progress(events: DataFrame) -> DataFrame:
    """(component, events, last_ts, items_per_minute): counts and rate of each component's events."""
    seconds = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")) / 1e6
    rate = F.when(seconds > 0, F.round(F.count(F.lit(1)) * 60 / seconds, 2)).otherwise(F.lit(0.0))
    return events.groupBy("component").agg(F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_ts"), rate.alias("items_per_minute"))


def tail(events: DataFrame, order: str, n: int) -> DataFrame:
    """The last n events, oldest first."""
    return events.orderBy(F.desc(order)).limit(n).orderBy(order)
