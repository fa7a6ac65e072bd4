"""Packs: named pipelines of build, verify, summarize and publish over DataFrames."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import render as N
from ..functions import text as T
from ..functions.surfaces import STYLES
from ..sources.shared import matches, write_text
from . import checks as K
from . import corpus as C
from . import runs as U
from . import sampling as S

Build = Callable[[SparkSession, dict[str, Any]], DataFrame]


@dataclass(frozen=True)
class Pack:
    """A pipeline: rows with an id, the checks that they have to pass, and how they are split."""

    name: str
    build: Build
    checks: Callable[[], Mapping[str, Column]]
    split: str | None = None
    fraction: float = 0.9


def _present(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name).cast("string")) != "", F.lit(False))


def _basic(*names: str) -> Callable[[], Mapping[str, Column]]:
    return lambda: {f"has_{n}": _present(n) for n in names}


def build_demo(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    """Additions whose operands come from hashes of the row number, so any task makes the same row."""
    n, seed = int(cfg.get("rows", 20)), int(cfg.get("seed", 0))
    operand = lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(100)).cast("int")
    rows = spark.range(n).select("id", operand(1).alias("a"), operand(2).alias("b"))
    return rows.select(
        F.format_string("demo-%06d", "id").alias("id"), F.concat_ws(" ", F.lit("What is"), "a", F.lit("+"), F.concat("b", F.lit("?"))).alias("prompt"),
        (F.col("a") + F.col("b")).cast("string").alias("target"), (F.col("a") + F.col("b")).cast("string").alias("answer"),
    )


def build_memory_core(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    """Chunks of the documents of a path: id, prompt (the chunk's place) and target (its text)."""
    docs = spark.read.parquet(cfg["source_path"]).select("doc_id", "text")
    chunks = C.chunk(docs, int(cfg.get("chunk_size", 80)), int(cfg.get("chunk_overlap", 20)))
    return chunks.select(F.format_string("doc-%d-chunk-%03d", "doc_id", "chunk_no").alias("id"), F.format_string("Recall part %d of document %d.", "chunk_no", "doc_id").alias("prompt"), F.col("text").alias("target"))


def build_translation(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
    """Parallel pairs to prompts: length filter, quota per origin, one variant after the other, rendering."""
    pairs = spark.read.parquet(cfg["source_path"]).select("id", "source_text", "target_text", "origin")
    longest = F.greatest(F.length("source_text"), F.length("target_text"))
    kept = pairs.where((F.trim("source_text") != "") & (F.trim("target_text") != "") & (longest <= int(cfg.get("max_pair_chars", 50_000))))
    limited = S.quota(kept, "origin", "id", int(cfg.get("max_per_origin", 4300)))
    styles = list(cfg.get("template_styles", ["translate_into", "from_to"]))
    cycled = S.cycle(limited.withColumn("pool", F.lit("all")), ["pool"], "id", len(styles), "variant")
    style = F.element_at(F.array(*map(F.lit, styles)), (F.col("variant") + 1).cast("int"))
    langs = F.lit(cfg.get("source_language", "en")), F.lit(cfg.get("target_language", "da"))
    asked = N.prompt(style, F.col("source_text"), *langs, F.lit(cfg.get("prompt_language", "en")))
    answer = (N.output_mode(style), F.col("target_text"), F.col("source_text"), *langs)
    made = N.target(*answer)
    if any(STYLES[s].startswith("yaml_") for s in styles):
        made = F.coalesce(N.yaml_target(*answer), made)
    return cycled.select(F.concat(F.lit("translation-"), F.col("id").cast("string")).alias("id"), asked.alias("prompt"), made.alias("target"), "origin")


STARTERS = {
    "tool_use": ("Call the tool that answers: {topic}.", '{{"tool": "{topic}", "arguments": {{}}}}', ["weather", "calendar", "search"]),
    "python_algorithms": ("Write a Python function for {topic}.", "def {topic}(xs): ...", ["sorting", "searching", "counting"]),
}


def build_starter(name: str) -> Build:
    """Rows of a static specification, its topics taken in turn."""

    def build(spark: SparkSession, cfg: dict[str, Any]) -> DataFrame:
        prompt, target, topics = STARTERS[name]
        n = int(cfg.get("rows", 6))
        dim = spark.createDataFrame([(k, prompt.format(topic=t), target.format(topic=t)) for k, t in enumerate(topics)], "k int, prompt string, target string")
        rows = S.modulo_join(spark.range(n).withColumnRenamed("id", "n"), F.broadcast(dim), "n", "k", len(topics))
        return rows.select(F.concat(F.lit(f"{name}-"), F.format_string("%06d", "n")).alias("id"), "prompt", "target")

    return build


PACKS = {
    p.name: p
    for p in (
        Pack("demo", build_demo, lambda: {**_basic("prompt", "target")(), "answer_correct": F.col("answer") == F.col("target")}),
        Pack("memory_core", build_memory_core, _basic("prompt", "target")),
        Pack("translation", build_translation, lambda: {**_basic("prompt", "target")(), "answer_not_leaked": ~T.normalized(F.col("prompt")).contains(T.normalized(F.col("target")))}, "origin"),
        Pack("tool_use", build_starter("tool_use"), _basic("prompt", "target")),
        Pack("python_algorithms", build_starter("python_algorithms"), _basic("prompt", "target")),
    )
}


def run(spark: SparkSession, root: str, pack: str, cfg: dict[str, Any]) -> str:
    """Build a pack's rows under ``root`` and return the run's id; an equal completed run is reused."""
    spec = {"pack": pack, "config": cfg}
    digest = U.hash_spec(spec)
    if matches(spark, f"{root}/{pack}/*/manifest.json"):
        done = U.latest(U.manifests(spark, root)).where((F.col("pack") == pack) & (F.col("spec_hash") == digest)).collect()
        if done:
            return done[0].run_id
    run_id, started = U.new_run_id(spec), datetime.now(UTC).isoformat(timespec="seconds")
    manifest = {"run_id": run_id, "pack": pack, "spec_hash": digest, "started_at": started, "finished_at": None, "error": None, "rows": None}
    U.write_manifest(spark, root, manifest)
    try:
        PACKS[pack].build(spark, cfg).write.parquet(f"{root}/{pack}/{run_id}/rows")
        manifest["rows"] = spark.read.parquet(f"{root}/{pack}/{run_id}/rows").count()
    except Exception as e:
        U.write_manifest(spark, root, manifest | {"error": f"{type(e).__name__}: {e}"})
        raise
    U.write_manifest(spark, root, manifest | {"finished_at": datetime.now(UTC).isoformat(timespec="seconds")})
    return run_id


def verified(spark: SparkSession, root: str, pack: str, run_id: str) -> DataFrame:
    return K.verify(spark.read.parquet(f"{root}/{pack}/{run_id}/rows"), PACKS[pack].checks())


def summarize(spark: SparkSession, root: str, pack: str, run_id: str) -> dict[str, Any]:
    """Metrics and failures of a run: one row for each check."""
    rows = verified(spark, root, pack, run_id)
    return {"metrics": [r.asDict() for r in K.metrics(rows).collect()], "failures": [r.asDict() for r in K.failures(rows, "id").collect()]}


def publish(spark: SparkSession, root: str, pack: str, run_id: str, to: str) -> None:
    """Train and eval rows that pass every check, the failures, and the report."""
    rows = verified(spark, root, pack, run_id)
    ok = F.forall(F.map_values("checks"), lambda x: x)
    spec = PACKS[pack]
    S.split_by_position(rows.where(ok), "id", spec.fraction, spec.split).write.partitionBy("split").mode("overwrite").parquet(f"{to}/data")
    rows.where(~ok).write.mode("overwrite").parquet(f"{to}/failures")
    write_text(spark, f"{to}/report.json", json.dumps(summarize(spark, root, pack, run_id), sort_keys=True, default=str))
