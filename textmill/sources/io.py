"""Sources and sinks: JSON lines, Parquet, whole texts, blobs, published datasets, streams of rows."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

DOCUMENT = ST.StructType(
    [
        ST.StructField("id", ST.StringType()),
        ST.StructField("title", ST.StringType()),
        ST.StructField("text", ST.StringType()),
        ST.StructField("source", ST.StringType()),
        ST.StructField("url", ST.StringType()),
        ST.StructField("license", ST.StringType()),
        ST.StructField("meta", ST.MapType(ST.StringType(), ST.StringType())),
    ]
)
READERS = (".jsonl", ".json", ".parquet", ".txt")
RECORDS = (".yaml", ".yml", ".json", ".jsonl", ".parquet")


def read_rows(spark: SparkSession, path: str, schema: ST.StructType | str | None = None) -> DataFrame:
    """Rows of a path by its suffix; JSON lines skip blank lines, a text file is one row."""
    suffix = next((s for s in READERS if path.rstrip("/").endswith(s)), None)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".txt":
        return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")
    if suffix is None:
        raise ValueError(f"no reader for {path}: expected one of {', '.join(READERS)}")
    reader = spark.read.option("multiLine", suffix == ".json")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def source_label(source: Mapping[str, object]) -> str:
    """A source's data set name, else its path."""
    label = source.get("dataset") or source.get("path")
    if not label:
        raise ValueError("a source needs a dataset or a path")
    return str(label)


def _only(source: Mapping[str, object], *names: str) -> str:
    """The one of ``names`` that is set."""
    given = [n for n in names if source.get(n) is not None]
    if len(given) != 1:
        raise ValueError(f"expected exactly one of {', '.join(names)}; got {', '.join(given) or 'none'}")
    return given[0]


def records(spark: SparkSession, source: Mapping[str, object], presets: Mapping[str, list[dict]] | None = None) -> DataFrame:
    """Configured records: a preset, inline ones, or a file (YAML, JSON, JSON lines, Parquet).

    Presets, inline and YAML records are configuration and come through the driver.
    """
    kind = _only(source, "preset", "inline", "path")
    if kind == "preset":
        if source["preset"] not in (presets or {}):
            raise ValueError(f"no preset {source['preset']}")
        return _inline(spark, presets[source["preset"]])
    if kind == "inline":
        return _inline(spark, source["inline"])
    path = str(source["path"])
    if not path.endswith(RECORDS):
        raise ValueError(f"no reader for {path}: expected one of {', '.join(RECORDS)}")
    if not path.endswith((".yaml", ".yml")):
        return read_rows(spark, path)
    import yaml  # only sources written in YAML need it

    loaded = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])
    return _inline(spark, loaded if isinstance(loaded, list) else [loaded])


def _inline(spark: SparkSession, rows: object) -> DataFrame:
    text = F.lit(json.dumps(list(rows), ensure_ascii=False))
    schema = spark.range(1).select(F.schema_of_json(text)).first()[0]
    return spark.range(1).select(F.inline(F.from_json(text, schema)))


def load_sources(spark: SparkSession, cfg: Mapping[str, object]) -> DataFrame:
    """Documents of the one source that a configuration names: inline_docs or source_path (wikipedia needs a network)."""
    kind = _only(cfg, "wikipedia", "inline_docs", "source_path")
    if kind == "wikipedia":
        raise ValueError("wikipedia documents need a network; read a stored copy by source_path")
    if kind == "inline_docs" and not cfg["inline_docs"]:
        raise ValueError("inline_docs is empty")
    return normalize_documents(_inline(spark, cfg["inline_docs"]) if kind == "inline_docs" else read_rows(spark, str(cfg["source_path"])))


def write_preview(rows: DataFrame, order: str, n: int, path: str) -> None:
    """The first ``n`` rows as JSON lines."""
    rows.orderBy(order).limit(n).coalesce(1).write.mode("overwrite").json(path)


def normalize_documents(rows: DataFrame, language: str | None = None) -> DataFrame:
    """Document columns with their defaults: id by title, url by source; other languages are an error."""
    have = set(rows.columns)
    pick = lambda name: F.col(name).cast("string") if name in have else F.lit(None).cast("string")
    out = rows.select(
        F.coalesce(pick("id"), pick("title"), F.sha1(F.coalesce(pick("text"), F.lit("")))).alias("id"),
        F.coalesce(pick("title"), pick("id")).alias("title"),
        pick("text").alias("text"),
        pick("source").alias("source"),
        F.coalesce(pick("url"), pick("source")).alias("url"),
        pick("license").alias("license"),
        pick("language").alias("language"),
    )
    if language is not None:
        fits = F.col("language").isNull() | (F.col("language") == language)
        out = out.withColumn("language", F.when(fits, F.col("language")).otherwise(F.raise_error(F.concat(F.lit("unexpected language "), F.col("language")))))
    return out


def prefix(rows: DataFrame, order: str, n: int) -> DataFrame:
    return rows.orderBy(order).limit(n)


def distinct_keys(rows: DataFrame, key: Column) -> DataFrame:
    return rows.select(key.alias("key")).where("key IS NOT NULL").distinct()


def blobs(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length, content) of the files of a glob."""
    return spark.read.format("binaryFile").load(pattern).select("path", "length", "content")


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the JSON lines and Parquet files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    return files.where(F.col("path").rlike(r"\.(jsonl|json|parquet)$"))


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines with sorted keys; null fields are left out."""
    rows.select(*sorted(rows.columns)).write.mode(mode).option("ignoreNullFields", "true").json(path)


def publish(rows: DataFrame, path: str, split: str = "split", passed: str | None = None) -> None:
    """Train and eval as partitions of one write, and the failures beside them."""
    kept = rows if passed is None else rows.where(passed)
    kept.write.partitionBy(split).mode("overwrite").parquet(f"{path}/data")
    if passed is not None:
        rows.where(f"NOT ({passed})").write.mode("overwrite").parquet(f"{path}/failures")


def route(rows: DataFrame, reasons: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (no reasons) and rejected ones."""
    return rows.where(F.size(reasons) == 0), rows.where(F.size(reasons) > 0)


def strip_hidden(rows: DataFrame) -> DataFrame:
    return rows.drop("hidden")


def defaults(rows: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Fill nulls of the named columns."""
    return rows.withColumns({c: F.coalesce(F.col(c), v) for c, v in values.items()})
