"""The corpus pipeline: the stages of a training-data build, in order.

Each stage takes the documents that its predecessor kept and returns documents (the last
one packed sequences). Between two stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import decontamination, packing, pii, quality, simhash
from textmill.llm.common import discard, free_names, stash, table
from textmill.sources.shared import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the hard limits and their language's certified cutoff.

    Null, empty and wordless texts go. Repeated rows are judged alike. Extra columns of any
    name stay; an empty table gives no rows (as in every stage).
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one with the least doc_id.

    Rows that share the id are told apart by a row number, so exactly one row stays. Groups
    whose ids are all null keep one row too. Null, empty and wordless texts are one group.
    Texts of any length are hashed whole; extra columns of any name stay.
    """
    row, keep = free_names(docs.columns, "row", "keep")
    numbered = stash(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-docs")
    found = simhash.near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("row_id"), F.col("component_id").alias("group"))
    ids = numbered.select(F.col(row).alias("doc_row"), F.col("doc_id").alias("known_id"))
    placed = groups.join(ids, F.col("row_id") == F.col("doc_row"))
    # The least (null last, doc_id, row) of each group is a partial aggregate: no group is gathered.
    first = placed.groupBy("group").agg(F.min(F.struct(F.col("known_id").isNull(), "known_id", "doc_row")).alias("first"))
    kept = stash(first.select(F.col("first.doc_row").alias(keep)), "dedup-kept")
    # What stays grows with the corpus: the join is dealt by row, never broadcast.
    return numbered.join(kept.hint("merge"), numbered[row] == kept[keep], "left_semi").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window.

    Null and empty texts hold none and stay; an empty benchmark drops nothing. Repeated rows
    stay or go together. Texts are matched whole; extra columns of any name stay.
    """
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.col(found.columns[-1]).n_hit == 0).select(*docs.columns)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal spans replaced by their kind; n_chars follows the text where it changed.

    A null text stays null. Overlapping spans are one stretch. Texts of any length are read
    whole; repeated rows are redacted alike; extra columns of any name stay.
    """
    (spans,) = free_names(docs.columns, "spans")
    found = docs.withColumn(spans, pii.personal_spans(F.col("text")))
    clean = found.withColumn("text", pii.redact(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens.

    A null or empty text is its end token alone. Repeated rows are packed each on its own;
    extra columns are left out; an empty table gives no rows.
    """
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("pii", redact_personal),
    ("packing", pack_sequences),
]

#: The stages hash, tokenize and pack; SQL has no form for them, so tests check each stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        given, docs = docs, settle(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), spark, name)
        if k:
            discard(given)
    return STAGES[-1][1](spark, docs, sf_dir)
