"""Queries by name: what runs on Spark and the DuckDB SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle if SQL has one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The DuckDB forms of the text functions that the oracles share.
def sql_tokens(t: str) -> str:
    return f"regexp_extract_all(replace(lower({t}),'ß','ss'),'[\\p{{L}}\\p{{N}}]+')"


def sql_words(t: str) -> str:
    return f"list_filter(string_split_regex({t},'\\s+'), lambda x: x <> '')"


def sql_index(t: str, most: int = 128) -> str:
    return f"list_sort(list_distinct({sql_tokens(t)}))[1:{most}]"


def sql_collapse(t: str) -> str:
    return f"trim(regexp_replace({t},'\\s+',' ','g'))"


def sql_sentences(t: str) -> str:
    return f"list_filter(string_split(regexp_replace({sql_collapse(t)},'([.!?])\\s+','\\1'||chr(1),'g'),chr(1)), lambda x: x <> '')"


def sql_clean(t: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split({t},chr(10)), lambda x: trim(x, ' '||chr(9)||chr(13)||chr(11)||chr(12))), lambda x: x <> ''), chr(10))"


def sql_chunks(table: str, size: int = 80, overlap: int = 20, key: str = "doc_id", keep: str = "") -> str:
    """SELECT of (key, chunk_no, word_count, text) chunks of a table with key and text."""
    step = size - overlap
    extra = f", {keep}" if keep else ""
    return (
        f"SELECT {key}{extra}, CAST(c AS INTEGER) AS chunk_no, CAST(len(s) AS BIGINT) AS word_count, array_to_string(s,' ') AS text FROM ("
        f"SELECT {key}{extra}, c, ws[c*{step}+1 : c*{step}+{size}] AS s FROM ("
        f"SELECT {key}{extra}, ws, unnest(range(CASE WHEN len(ws)=0 THEN 0 WHEN len(ws)<={size} THEN 1 ELSE CAST(ceil((len(ws)-{size})/{step}.0) AS BIGINT)+1 END)) AS c FROM ("
        f"SELECT {key}{extra}, {sql_words('text')} AS ws FROM {table})))"
    )
