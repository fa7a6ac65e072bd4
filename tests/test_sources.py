"""Configured sources and record fields on small inline rows."""

import json

import pytest
from pyspark.sql import functions as F

from textmill.functions import records as R
from textmill.operators import planning as L
from textmill.sources import io


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column.alias("x")).first().x


def test_records_come_from_exactly_one_place(spark, tmp_path):
    rows = [{"name": "a", "n": 1}, {"name": "b", "n": 2}]
    (tmp_path / "r.yaml").write_text("- {name: a, n: 1}\n- {name: b, n: 2}\n")
    (tmp_path / "r.json").write_text(json.dumps(rows))
    spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long").write.parquet(f"{tmp_path}/r.parquet")
    for source in ({"inline": rows}, {"preset": "p"}, *({"path": f"{tmp_path}/r{s}"} for s in (".yaml", ".json", ".parquet"))):
        got = io.records(spark, source, {"p": rows})
        assert sorted((r["name"], r.n) for r in got.collect()) == [("a", 1), ("b", 2)]
    for bad in ({}, {"inline": rows, "path": "x.json"}, {"path": "x.csv"}, {"preset": "q"}):
        with pytest.raises(ValueError):
            io.records(spark, bad, {"p": rows})
    assert io.source_label({"dataset": "d", "path": "p"}) == "d" and io.source_label({"path": "p"}) == "p"


def test_documents_come_from_exactly_one_source(spark, tmp_path):
    docs = io.load_sources(spark, {"inline_docs": [{"title": "T", "text": "x"}]})
    assert [(r.id, r.title, r.text) for r in docs.collect()] == [("T", "T", "x")]
    for bad in ({"wikipedia": True}, {}, {"inline_docs": [], "source_path": "x.jsonl"}):
        with pytest.raises(ValueError):
            io.load_sources(spark, bad)
    io.write_preview(spark.range(9).select((8 - F.col("id")).alias("id")), "id", 3, f"{tmp_path}/preview")
    assert sorted(r.id for r in spark.read.json(f"{tmp_path}/preview").collect()) == [0, 1, 2]


def test_list_values_and_choices(spark):
    t = F.col("t")
    assert one(spark, "['a b', 'c', 'd']", R.list_values(t, 2)) == ["a b", "c"]
    assert one(spark, '["x", "y"]', R.list_values(t, 5)) == ["x", "y"] and one(spark, "[]", R.list_values(t, 5)) == []
    assert one(spark, "plain", R.list_values(t, 5)) == ["plain"] and one(spark, None, R.list_values(t, 5)) == []
    assert one(spark, ["b", "a", "b"], R.ordered_choices(t, ("a", "b")), "array<string>") == ["b", "a"]
    with pytest.raises(Exception, match="not allowed: z"):
        one(spark, ["z"], R.ordered_choices(t, ("a", "b")), "array<string>")
    assert one(spark, [" a  b ", "", None], R.filter_values(t), "array<string>") == ["a b"] and one(spark, None, R.filter_values(t), "array<string>") == []


def test_acceptance_stops_at_the_target(spark):
    rows = spark.createDataFrame([(k, k % 3 == 0 or None) for k in range(12)], "id long, ok boolean")
    got = {r.id: r.outcome for r in L.strict_accept(rows, F.col("ok"), "id", 2).collect()}
    assert got == {0: "accepted", 1: "rejected", 2: "rejected", 3: "accepted"}
    assert L.strict_accept(rows, F.col("ok"), "id", 50).count() == 12
    hidden = rows.select("id", F.struct(F.lit(1).alias("a")).alias("hidden"))
    assert L.annotate(hidden, F.array(F.lit("why"))).first().hidden.asDict() == {"a": 1, "filter_reasons": ["why"]}
