"""Operators on small inline rows: checks, coverage, sampling, runs, views, puzzles, IO, streams."""

import json
from itertools import permutations, product

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textmill.operators import checks as K
from textmill.operators import dialogue as O
from textmill.operators import puzzles as Z
from textmill.operators import runs as U
from textmill.operators import sampling as S
from textmill.operators import views as V
from textmill.sources import io
from textmill.streaming import events as E


def test_checks_overwrite_and_count_nulls_as_failed(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id long, x int")
    got = K.verify(K.verify(rows, {"big": F.col("x") > 2, "any": F.lit(True)}), {"any": F.col("id") < 3})
    assert {r.check_name: (r.passed, r.failed) for r in K.metrics(got).collect()} == {"big": (1, 2), "any": (2, 1)}
    assert {r.check_name: r.examples for r in K.failures(got, "id", 1).collect()} == {"big": "2", "any": "3"}


def test_coverage_verdicts(spark):
    planned = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    observed = spark.createDataFrame([("a",), ("b",), ("d",)], "k string")
    got = {r.k: (r.planned, r.observed, r.verdict) for r in K.coverage(planned, observed, ["k"]).collect()}
    assert got == {"a": (1, 1, "passed"), "b": (2, 1, "mismatched"), "c": (1, 0, "missing"), "d": (0, 1, "unexpected")}


def test_quota_lets_rows_without_a_group_through(spark):
    rows = spark.createDataFrame([(k, "a" if k < 5 else None) for k in range(9)], "id long, g string")
    assert sorted(r.id for r in S.quota(rows, "g", "id", 2).collect()) == [0, 1, 5, 6, 7, 8]


def test_limits(spark):
    rows = spark.range(5)
    assert [S.limit_after_first(rows, "id", n).count() for n in (0, 1, 3)] == [1, 1, 3]


def test_global_numbers_are_gapless_and_in_order(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    got = {r.v: r.ord for r in S.numbered(rows, ["v"]).collect()}
    assert got == {k: k for k in range(1000)}


@pytest.mark.parametrize("partitions", [6, 8])
def test_numbers_and_splits_hold_with_a_payload(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        rows = spark.range(0, 20_000, 1, 5).select((F.col("id") * 7919 % 20_000).alias("v"), F.repeat(F.lit("text "), 20).alias("text"), (F.col("id") % 3 == 0).alias("hot"))
        got = S.numbered(rows, ["v"])
        assert got.columns == ["v", "text", "hot", "ord"] and got.where("ord <> v").count() == 0 and got.count() == 20_000
        split = S.split_by_position(rows, "v", 0.9)
        assert split.columns == ["v", "text", "hot", "split"] and split.where("split <> if(v < 18000, 'train', 'eval')").count() == 0
        inside = S.numbered(rows, ["v"], "n", ["hot"]).groupBy("hot").agg(F.count("n").alias("rows"), F.countDistinct("n").alias("kinds"), F.max("n").alias("last"))
        assert all(r.rows == r.kinds == r.last + 1 for r in inside.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_groups_without_a_name_are_numbered_too(spark):
    rows = spark.createDataFrame([(k, None if k % 2 else "a") for k in range(9)], "id long, g string")
    assert {r.id: r.n for r in S.numbered(rows, ["id"], "n", ["g"]).collect()} == {k: k // 2 for k in range(9)}
    assert {r.id: r.split for r in S.split_by_position(rows, "id", 0.5, "g").collect()} == {k: "train" if k < 4 else "eval" for k in range(9)}


def test_retrieval_by_lookup_equals_retrieval_by_join(spark, monkeypatch):
    from textmill.functions import text as T
    from textmill.operators import corpus as C

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    chunks = C.chunk(docs).repartition(5)
    asked = docs.where("doc_id % 10 = 0").select(F.col("doc_id").alias("query_id"), F.col("doc_id").alias("own"), T.tokens(F.substring("text", 1, 80)).alias("tokens"))
    for per_source in (False, True):
        rows = []
        for bound, cells, held in ((200_000, 2_000_000, 200_000), (200_000, 50, 300), (0, 1, 1)):
            monkeypatch.setattr(C, "BROADCAST_ROWS", bound)
            monkeypatch.setattr(C, "CELLS", cells)
            monkeypatch.setattr(C, "CANDIDATES", held)
            rows.append(sorted(map(tuple, C.retrieve(asked, chunks, 4, per_source).collect())))
        assert rows[0] == rows[1] == rows[2] and rows[0]


@pytest.mark.parametrize("n,f", [(10, 0.75), (3, 0.5), (1, 0.9), (7, 1.0)])
def test_positional_split(spark, n, f):
    got = {r.id: r.split for r in S.split_by_position(spark.range(n), "id", f).collect()}
    assert got == {k: "train" if k < int(n * f) else "eval" for k in range(n)}


def test_balanced_sample_takes_turns(spark):
    rows = spark.createDataFrame([(f"k{n}", "a" if n < 10 else "b", "xy"[n % 2]) for n in range(14)], "k string, major string, minor string")
    got = S.balanced(rows, "major", "minor", "k", 1, 6).collect()
    assert sorted(r.major for r in got) == ["a"] * 3 + ["b"] * 3
    assert {(r.major, r["minor"]) for r in got if r["round"] <= 2} == {(a, b) for a in "ab" for b in "xy"}


def test_rotation_moves_its_cursor_when_a_bin_empties(spark):
    rows = [("f", b, s, i) for i, (b, s) in enumerate([("a", 0.9), ("b", 0.9), ("b", 0.8), ("c", 0.7), ("c", 0.6), ("c", 0.5)])] + [("g", "z", 0.1, 50), ("g", "z", 0.2, 51)]
    df = spark.createDataFrame([(*r, 0.0, True) for r in rows], "family string, global_bin string, local_score double, conv_id long, review_score double, eligible boolean")
    got = {}
    for r in O.rotate_bins(df, 5).collect():
        got.setdefault(r.family, {})[r.place] = r.conv_id
    # a(0); a is empty, of b and c the second is c(3); then b(1), c(4), b(2).
    assert [got["f"][k] for k in range(5)] == [0, 3, 1, 4, 2] and got["g"] == {0: 51, 1: 50}
    # One of each family a round, the family with fewer rows first.
    chosen = sorted(O.mds_select(df, 5).collect(), key=lambda r: (r.place, r.family != "g"))
    assert [r.conv_id for r in chosen] == [51, 0, 50, 3, 1]


def test_quoted_references_need_an_earlier_turn(spark):
    turns = [(1, 0, "user", 'about "new words"'), (1, 1, "assistant", "The blue house"), (1, 2, "user", 'you said "blue House"'), (1, 3, "user", 'and "no"')]
    got = {r.turn: r.grounded for r in O.quoted_references(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {0: False, 2: True, 3: True}


def test_ordered_map_keeps_input_order(spark):
    out = O.ordered_map(spark.range(100).repartition(5), lambda f: pd.DataFrame({"id": f.id, "sq": f.id**2}), "id long, sq long", "id").collect()
    assert [r.sq for r in out] == [k * k for k in range(100)]


def test_runs(spark, tmp_path):
    assert U.hash_spec({"b": 1, "a": "é"}) == U.hash_spec({"a": "é", "b": 1})
    for k, (done, error) in enumerate([("t1", None), ("t3", None), ("t2", None), (None, None), ("t9", "boom")]):
        U.write_manifest(spark, str(tmp_path), {"run_id": f"r{k}", "pack": "p", "spec_hash": "h", "started_at": "t0", "finished_at": done, "error": error, "rows": k})
    runs = U.manifests(spark, str(tmp_path))
    assert {r.run_id: r.s for r in runs.select("run_id", U.status().alias("s")).collect()} == {"r0": "completed", "r1": "completed", "r2": "completed", "r3": "running", "r4": "failed"}
    assert [r.run_id for r in U.latest(runs).collect()] == ["r1"]
    a, b = runs.where("run_id = 'r0'").withColumn("run_id", F.lit("x")), runs.where("run_id = 'r1'").withColumn("run_id", F.lit("x"))
    assert {r.field for r in U.compare(a, b, "run_id").collect()} == {"finished_at", "rows"}


def test_views(spark):
    rows = spark.createDataFrame([(k, "ab"[k % 2], f"Text {k}", None if k else "  ") for k in range(90)], "id long, f string, t string, e string")
    spec = V.ViewSpec("id", ("t",), ("f",), ("f",))
    assert V.page(rows, spec, 0, 1000).count() == 90 and V.page(rows, spec, 3, 40).count() == 10 and V.page(rows, spec, 4, 40).count() == 0
    assert V.matching(rows, spec, " tExt 8", {"f": ["a"]}).count() == 6
    assert tuple(V.page_count(rows.where("1=0")).first()) == (0, 1)
    assert {(r.facet, r.value, r.n) for r in V.facet_values(rows, ["f", "e"]).collect()} == {("f", "a", 45), ("f", "b", 45)}


def test_io_round_trips(spark, tmp_path):
    rows = spark.createDataFrame([("d1", "T", "x", "train"), ("d2", None, "y", "eval")], "id string, title string, text string, split string")
    io.write_jsonl(rows, f"{tmp_path}/a.jsonl")
    line = next(x for p in (tmp_path / "a.jsonl").glob("part-*") for x in p.read_text().splitlines() if "d2" in x)
    assert list(json.loads(line)) == ["id", "split", "text"]
    back = io.read_rows(spark, f"{tmp_path}/a.jsonl", "id string, title string, text string")
    assert {(r.id, r.title) for r in io.normalize_documents(back).collect()} == {("d1", "T"), ("d2", "d2")}
    with pytest.raises(ValueError):
        io.read_rows(spark, "x.csv")
    with pytest.raises(Exception, match="unexpected language"):
        io.normalize_documents(rows.withColumn("language", F.lit("fr")), "en").collect()
    io.publish(rows.withColumn("ok", F.col("id") == "d1"), f"{tmp_path}/p", passed="ok")
    assert spark.read.parquet(f"{tmp_path}/p/data").count() == 1 and spark.read.parquet(f"{tmp_path}/p/failures").count() == 1
    assert io.artifacts(spark, str(tmp_path)).count() >= 2


def test_streams_append_resume_and_route(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"ts": "2024-01-01T00:00:00", "component": "a", "event": "x", "data": "1"}\n')
    events = E.read_events(spark, str(source))
    for n in (1, 2):
        E.append(events, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == n  # what was read before is not read again
        (source / f"{n + 1}.json").write_text('{"ts": "2024-01-01T00:00:05", "component": "a", "event": "y", "data": "2"}\n')
    assert E.snapshots(spark.read.parquet(f"{tmp_path}/out")).first().data == "2"
    reasons = F.when(F.col("event") == "x", F.array(F.lit("bad"))).otherwise(F.expr("cast(array() as array<string>)"))
    E.routed(events.withColumn("reasons", reasons), "reasons", f"{tmp_path}/r", f"{tmp_path}/ck2").awaitTermination()
    assert [spark.read.parquet(f"{tmp_path}/r/{n}").count() for n in ("candidates", "rows", "rejected")] == [3, 2, 1]


def test_streaming_windows_equal_the_batch_form(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type", "value")
    rows.write.parquet(f"{tmp_path}/ev")
    stream = E.read_parquet_stream(spark, f"{tmp_path}/ev", rows.schema)
    E.to_memory(E.windowed_counts(stream, "event_type"), "windows")
    assert spark.table("windows").exceptAll(E.windowed_counts(rows, "event_type")).count() == 0


def test_latin_and_skyscraper_counts():
    squares = [g for g in product(permutations((1, 2, 3)), repeat=3) if all(len(set(c)) == 3 for c in zip(*g))]
    assert Z.latin_solutions(3, {}, None, 100) == len(squares) == 12
    less = (((0, 0), (0, 1)), ((1, 1), (2, 1)))
    want = sum(g[0][0] < g[0][1] and g[1][1] < g[2][1] for g in squares)
    assert Z.latin_solutions(3, {}, None, 100, less) == want
    want = sum(Z.visible(list(g[0])) == 3 and Z.visible([r[2] for r in g][::-1]) == 2 for g in squares)
    assert Z.skyscraper_solutions(3, {"left": [3, 0, 0], "bottom": [0, 0, 2]}, 100) == want


def test_search_families_against_enumeration():
    stars = [p for p in permutations(range(5)) if all(abs(a - b) > 1 for a, b in zip(p, p[1:]))]
    assert Z.star_solutions(5, set(), None, 100) == len(stars)
    assert Z.star_solutions(5, {(0, 0)}, None, 100) == sum(p[0] != 0 for p in stars)
    regions = [[c for c in range(5)] for _ in range(5)]  # regions are columns: every placement fits
    assert Z.star_solutions(5, set(), regions, 100) == len(stars)
    assert Z.jug_paths([3, 5], 4) == (6, 1) and Z.jug_paths([2, 4], 3) == (-1, 0)
    words, total = ["AB", "BA"], "CBC"
    want = sum((10 * a + b) + (10 * b + a) == 101 * c + 10 * b for a, b, c in permutations(range(10), 3))
    assert Z.crypt_solutions(words, total, 10, 100) == want
    assert Z.numbrix_solutions(2, 2, {}, 100) == 8 and Z.numbrix_solutions(2, 2, {0: (0, 0), 3: (0, 1)}, 100) == 1


def test_hitori_and_lamps_against_enumeration():
    grid = [[1, 1, 2], [2, 3, 1], [3, 1, 1]]
    want = 0
    for bits in product((0, 1), repeat=9):
        shade = [bits[3 * r : 3 * r + 3] for r in range(3)]
        white = {(r, c) for r in range(3) for c in range(3) if not shade[r][c]}
        lines = [[(r, c) for c in range(3)] for r in range(3)] + [[(r, c) for r in range(3)] for c in range(3)]
        distinct = all(len({grid[r][c] for r, c in line if (r, c) in white}) == sum(x in white for x in line) for line in lines)
        apart = not any(shade[r][c] and ((c < 2 and shade[r][c + 1]) or (r < 2 and shade[r + 1][c])) for r in range(3) for c in range(3))
        if white and distinct and apart:
            seen, todo = set(), [min(white)]
            while todo:
                x = todo.pop()
                if x in white and x not in seen:
                    seen.add(x)
                    todo += [(x[0] + a, x[1] + b) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]
            want += seen == white
    assert Z.hitori_solutions(grid, 100) == want
    board = ["..#", ".1.", "#.."]
    cells = [(r, c) for r in range(3) for c in range(3) if board[r][c] == "."]

    def sees(a, b):
        if a[0] != b[0] and a[1] != b[1]:
            return False
        line = [(r, c) for r in range(min(a[0], b[0]), max(a[0], b[0]) + 1) for c in range(min(a[1], b[1]), max(a[1], b[1]) + 1)]
        return all(board[r][c] == "." for r, c in line)

    want = 0
    for bits in product((0, 1), repeat=len(cells)):
        lamps = [c for c, b in zip(cells, bits) if b]
        lit = all(any(sees(c, x) for x in lamps) for c in cells)
        apart = not any(sees(a, b) for a in lamps for b in lamps if a != b)
        want += lit and apart and sum(abs(r - 1) + abs(c - 1) == 1 for r, c in lamps) == 1
    assert Z.light_solutions(board, 100) == want


def test_countdown_and_zebra():
    assert Z.countdown_expressions([2, 3, 7], 13) == (2, 1)  # 2*3+7
    assert Z.countdown_expressions([1, 5], 6) == (1, 1) and Z.countdown_expressions([2, 2], 7)[0] == -1
    axes = {"color": ["red", "blue", "green"], "pet": ["cat", "dog", "fish"]}
    clues = [("left", "red", "blue"), ("same", "blue", "cat"), ("beside", "cat", "dog")]
    want = sum(
        c["red"] + 1 == c["blue"] and c["blue"] == p["cat"] and abs(p["cat"] - p["dog"]) == 1
        for c in (dict(zip(axes["color"], o)) for o in permutations(range(3)))
        for p in (dict(zip(axes["pet"], o)) for o in permutations(range(3)))
    )
    assert Z.zebra_solutions(3, axes, clues, 100) == want


def test_search_runs_on_rows(spark):
    rows = spark.createDataFrame([(1, "jug", json.dumps({"capacities": [3, 5], "goal": 4})), (2, "lightup", json.dumps({"board": ["."]}))], "puzzle_id long, family string, spec string")
    assert {r.puzzle_id: r.solutions for r in Z.search_udf(rows, Z.solve).collect()} == {1: 1, 2: 1}
    assert Z.search_udf(rows.where("1=0"), Z.solve).count() == 0
