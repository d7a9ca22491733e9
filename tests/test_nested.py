import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sievemill.operators import nested

PATHS = ["parties", "docs", "docs.load"]


def _levels(spark, lines, only=None, **more):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "line_id bigint, line string").withColumn("path", F.lit("clash"))
    rec = df.select("line_id", "path", nested.parse_record(F.col("line")).alias("record"))
    return nested.child_rows(rec, "line_id", "record", only, **more)


def _children(spark, lines):
    return rows(_levels(spark, lines, PATHS).select("line_id", "path", "ordinal"))


def test_shapes(spark):
    p = [{"n": 1}, None, {}, {"n": None}]
    shapes = [p, {"items": p}, {"pages": [{"page": 2, "rows": p[2:]}, {"page": 1, "rows": p[:2]}]}, json.dumps(p)]
    for shape in shapes:
        for record in ({"parties": shape}, {"case": {"parties": shape}, "v": 2}, {"record": json.dumps({"parties": shape})}):
            assert _children(spark, [json.dumps(record)]) == [(0, "parties", 0), (0, "parties", 3)], (shape, record)
    assert _children(spark, [json.dumps({"parties": {"n": 1}})]) == [(0, "parties", 0)]


def test_nothing_comes_out(spark):
    lines = [None, "", "  ", '{"parties": [{"n": 1}', "[1]", "3", '{"parties": null}', '{"parties": ""}', '{"parties": {}}', '{"x": {"parties": [{"n": 1}]}}', '{"parties": [1, "a"]}']
    assert _children(spark, lines) == []


def test_objects_marks_and_blanks(spark):
    line = "\uFEFF " + json.dumps({"docs": [{"x": 0}, {"load": {"a": 1}}, {"load": json.dumps({"a": None})}, {"load": None, "x": 1}]}) + "\r\n"
    got = _levels(spark, [line], PATHS)
    assert rows(got.where("path = 'docs'").select("ordinal")) == [(0,), (1,), (2,), (3,)]
    loads = got.where("path = 'docs.load'").withColumn("full", nested.has_values(F.col("element")))
    assert rows(loads.select("shape", "parent_ordinal", "ordinal", "full")) == [("object", 1, 0, True), ("object", 2, 0, False)]


def test_levels_are_found_in_the_data(spark):
    """Lists nobody named, three deep, in several shapes, with keys that link each row to its parent."""
    record = {"id": 7, "a": [{"x": 1, "b": {"items": [{"c": [{"deep": "u"}, None, {"deep": "v"}]}, {}]}}, {"x": "s", "b": json.dumps([{"y": 2}])}], "o": {"k": True}}
    got = _levels(spark, [json.dumps(record)])
    keys = {(r.path, r.row_id): r for r in got.collect()}
    assert sorted(keys) == [("a", "0/a/0"), ("a", "0/a/1"), ("a.b", "0/a/0/b/0"), ("a.b", "0/a/1/b/0"), ("a.b.c", "0/a/0/b/0/c/0"), ("a.b.c", "0/a/0/b/0/c/2"), ("o", "0/o/0")]
    for (path, _), r in keys.items():
        assert r.parent_id == "0" if "." not in path else (path.rpartition(".")[0], r.parent_id) in keys
    t = nested.level_tables(got, "line_id")
    assert set(t) == {"a", "a.b", "a.b.c", "o"}
    assert rows(t["a.b.c"]) == [(0, "0/a/0/b/0", 0, "0/a/0/b/0/c/0", "u"), (0, "0/a/0/b/0", 2, "0/a/0/b/0/c/2", "v")]
    assert t["a"].columns == ["line_id", "parent_id", "ordinal", "row_id", "x"] and rows(t["a"].select(F.to_json(F.struct("x")))) == [('{"x":"s"}',), ('{"x":1}',)]
    with pytest.raises(ValueError):
        _levels(spark, [json.dumps(record)], most_levels=2)


def test_repeats_long_and_empty(spark):
    line = json.dumps({"parties": [{"n": "x" * 20}] * 20_000})
    assert len(_children(spark, [line, line])) == 40_000
    assert _children(spark, []) == []


def test_flatten_tables(spark):
    schema = "id int, a struct<x:int,y:array<struct<parent_id:int,z:array<int>>>>, a_x string"
    df = spark.createDataFrame([(1, (5, [(7, [1, 2]), None, (8, None)]), "k"), (2, None, None)], schema)
    t = nested.flatten_tables(df, "id")
    assert set(t) == {"root", "root_a_y", "root_a_y_z"}
    assert rows(t["root"]) == [(1, 5, "k"), (2, None, None)]
    assert rows(t["root_a_y"].select("parent_id", "ordinal", "parent_id_")) == [("1", 0, 7), ("1", 2, 8)]
    child = t["root_a_y_z"].join(t["root_a_y"].select(F.col("row_id").alias("p"), "parent_id_"), F.col("parent_id") == F.col("p"))
    assert rows(child.select("parent_id_", "ordinal", "value")) == [(7, 0, 1), (7, 1, 2)]


def test_merged_schema(spark):
    got = nested.merged_schema(_levels(spark, ['{"parties": [{"n": 1}, {"m": {"k": "x"}}]}'], ["parties"])).first()
    assert "k: STRING" in got["schema"] and "n: BIGINT" in got["schema"]
