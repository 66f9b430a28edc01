"""Whole-body parse, schema evolution of appended files, overlay runs."""

from dataclasses import replace

from cohortix.operators import experiments as X
from cohortix.params import ExperimentConfig
from cohortix.sources import fixtures as fx
from cohortix.sources import ingest as I


def test_bodies_of_three_forms(spark):
    bodies = [
        ("s", 'event: x\r\ndata: {"a": 1}\r\n\r\n  data: {"a": "data: 2"}\ndata: {"a": \nid: 3'), ("a", '[\n {"a": 3},\n {"a": [4, {"b": 5}]}\n]'),
        ("o", ' {"a":\n 6}\n'), ("cut", '[{"a": 7}, {"a"'), ("text", "gateway timeout"), ("none", None), ("empty", "  "), ("inside", '{"a": "data: 8"}'),
    ]
    rows, seen = I.parse_body(spark.createDataFrame(bodies, "name string, value string"))
    got = sorted((r["name"], r["record"].replace("\n", "").replace(" ", "")) for r in rows.collect())
    assert got == sorted([("s", '{"a":1}'), ("s", '{"a":"data:2"}'), ("a", '{"a":3}'), ("a", '{"a":[4,{"b":5}]}'), ("o", '{"a":6}'), ("inside", '{"a":"data:8"}')])
    assert seen.get == {"records": 6, "bad": 3}


def test_appends_widen_the_inferred_schema(spark, tmp_path):
    path = str(tmp_path / "nd")
    for row, schema in [((1, 2, 3), "id long, v long, w long"), ((2, 2.5, "x"), "id long, v double, w string"), ((3, 4, 5, True), "id long, v long, w long, new boolean")]:
        I.append_ndjson(spark.createDataFrame([row], schema), path)
    back = I.read_ndjson(spark, path)
    assert dict(back.dtypes) == {"id": "bigint", "v": "double", "w": "string", "new": "boolean"}
    assert sorted(back.select("id", "v", "w", "new").collect()) == [(1, 2.0, "3", None), (2, 2.5, "x", None), (3, 4.0, "5", True)]


def test_overlay_run_goes_on_after_a_failure(spark, tmp_path):
    cfg = ExperimentConfig()
    broken = replace(cfg, name="broken", window=replace(cfg.window, experiment_end="never"))
    run = X.run_overlays(fx.orders(spark, "/root/testdata/sf0.001"), [broken, cfg, replace(cfg, name="second")], str(tmp_path)).collect()
    assert [(r.experiment_name, r.status) for r in run] == [("broken", "failed"), (cfg.name, "success"), ("second", "success")]
    for r in run[1:]:
        stored = spark.read.parquet(str(tmp_path / r.table_name))
        assert (r.rows_created, r.unique_users) == (stored.count(), stored.select("user_id").distinct().count())
    assert run[0].error and run[0].rows_created == 0
