"""Run records and the registry of models: maps, gate with its fallback, promotions, checks."""

import pytest

from memberlens.operators import registry as G
from memberlens.streaming.streams import scratch_path

LEDGER = "run_id string, section string, model string, registered_name string, version int, start_time timestamp_ntz, metric_name string, metric_value double"


def _runs(spark, rows):
    import datetime as dt
    rows = [(r, s, "m", n, 1, dt.datetime(2024, 1, day), k, v) for r, s, n, day, k, v in rows]
    return G.run_records(spark.createDataFrame(rows, LEDGER))


def _models(spark, rows):
    return spark.createDataFrame(rows, G.MODEL_SCHEMA)


def test_run_records_gather_maps(spark):
    rows = _runs(spark, [("r1", "regression", "a", 1, "R2", 0.5), ("r1", "regression", "a", 1, "MAE", 2.0), ("r1", "regression", "a", 1, "R2", 0.6),
                         ("r2", "clustering", "b", 2, "Silhouette", None)])
    got = {r["run_id"]: r for r in rows.collect()}
    assert got["r1"]["metrics"] == {"R2": 0.6, "MAE": 2.0} and got["r2"]["metrics"] == {"Silhouette": None}
    path = scratch_path(spark, "runs")
    for batch in ("a", "a", "b"):
        G.append_runs(rows, path, batch)
    assert spark.read.parquet(path).count() == 4


def test_gate_falls_back_to_the_tag(spark):
    runs = _runs(spark, [("r1", "regression", "a", 1, "R2", 0.5), ("r2", "regression", "b", 1, "MAE", 9.0), ("r3", "regression", None, 1, "R2", 0.9)])
    models = _models(spark, [("a", "regression", 1, {"metric": "R2=0.1"}, None), ("b", "regression", 1, {"metric": "x=R2=0.73"}, None),
                             ("c", "clustering", 1, {"metric": "0.9"}, None), ("d", "clustering", 1, {"metric": "S=abc"}, None),
                             ("e", "clustering", 1, None, None), ("f", "unheard of", 1, {"metric": "S=1"}, None)])
    got = {r["name"]: (r["value"], r["validated"]) for r in G.gate_models(models, runs).collect()}
    assert got == {"a": (0.5, True), "b": (0.73, True), "c": (0.0, False), "d": (0.0, False), "e": (0.0, False), "f": (1.0, False)}


def test_promotions_move_one_production_alias(spark):
    root = scratch_path(spark, "registry")
    assert G.read_registry(spark, root).count() == 0
    models = _models(spark, [("a", "regression", 1, {"owner": "x"}, None), ("b", "regression", 1, None, None), ("c", "clustering", 1, None, None)])
    assert G.write_registry(models, root) == 1
    runs = _runs(spark, [("r1", "regression", "a", 1, "R2", 0.8), ("r2", "regression", "b", 2, "R2", 0.6), ("r3", "clustering", "c", 1, "Silhouette", 0.1)])
    for _ in range(2):
        G.write_registry(G.promote_models(G.read_registry(spark, root), runs), root)
    got = {r["name"]: r for r in G.read_registry(spark, root).collect()}
    assert got["a"]["aliases"] == {"staging": 1, "production": 1} and got["b"]["aliases"] == {"production": 1} and got["c"]["aliases"] == {"staging": 1}
    assert got["a"]["tags"] == {"owner": "x", "stage": "production", "validated": "true", "promoted_by": G.PROMOTED_BY}
    newer = G.read_registry(spark, root).replace(1, 2, "version")
    G.write_registry(newer, root)
    report = {r["model"]: (r["stage"], r["aliases"], r["n_production"]) for r in G.models_report(G.read_registry(spark, root)).collect()}
    assert report == {"a": ("production", "-", 2), "b": ("production", "-", 2), "c": ("staging", "-", 2)}
    better = _runs(spark, [("r9", "regression", "b", 9, "R2", 0.9)])
    assert G.write_registry(G.promote_models(G.read_registry(spark, root), better), root) == 5
    got = {r["name"]: r["aliases"] for r in G.read_registry(spark, root).collect()}
    assert got == {"a": {"staging": 1, "production": 1}, "b": {"staging": 2, "production": 2}, "c": {"staging": 1}}


def test_a_bad_registry_leaves_the_old_one_valid(spark):
    root = scratch_path(spark, "registry")
    G.write_registry(_models(spark, [("a", "regression", 1, None, None)]), root)
    with pytest.raises(ValueError, match="twice"):
        G.write_registry(_models(spark, [("a", "regression", 1, None, None), ("a", "regression", 2, None, None)]), root)
    with pytest.raises(ValueError, match="does not exist"):
        G.write_registry(_models(spark, [("a", "regression", 1, None, {"production": 2})]), root)
    assert G.read_registry(spark, root).count() == 1
    empty = G.promote_models(G.read_registry(spark, root).limit(0), _runs(spark, [("r1", "regression", "a", 1, "R2", 0.8)]))
    assert empty.count() == 0
