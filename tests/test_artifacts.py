"""Artifacts of training runs, choice among cached networks, registry access."""

import json

import pytest

from terraline.sources import artifacts, network, registry


def put(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body if isinstance(body, str) else json.dumps(body))


def test_scan_models_falls_back(spark, tmp_path):
    put(tmp_path / "a" / "x_leaderboard.csv", 'Trial,Holdout_R2,params,holdout_rmse\n1,0.5,"{a, b}",2.0\n2,0.7,"{c}",1.5\n')
    put(tmp_path / "a" / "x_history.json", {"history": [{"holdout_r2": 0.9, "cv_r2_mean": 1.0}]})
    put(tmp_path / "b" / "x_history.json", [{"cv_r2_mean": 0.1}, {"holdout_r2": 0.4, "cv_r2_mean": 0.6}, {"holdout_r2": 0.3}])
    put(tmp_path / "c" / "n" / "x_report.md", "words")
    put(tmp_path / "c" / "n" / "any.csv", "generalization_gap,other\n0.2,1\n")
    put(tmp_path / "d" / "notes.csv", "holdout_r2\n1\n")  # no model
    put(tmp_path / "e" / "x_history.json", "not json")
    put(tmp_path / "f" / "leaderboard.csv", "objective_value,holdout_rmse\n1,9\n3,8\n2,7\n")
    got = {r["model_dir"]: tuple(r[m] for m in artifacts.METRICS) for r in artifacts.scan_models(spark, str(tmp_path)).collect()}
    assert got == {"a": (0.7, 1.5, pytest.approx(0.1)), "b": (0.4, None, pytest.approx(0.2)), "c/n": (None, None, 0.2), "e": (None, None, None), "f": (None, 8.0, None)}


def test_device_metrics(spark, tmp_path):
    name = lambda m: f"adaptive_w_model_{m}_history.json"
    put(tmp_path / "doback-23" / "rf" / name("rf"), {"best": {"trial": 4, "holdout_r2": 0.8}})
    put(tmp_path / "doback-23" / name("rf"), {"best": {"trial": 9, "holdout_r2": 0.9}})  # the model's own folder comes first
    put(tmp_path / "doback-23" / name("gbr"), {"best": {"trial": 2, "holdout_r2": 0.85, "cv_r2_mean": 0.7}})
    put(tmp_path / "doback-24" / "other" / name("rf"), {"best": {"holdout_r2": 0.99}})  # another folder's
    put(tmp_path / "doback-24" / "extra_trees" / name("extra_trees"), {"history": []})
    got = artifacts.device_metrics(spark, str(tmp_path))
    rows = {(r["device"], r["model"]): (r["trial"], r["holdout_r2"], r["cv_r2_mean"]) for r in got.collect()}
    assert rows == {("23", "rf"): (4, 0.8, 0.0), ("23", "gbr"): (2, 0.85, 0.7), ("24", "extra_trees"): (0, 0.0, 0.0)}
    assert {r["device"]: r["model"] for r in artifacts.best_of_devices(got).collect()} == {"23": "gbr", "24": "extra_trees"}


def graph(lon0, lon1):
    node = '<node id="{}"><data key="d0">{}</data><data key="d1">{}</data></node>'
    return (
        '<graphml><key id="d0" attr.name="x"/><key id="d1" attr.name="y"/><key id="d2" attr.name="highway"/><graph>'
        + node.format("a", lon0, 40.0) + node.format("b", lon1, 41.0) + "".join(f'<edge source="a" target="b"><data key="d2">{h}</data></edge>' for h in ("primary", "footway", "residential")) + "</graph></graphml>"
    )


def test_choice_of_a_network(spark, tmp_path):
    put(tmp_path / "local.graphml", graph(-3.1, -3.0))
    for name, ends in (("net_1", (-4.0, -3.9)), ("net_2", (-3.5, -2.9)), ("net_3", (-9.0, 9.0)), ("other", (-99.0, 99.0))):
        put(tmp_path / "cache" / f"{name}.graphml", graph(*ends))
    found = lambda box, **how: {p["lon"] for r in network.network_for_box(spark, box, **how).collect() for p in r["coords"]}
    both = {"local": str(tmp_path / "local.graphml"), "cache": str(tmp_path / "cache")}
    assert found((-3.08, -3.02, 40.1, 40.9), **both) == {-3.1, -3.0}
    assert found((-3.2, -3.0, 40.1, 40.9), **both) == {-3.5, -2.9}
    assert found((-8.0, 3.0, 40.1, 40.9), **both) == {-9.0, 9.0}
    edges = network.network_for_box(spark, (-3.08, -3.02, 40.1, 40.9), **both)
    assert sorted(r["edge_id"] for r in edges.collect()) == [0, 1] and "SinglePartition" not in edges._jdf.queryExecution().executedPlan().toString()
    for how in (both, {}, {"local": str(tmp_path / "none"), "cache": str(tmp_path / "nowhere")}):
        with pytest.raises(LookupError):
            network.network_for_box(spark, (-20.0, 3.0, 40.1, 40.9), **how)


def test_device_config(spark):
    known = network.device_registry(spark)
    assert registry.device_config(known, "DOBACK27")["k1"] == registry.device_config(known, "27")["k1"] == 1.5
    with pytest.raises(ValueError, match="'23', '24'"):
        registry.device_config(known, "99")
