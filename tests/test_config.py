import pytest

from terraline import config
from terraline.plans.routes import RouteConfig


def test_overrides():
    assert config.deep_update({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert config.override(RouteConfig(), {"gps": {"max_hdop": 15.0}}).gps.max_hdop == 15.0
    with pytest.raises(ValueError):
        config.override(RouteConfig(), {"nope": 1})


def test_runs():
    assert [r.model for r in config.build_runs(["random_forest", "gradient_boosting"])] == ["random_forest", "gradient_boosting"]
    assert config.build_runs(["random_forest"], {"maxDepth": 4}, '[{"run_id": "a b", "params": {"numTrees": 5}}]')[0].params == {"maxDepth": 4, "numTrees": 5}
    for bad in ([{"model": "svm"}], [{"x": 1}], [{"model": "random_forest"}, {"model": "random_forest"}]):
        with pytest.raises(ValueError):
            config.build_runs([], configs=bad)
    assert [config.parse_max_features(x) for x in (None, "none", "sqrt", "3", "0.5")] == [None, None, "sqrt", 3, 0.5]
    with pytest.raises(ValueError):
        config.minimum_samples(100, 100, 5)
