"""Every registered query of the library against its DuckDB oracle on the small tables, and the entry query."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from terraline.plans import registry

SF = Path(os.environ.get("TERRALINE_SF", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return float(v) if hasattr(v, "as_tuple") else v


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = registry.queries()[name](spark, str(SF))
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert all(same(a, b) for g, w in zip(got, want, strict=True) for a, b in zip(g, w, strict=True))


@pytest.mark.parametrize("name", ["terrain_patches", "map_match_tracks", "group_folds", "forest_cv", "extra_trees_cv"])
def test_rows_only(spark, name):
    assert registry.queries()[name](spark, str(SF)).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_streamed_matching_is_batch_matching(spark):
    found = registry.queries()
    pick = ["x", "y", "edge_id", "dist_to_road_m"]
    got = found["stream_map_match"](spark, str(SF)).select("user_id", "event_id", *pick).toPandas().set_index(["user_id", "event_id"]).sort_index()
    want = found["map_match_tracks"](spark, str(SF)).select("track", "ord", *pick).toPandas().set_index(["track", "ord"]).sort_index()
    assert len(got) == len(want) and got.index.tolist() == want.index.tolist()
    assert got.astype(float).fillna(-1).round(6).to_numpy().tolist() == want.astype(float).fillna(-1).round(6).to_numpy().tolist()


def test_filter_of_the_tables(spark):
    from terraline.operators.kinematics import Kalman
    from terraline.plans.telemetry import fixes

    got = registry.queries()["ekf_track"](spark, str(SF)).toPandas().set_index(["user_id", "t"])
    rows = fixes(spark, str(SF)).toPandas().sort_values(["user_id", "event_id"])
    for user, mine in rows.groupby("user_id"):
        ekf, last = Kalman(), None
        for r in mine.itertuples():
            t = r.event_id * 60.0
            ekf.predict(0.0, 0.0, t - last if last is not None else 0.0)
            last = t
            if r.event_id % 5:
                ekf.update(440000 + r.x, 4475000 + r.y, None if r.event_id % 7 == 0 else r.speed_kmh / 3.6, r.hdop or 1.0)
            have = got.loc[(user, t)].tolist()
            assert all(math.isnan(v) for v in have) if ekf.x is None else all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6) for a, b in zip(have, ekf.x, strict=True))
