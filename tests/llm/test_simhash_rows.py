"""Null and repeated ids cost no document that isn't a near-duplicate."""

import numpy as np
import pytest

from terraline.llm import simhash


@pytest.mark.parametrize("first", [simhash.first_of_each, simhash.first_of_similar])
def test_null_and_repeated_ids(spark, first):
    rng = np.random.default_rng(6)
    a, b, c, d, e = (" ".join(rng.choice([f"w{i}" for i in range(500)], 80)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (1, c), (1, d), (1, d), (0, d), (2, e), (None, e)]
    left = first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert left.columns == ["doc_id", "text"]
    assert sorted(map(tuple, left.collect()), key=repr) == sorted([(None, a), (None, b), (1, c), (0, d), (2, e)], key=repr)
