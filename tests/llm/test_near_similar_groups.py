"""Groups of texts that are nearly, but not quite, similar: their pairs don't come up as candidates key after key, and no similar pair is lost."""

import numpy as np

from terraline.llm import pipeline_stages, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_sketches_differ_in_no_more_bits_than_sets_do_in_shingles():
    rng = np.random.default_rng(1)
    for n in (0, 1, 40, 400, 4000):
        common = rng.integers(0, 2**63, n).astype(np.uint64)
        for own in (0, 1, 7, 60, 700):
            a, b = (np.union1d(common, rng.integers(0, 2**63, own).astype(np.uint64)) for _ in range(2))
            x, y = (np.frombuffer(simhash.sketch_of(s), np.uint64) for s in (a, b))
            assert len(x) * 64 == simhash.SKETCH and np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_pairs_at_the_bound_meet_and_pairs_beyond_do_not():
    """Sets of 90 with 10 or 11 shingles of their own: 80 of 100 are common, or 79 of 101."""
    zero = np.zeros(2, np.int64)
    for own, met in ((10, 1), (11, 0)):
        a, b = np.arange(90, dtype=np.uint64), np.arange(own, 90 + own, dtype=np.uint64)
        sketches = np.array([np.frombuffer(simhash.sketch_of(s), np.uint64) for s in (a, b)])
        found = lambda known: len(simhash.meetings(np.zeros(2, np.int32), zero, np.arange(2), 15, 8, 0, np.zeros((2, 4), np.uint64), np.array([90, 90]), 0.8, sketches, np.array(known))[0])
        assert found([True, True]) == met and found([True, False]) == 1


def test_a_nearly_similar_group_gives_few_candidates(spark, monkeypatch):
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choice(words, 150).tolist()
    texts = []
    for i in range(200):  # each with seven words of its own, so that two of them have about 0.6 in common
        own = list(base)
        for k in rng.choice(150, 7, replace=False):
            own[k] = f"x{i}_{k}"
        texts.append(own)
    for i in range(20):  # and some with a near copy
        own = list(texts[i])
        own[75] = f"y{i}"
        texts.append(own)
    made, real = [], simhash.met_pairs

    def counted(*args):
        made.append(real(*args).cache())
        return made[-1]

    monkeypatch.setattr(simhash, "met_pairs", counted)
    df = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    left = {r["doc_id"] for r in pipeline_stages.near_duplicates(spark, df, "").collect()}
    rows = [m.count() for m in made]
    for m in made:
        m.unpersist()
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert left == set(root) and len(left) <= 200
    assert sum(rows[2:]) <= 5 * len(texts), rows  # the first rounds find out who is tried in vain
