"""The pipeline's near-duplicate search goes by the generalised pigeonhole: every two pools within its bits share a key, at any size."""

import numpy as np
import pytest

from terraline.llm import simhash

SIZE = simhash.BITS * simhash.WORDS


def plan_of(n):
    """The plan for n pools whose bits are even and of which some go together."""
    rng = np.random.default_rng(3)
    x = rng.random((2000, SIZE)) < 0.5
    x[:, 1::8] = x[:, ::8] ^ (rng.random((2000, SIZE // 8)) < 0.1)
    both = x.T.astype(float) @ x
    return simhash.allocate(n, both * (n / 2000), simhash.NEAR_BITS, simhash._masked)


@pytest.mark.parametrize("n", [2000, 50_000, 250_000, 13_000_000, 100_000_000])
def test_pools_within_the_bits_share_a_key_and_most_similar_ones_do(n):
    plan = plan_of(n)
    assert sorted(b for bits, _ in plan for b in bits) == list(range(SIZE))
    assert sum(t + 1 for _, t in plan) == simhash.NEAR_BITS + 1
    keys = [set(bits) for _, bits in simhash.partition_keys(plan)]
    assert min(map(len, keys)) >= simhash.LEAST_BITS and n / 2 ** max(map(len, keys)) <= simhash.PER_KEY
    rng = np.random.default_rng(n)
    share = lambda differ: any(not (k & differ) for k in keys)
    assert all(share(set(rng.choice(SIZE, simhash.NEAR_BITS, replace=False).tolist())) for _ in range(500))
    similar = [share(set(np.flatnonzero(rng.random(SIZE) > simhash.AGREE).tolist())) for _ in range(500)]
    assert np.mean(similar) >= 0.95


@pytest.mark.parametrize("n", [1, 3000])
def test_pools_that_are_all_alike_have_a_plan(n):
    assert sum(t + 1 for _, t in simhash.allocate(n, np.full((SIZE, SIZE), float(n)), simhash.NEAR_BITS, simhash._masked)) == simhash.NEAR_BITS + 1


def test_words_begin_with_the_key(spark):
    rng = np.random.default_rng(4)
    pools = rng.integers(-(2**63), 2**63 - 1, (50, simhash.WORDS))
    rows = [(i, i, *map(int, p)) for i, p in enumerate(pools)]
    vertices = spark.createDataFrame(rows, "v long, r long, w0 long, w1 long, w2 long, w3 long")
    keys = [(0, [3, 70, 200]), (5, [1, 255])]
    bits = np.unpackbits(pools.view(np.uint8), axis=1, bitorder="little")
    got = simhash.key_words(vertices, keys, 4).collect()
    assert len(got) == 100
    for r in got:
        own = dict(keys)[r["t"]]
        word = (r["word"] & (2**64 - 1)) ^ (1 << 63)
        assert word >> 60 == int("".join(str(bits[r["v"], b]) for b in own).ljust(4, "0"), 2)


def test_what_meets_in_a_key_is_judged_by_the_whole_pool_and_the_sizes(spark):
    """Rows of one key: 1 is near 0 by the whole pool, though the bits that the key draws differ; 2 is too small a set for either, and
    3 is far from all but by the drawn bits."""
    size = SIZE // 64
    keys = [(0, list(range(15)))]
    drawn = np.random.default_rng([5, 0]).choice(np.arange(15, SIZE), 64 - 15, replace=False)
    rest = np.setdiff1d(np.arange(15, SIZE), drawn)
    bits = np.zeros((4, SIZE), np.uint8)
    bits[:, 64 * np.arange(1, size + 1) - 1] = 1  # words are negative as signed numbers
    bits[1, drawn[:20]] ^= 1
    bits[3, rest[:100]] ^= 1
    pools = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
    sizes = [100, 100, 50, 100]
    rows = [(i, i, sizes[i], *map(int, p)) for i, p in enumerate(pools)]
    vertices = spark.createDataFrame(rows, "v long, r long, n long, w0 long, w1 long, w2 long, w3 long")
    got = simhash.met_pairs(simhash.key_words(vertices, keys, 15), 15, 1024, 0.8).collect()
    assert {tuple(r) for r in got} == {(0, 1)}
