"""The pipeline's near-duplicate search: recall by similarity, with few and with many texts a key, and groups of near copies."""

import numpy as np
import pytest

from terraline.llm import pipeline_stages, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BANDS = [(0.80, 0.85), (0.85, 0.90), (0.90, 0.95), (0.95, 1.0)]


def five(words):
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def pairs_by_band(rng, each):
    """Pairs of texts of 150 to 400 words, random words replaced, `each` of them in each band."""
    vocabulary = [f"w{i}" for i in range(5000)]
    found = {band: [] for band in BANDS}
    while any(len(v) < each for v in found.values()):
        a = rng.choice(vocabulary, int(rng.integers(150, 400))).tolist()
        b = [w if rng.random() > 0.025 * rng.random() else "new" for w in a]
        x, y = five(a), five(b)
        j = len(x & y) / len(x | y)
        band = next((c for c in BANDS if c[0] <= j < c[1]), None)
        if band and len(found[band]) < each:
            found[band].append((a, b))
    return found


@pytest.mark.parametrize(("key_bits", "per_key"), [(20, 1), (5, 60), (1, 1000)])
def test_recall_does_not_fall_with_the_texts_a_key(key_bits, per_key):
    """Search alone, over every table: keys are cut short, so that as many texts share one; the number of tables stays that of the
    whole key, scaled to the chance that a pair of similarity 0.8 shares a key."""
    rng = np.random.default_rng(key_bits)
    found = pairs_by_band(rng, 250)
    texts = [" ".join(t) for pairs in found.values() for pair in pairs for t in pair]
    pools = np.array([simhash.pool_of(simhash.shingle_set(t.encode(), 5)) for t in texts])
    bits = np.unpackbits(pools.view(np.uint8).reshape(len(texts), -1), axis=1, bitorder="little")
    tables = max(3, int(np.ceil(simhash.TABLES * simhash.AGREE ** (simhash.KEY_BITS - key_bits)))) if key_bits < 20 else simhash.TABLES
    met = set()
    for t in range(tables):
        picked = np.random.default_rng([5, t]).choice(simhash.BITS * simhash.WORDS, simhash.BITS, replace=False)
        word = (np.ascontiguousarray(np.packbits(bits[:, picked], axis=1)).view(">u8")[:, 0].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
        order = np.lexsort((np.arange(len(texts)), word))
        zero = np.zeros(len(texts), np.int32)
        i, j, apart = simhash.meetings(zero, word[order], order, key_bits, 1024, 0)
        kept = simhash.nearest(zero, word[order], order, key_bits, i, j, apart)
        i, j = i[kept], j[kept]
        met |= {(min(a, b), max(a, b)) for a, b in zip(order[i].tolist(), order[j].tolist(), strict=True)}
    at = 0
    shares = []
    for band in BANDS:
        own = [(at + 2 * k, at + 2 * k + 1) for k in range(250)]
        at += 500
        shares.append(np.mean([p in met for p in own]))
    print(shares, tables, len(met))
    assert min(shares) >= 0.9, shares


def test_keys_grow_with_the_rows():
    assert simhash.key_size(0) == simhash.key_size(10**6) == (20, 96)
    bits, tables = simhash.key_size(10**11)
    assert bits == 28 and 96 * 3 < tables < 96 * 4


def test_windows_cross_batches_and_groups_of_near_copies_are_one(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(2000)]
    base = rng.choice(words, 300).tolist()
    rows = []
    for i in range(300):  # near copies of one text, each with its own two words
        own = list(base)
        for k in rng.integers(0, 300, 2):
            own[k] = f"x{i}_{k}"
        rows.append((i, " ".join(own), "en", "s", 1))
    rows += [(1000 + i, " ".join(rng.choice(words, 300)), "en", "s", 1) for i in range(100)]
    rows += [(2000, None, None, None, None), (2001, None, None, None, None), (None, " ".join(base), "en", "s", 1), (7, " ".join(rng.choice(words, 50)), "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        left = sorted((r["doc_id"] for r in pipeline_stages.near_duplicates(spark, df, "").collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert left == sorted([0, 7, 2000, *range(1000, 1100)], key=str)
